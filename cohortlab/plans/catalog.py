"""All registered queries. Importing the query modules fills the registry."""

from __future__ import annotations

from . import access_queries, activity_queries, cohort_queries, metric_queries, ml_queries  # noqa: F401
from . import stream_queries  # noqa: F401  (reuses the batch oracles)
from .registry import ORACLE, QUERIES


def _wrap(fn):
    def run(spark, sf_dir):
        from ..session import apply_required_conf
        apply_required_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def with_required_conf(builders: dict) -> dict:
    """The builders, each run under the settings that results depend on."""
    return {k: _wrap(v) for k, v in builders.items()}


def queries() -> dict:
    return with_required_conf(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)
