"""Cohort assembly (J1, J2) and projections."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import rules
from ..sources.tables import require_modules

log = logging.getLogger(__name__)


def build_cohort(modules: dict, spine: str = "DEMO", key: str = C.ID_COL,
                 order: list[str] | None = None, validate: str | None = None,
                 critical: list[str] | None = None) -> DataFrame:
    """Left-join chain: spine + every present module on one key.

    Absent modules (``None``) are skipped. Duplicate right keys multiply rows,
    as a pandas left merge does; ``validate="one_to_one"`` raises instead
    (one distributed count per module, nothing collected).

    Plan shape: each module gets one exchange by ``key``; the sort-merge
    chain keeps that partitioning, so the left side is never re-shuffled.
    Small modules become broadcast joins by Spark's own size estimate. The
    row count of the spine is preserved when modules are one-row-per-key.
    """
    require_modules(modules, spine, critical if critical is not None else C.CRITICAL_LABS)
    order = order or [m for m in modules if m != spine]
    if validate == "union":
        return _cohort_by_union(modules, spine, key, order)
    out = modules[spine]
    for name in order:
        m = modules.get(name)
        if m is None:
            log.warning("module %s absent; skipped", name)
            continue
        if validate == "one_to_one":
            dups = m.groupBy(key).count().where("count > 1").limit(1).count()
            if dups:
                raise ValueError(f"module {name} has duplicate {key} values")
        clash = [c for c in m.columns if c != key and c in out.columns]
        if clash:
            m = m.withColumnsRenamed({c: f"{c}_{name}" for c in clash})
        out = out.join(m, on=key, how="left")
    return out


def _cohort_by_union(modules: dict, spine: str, key: str, order: list[str]) -> DataFrame:
    """J1 for one-row-per-key modules in a single shuffle.

    Every present module is projected to the wide schema (its own columns,
    nulls elsewhere) plus a module tag, all are unioned, and one aggregate by
    key picks each column from the module that owns it. Per key and module
    the row count is checked inside the plan: a duplicate key raises (no
    silent collapse), so the result always equals the left-join chain.
    Keys absent from the spine are dropped, spine keys without a module row
    get nulls — left-join semantics.
    """
    present = [(spine, modules[spine])] + [(m, modules[m]) for m in order if modules.get(m) is not None]
    for m in order:
        if modules.get(m) is None:
            log.warning("module %s absent; skipped", m)
    owner, cols = {}, []
    for name, df in present:
        for c in df.columns:
            if c != key and c not in owner:
                owner[c] = name
                cols.append((c, df.schema[c].dataType))
    parts = []
    for i, (name, df) in enumerate(present):
        sel = [F.col(key)]
        for c, t in cols:
            sel.append((F.col(c) if owner[c] == name else F.lit(None)).cast(t).alias(c))
        for j in range(len(present)):
            sel.append(F.lit(1 if i == j else 0).alias(f"__n{j}"))
        parts.append(df.select(*sel))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    aggs = [F.max(c).alias(c) for c, _ in cols]  # at most one non-null per key (checked)
    aggs += [F.sum(f"__n{j}").alias(f"__n{j}") for j in range(len(present))]
    g = u.groupBy(key).agg(*aggs)
    dup = F.greatest(*[F.col(f"__n{j}") for j in range(1, len(present))]) if len(present) > 1 else F.lit(0)
    g = g.where(F.col("__n0") > 0)
    # The check is part of the key column, so it can never be pruned away.
    checked_key = F.when((dup > 1) | (F.col("__n0") > 1), F.raise_error(
        F.concat(F.lit("duplicate key in a module: "), F.col(key).cast("string")))).otherwise(F.col(key))
    return g.select(checked_key.alias(key), *[F.col(c) for c, _ in cols])


def labelled_cohort(modules: dict, t: C.LabelThresholds = C.LabelThresholds(), **kw) -> DataFrame:
    """J1 then the P6 label."""
    return rules.label(build_cohort(modules, **kw), C.TARGET_COL, t)


def present_features(df: DataFrame, wanted: list[str]) -> list[str]:
    """Keep wanted features that exist, warn about the rest."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        log.warning("missing features %s; using the rest", missing)
    return [c for c in wanted if c in df.columns]


def require_target(df: DataFrame, target: str = C.TARGET_COL) -> None:
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")


def feature_set(cohort: DataFrame, features: list[str], key: str = C.ID_COL,
                target: str = C.TARGET_COL) -> DataFrame:
    """Key, target and the present features (the training CSV layout)."""
    require_target(cohort, target)
    return cohort.select(key, target, *present_features(cohort, features))


def combine_features(clinical: DataFrame, general: DataFrame, key: str = C.ID_COL,
                     target: str = C.TARGET_COL) -> DataFrame:
    """Inner join on the key; the label comes from the left side only."""
    g = general.drop(target) if target in general.columns else general
    return clinical.join(g, on=key, how="inner")


def assign_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """First k columns of a headerless table take the given names."""
    k = min(len(names), len(df.columns))
    return df.select(*[F.col(c).alias(n) for c, n in zip(df.columns[:k], names[:k])])


def reindex(df: DataFrame, names: list[str], fill=0, keep: list[str] | None = None) -> DataFrame:
    """Exact column order; absent *columns* filled with ``fill``; extras
    dropped. Null *values* in present columns stay null."""
    keep = keep or []
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in names])


def complete_cases(df: DataFrame, cols: list[str], name: str = "all_present") -> DataFrame:
    """Flag rows whose listed columns are all non-null."""
    return df.withColumn(name, F.when(rules.all_present(cols, df.columns), 1).otherwise(0))
