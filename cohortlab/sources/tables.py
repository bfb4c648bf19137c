"""Readers and writers.

All numeric columns are normalised at load: NaN becomes null, because Spark
orders NaN above every number (``NaN > 30`` is true) while the rules treat a
missing value as failing every comparison.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path
from . import xport

log = logging.getLogger(__name__)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(table_path(sf_dir, name))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NaN by null in float/double columns."""
    floating = {f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or df.columns) if c in floating]
    if not targets:
        return df
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c))
                           for c in targets})


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API, on local disk and object stores alike."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return bool(fs.exists(target))


def file_listing(spark: SparkSession, path: str) -> list[str]:
    """Every file under ``path`` with its length and time, sorted."""
    fs, target = hadoop_path(spark, path)
    files, found = fs.listFiles(target, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return sorted(found)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Move a finished folder to its place in one step. If another session has
    put one there meanwhile, that one stays and ours goes."""
    fs, source = hadoop_path(spark, written)
    _, target = hadoop_path(spark, path)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        if not fs.exists(target):
            raise OSError(f"cannot move {written} to {path}")
        drop_path(spark, written)


# Conditions of a path that is not there, and of files that are no readable table.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
CORRUPT = ("CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE.NO_HINT", "FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER",
           "FAILED_READ_FILE.PARQUET_COLUMN_DATA_TYPE_MISMATCH")


def load_module(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: T.StructType | None = None, header: bool = True) -> DataFrame | None:
    """Load a survey module; a missing or corrupt file yields ``None``.

    Other errors (permissions, network) are raised: taken for an absent
    module, they would silently drop its columns.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "xport":
        try:
            xport.check_file(path)
        except (FileNotFoundError, xport.XportError) as e:
            log.warning("module %s not found or unreadable: %s", path, e)
            return None
        xport.register(spark)
    try:
        if fmt == "csv":
            df = reader.option("header", header).option("inferSchema", schema is None).csv(path)
        else:
            df = reader.format(fmt).load(path)
        return nan_to_null(df)
    except (PySparkException, Py4JJavaError) as e:
        text = f"{getattr(e, 'getCondition', lambda: '')() or ''} {e}"
        if any(c in text for c in (*ABSENT, *CORRUPT)) or "is not a Parquet file" in text:
            log.warning("module %s not found or unreadable: %s", path, text[:200])
            return None
        raise


def require_modules(modules: dict, spine: str, any_of: list[str]) -> None:
    """Stop when the spine is absent, or when every one of ``any_of`` is."""
    if modules.get(spine) is None:
        raise ValueError(f"spine module {spine} is missing; cannot build the cohort")
    if any_of and all(modules.get(m) is None for m in any_of):
        raise ValueError(f"all critical modules {any_of} are missing")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True) -> DataFrame:
    """CSV with header. An explicit schema is preferred; without one types are
    inferred (an extra pass over the data)."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "csv", run_id: str | None = None,
                mode: str = "error") -> str:
    """Write with header and no index; ``run_id`` makes the folder unique."""
    out = f"{path.rstrip('/')}/run={run_id}" if run_id else path
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(out)
    else:
        w.format(fmt).save(out)
    return out


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows to a table folder (creates it on first use)."""
    df.write.mode("append").format(fmt).save(path)
    return path


def apply_updates(base: DataFrame, updates: DataFrame, key: str, set_cols: dict,
                  guard: list[str] | None = None) -> DataFrame:
    """Keyed conditional update as a new version of ``base``.

    ``updates`` holds ``key`` (+ ``guard`` columns, all of which must equal the
    base row's for the update to apply). Updates are de-duplicated per
    (key, guard) first, so a repeated request cannot multiply base rows; the
    join is then at most one-to-one.
    ``set_cols`` maps column -> new value (Column or literal).
    """
    guard = guard or []
    upd = updates.select(key, *guard).dropDuplicates([key, *guard]) \
        .withColumn("__hit", F.lit(True))
    joined = base.join(upd, on=[key, *guard], how="left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    out = joined.withColumns({c: F.when(hit, v if isinstance(v, F.Column) else F.lit(v))
                              .otherwise(F.col(c)) for c, v in set_cols.items()})
    return out.select(*base.columns)


def rows_from_dicts(spark: SparkSession, dicts: list[dict], names: list[str]) -> DataFrame:
    """Form key-values to rows in feature order; absent keys become null and
    each value goes through a tolerant to-double cast (X1)."""
    from ..functions.scalars import to_float
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    rows = [tuple(None if d.get(n) is None else str(d.get(n)) for n in names) for d in dicts]
    df = spark.createDataFrame(rows, schema)
    return df.select(*[to_float(F.col(n)).alias(n) for n in names])


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: dict[str, int] = {}
_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as it has run, not when the
    driver's memory is next cleaned up: a written table needs them no more. (Run
    once more, such a plan shuffles again.) Threads may overlap."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        if not _CLEANING.get(app):
            _CLEANING[f"{app} before"] = spark.conf.get(CLEANUP)
            spark.conf.set(CLEANUP, "true")
        _CLEANING[app] = _CLEANING.get(app, 0) + 1
    try:
        yield
    finally:
        with _LOCK:
            _CLEANING[app] -= 1
            if not _CLEANING[app]:
                spark.conf.set(CLEANUP, _CLEANING.pop(f"{app} before"))


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing to the shared folder and reading back.

    Survives executor loss (the data lives in the shared folder, not on an
    executor's disk).
    """
    return written_table(df, name)[0]


def written_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``checkpoint_table`` and its folder, for callers that drop it after use
    (``session.drop_path``)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path
