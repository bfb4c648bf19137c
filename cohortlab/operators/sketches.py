"""Daily profiles whose quantiles merge (A10, M2 over a growing log).

Exact quantiles need all values of a period again; a day's sketch (KLL) is a few
kilobytes that answer for the day, and the sketches of any days merge into the
sketch of all their rows. So a day is read once, stored once, and periods are
asked of the stored table. Ranks are off by about ``rank_error(k)`` at most (a
chance of one in a hundred per question); up to k values the answer is exact.

Defined results: null and NaN values do not count; a group without values has
no row; a day stored twice under the same name counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versions import append_batch, read_batches

ACCURACY = 800


def rank_error(k: int = ACCURACY) -> float:
    """The published 99% bound of a rank's error, as a share of the rows."""
    return 2.446 / k ** 0.9433


def daily_sketches(df: DataFrame, day: Column, by: list[str], value: str, k: int = ACCURACY) -> DataFrame:
    """(day, by..., rows, low, high, sketch): one row a day and group, merged from
    the tasks' partial sketches."""
    x = F.col(value).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(day.alias("day"), *by).agg(
        F.count("*").alias("rows"), F.min(x).alias("low"), F.max(x).alias("high"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))


def store_day(sketches: DataFrame, path: str, day: str) -> bool:
    """Append a day's sketches once; whether this call added them."""
    return append_batch(sketches, path, f"day-{day}")


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_batches(spark, path, schema).drop("batch")


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by..., rows, low, high, sketch): the sketches of all given days as one a group."""
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"),
                                     F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """(keys..., rows, p, q): a row a sketch and probability."""
    asked = F.array(*[F.struct(F.lit(p).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("q")) for p in probs])
    return sketches.select(*keys, "rows", F.inline(asked))
