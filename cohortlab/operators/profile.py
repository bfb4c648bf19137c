"""Profiling (A2, A3, A7-A12): the tables behind the source's charts.

Every operator is one or two aggregations with map-side partial
aggregation; per-column work is expressed by unpivoting to (column, value)
so one job covers all columns.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import exact_quantiles


def value_counts(df: DataFrame, c: str, order: str = "value") -> DataFrame:
    """A2: (value, n), nulls excluded, sorted by value or by count desc."""
    vc = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return vc.orderBy("value") if order == "value" else vc.orderBy(F.desc("n"), "value")


def value_share(df: DataFrame, c: str, decimals: int = 2) -> DataFrame:
    """A3: (value, n, pct) with pct rounded half-even; A19 total via a window
    over the (small) value-count table, not over the rows."""
    vc = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    tot = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return vc.select("value", "n", F.bround(F.col("n") * 100.0 / tot, decimals).alias("pct"))


def _numeric_cols(df: DataFrame, cols: list[str] | None) -> list[str]:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    cols = cols or df.columns
    return [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, num)]


def to_long(df: DataFrame, cols: list[str], name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot numeric columns to (column, value double)."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return d.unpivot([], cols, name, value)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, nulls) from a single aggregate over the rows."""
    cols = cols or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "nulls")


def missing_patterns(df: DataFrame, cols: list[str]) -> DataFrame:
    """(pattern, n): pattern is one 0/1 character per column (1 = null),
    in the given order. Replaces one heatmap line per row by pattern counts."""
    pat = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return df.groupBy(pat.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """Equal-width bins from min to max per column, last bin closed, nulls
    dropped; min == max uses [min-0.5, max+0.5] like numpy.

    Returns (column, bin, lo, hi, n) for non-empty bins. Column ranges are one
    row per column (bounded by the column count), joined back by column.
    """
    long = to_long(df, cols).where(F.col("value").isNotNull())
    stats = long.groupBy("column").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    stats = stats.select("column",
                         F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo0"),
                         F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi0"))
    j = long.join(F.broadcast(stats), "column")
    b = F.least(F.floor((F.col("value") - F.col("lo0")) / (F.col("hi0") - F.col("lo0")) * bins),
                F.lit(bins - 1)).cast("int")
    g = j.groupBy("column", b.alias("bin"), "lo0", "hi0").agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi0") - F.col("lo0")) / bins
    return g.select("column", "bin", (F.col("lo0") + F.col("bin") * width).alias("lo"),
                    (F.col("lo0") + (F.col("bin") + 1) * width).alias("hi"), "n")


def box_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: quartiles (exact, linear interpolation), 1.5 IQR whiskers at the
    most extreme points inside the fences, outlier count.

    Quartiles come from ``exact_quantiles`` (value counts + distributed rank
    lookup), so no task ever holds a whole column.
    """
    long = to_long(df, cols).where(F.col("value").isNotNull())
    q = exact_quantiles(long, "column", "value", [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = long.join(F.broadcast(qw), "column")
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col("value") >= lo_f) & (F.col("value") <= hi_f)
    return j.groupBy("column", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"),
        F.count(F.lit(1)).alias("n"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation, pairwise-complete (rows where both are
    non-null), as a long (a, b, r) table with the mirror and diagonal.

    One aggregate computes the k(k-1)/2 distinct pairs; Spark's ``corr``
    skips rows with a null in either argument. A pair without two distinct
    values on either side has no correlation (null); so has such a column with
    itself.
    """
    def r(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        # regr_* parts keep the division out of pairs that have no spread: their running moments are exactly
        # zero as long as all values are equal (every difference from the mean is)
        sxx, syy, sxy = F.regr_sxx(y, x), F.regr_syy(y, x), F.regr_sxy(y, x)
        return sxy / F.nullif(F.sqrt(sxx) * F.sqrt(syy), F.lit(0.0))

    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[r(a, b).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                              (F.when(F.col(f"p{k}").isNotNull(), F.lit(1.0)) if a == b else F.col(f"p{k}")).alias("r"))
                     for k, (a, b) in enumerate(pairs)])
    ab = one.select(F.inline(rows))
    mirror = ab.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return ab.unionByName(mirror)


def profile(df: DataFrame) -> DataFrame:
    """(column, position, type, rows) — row count from one aggregate."""
    n = df.select(F.count(F.lit(1)).alias("rows"))
    meta = df.sparkSession.createDataFrame(
        [(f.name, i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "column string, position int, type string")
    return meta.withColumn("rows", n.scalar())
