"""Exact order-dependent primitives that never put a whole group in one task.

A plain ``Window.partitionBy(k).orderBy(o)`` sends every row of a key to one
task; with one key holding a third of the data that task is the job. The
helpers here split each ordered group into slices, compute per-slice totals
(a small table), turn those into offsets, and finish with a window over
(group, slice). Results are exact; only the work distribution changes.

* ``prefix_sums``       running sums over a per-group order (ROC, AUC, quantiles)
* ``salted_row_number`` row_number per group with a monotone slice column
* ``exact_quantiles``   linear-interpolated quantiles from value counts
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import checkpoint_table


def _cols(xs) -> list:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the columns are ``left``'s and
    the rest of ``right``'s."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__r_{k}" for k in keys])


def prefix_sums(df: DataFrame, part: list[str], order: str, sums: list[str],
                descending: bool = False, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<s>`` = sum of ``s`` over rows of the same ``part`` whose
    ``order`` value is <= the current one (>= when ``descending``), inclusive.

    ``order`` must be unique within ``part`` (aggregate by it first); null is
    a value of ``part`` like others. Rows are range-partitioned by (part,
    order) into as many ranges as the shuffle width and written once, so that
    both passes see the same ranges. Totals per (range, part) become offsets,
    joined back on both; a window within (range, part) does the rest. A large
    group lies in many ranges, and no join is on the group alone.
    """
    key = F.col(order).desc() if descending else F.col(order).asc()
    ranged = checkpoint_table(
        df.repartitionByRange(shuffle_width(df), *[F.col(c) for c in part], key)
        .withColumn("__range", F.spark_partition_id()), "prefix_ranges")
    totals = ranged.groupBy("__range", *part).agg(*[F.sum(s).alias(s) for s in sums])
    before = Window.partitionBy(*part).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__range", *part, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"__off_{s}")
                                                for s in sums])
    out = join_null_safe(ranged, offsets, ["__range", *part])
    within = (Window.partitionBy("__range", *part).orderBy(key)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = out.withColumns({f"{prefix}{s}": F.col(f"__off_{s}") + F.sum(s).over(within) for s in sums})
    return out.drop("__range", *[f"__off_{s}" for s in sums])


def salted_row_number(df: DataFrame, keys: list[str], order: list, slice_col: Column,
                      name: str = "rn", total: str | None = None, nulls_last: bool = False) -> DataFrame:
    """Exact ``row_number()`` over ``partitionBy(keys).orderBy(order)``.

    ``slice_col`` must be non-decreasing along ``order`` within a key (e.g. the
    second of a timestamp when ordering by time). Rows are numbered inside
    (key, slice) — one exchange, a hot key spreads over as many tasks as it
    has slices — and offset by the row count of the key's earlier slices.
    Null keys are a key, null slices a slice of their own: the first one, or
    with ``nulls_last`` (an order that puts nulls last) the last.
    Slice sizes are read off the numbered rows (already partitioned by
    (key, slice), so no second pass over the input); the offsets table has
    one row per (key, slice) and is joined back by that key. ``total`` names a
    column for the key's row count, which comes with the offsets.
    """
    d = df.withColumn("__slice", slice_col)
    wi = Window.partitionBy(*keys, "__slice").orderBy(*_cols(order))
    numbered = d.withColumn("__rnw", F.row_number().over(wi))
    counts = numbered.groupBy(*keys, "__slice").agg(F.max("__rnw").alias("__n"))
    by = F.col("__slice").asc_nulls_last() if nulls_last else F.col("__slice").asc_nulls_first()
    ws = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "__slice", F.coalesce(F.sum("__n").over(ws), F.lit(0)).alias("__off"),
        *([F.sum("__n").over(Window.partitionBy(*keys)).alias(total)] if total else []))
    out = join_null_safe(numbered, offsets, [*keys, "__slice"])
    return out.withColumn(name, F.col("__off") + F.col("__rnw")).drop("__slice", "__off", "__rnw")


def value_counts_long(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n) with nulls dropped — partial aggregation map-side."""
    return (df.where(F.col(value).isNotNull())
              .groupBy(group, value).agg(F.count(F.lit(1)).alias("n")))


def exact_quantiles(long_df: DataFrame, group: str, value: str, probs: list[float],
                    materialize: bool = True, accuracy: int | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation, like numpy's default) per group.

    ``long_df`` is (group, value). Works on distinct values with counts, so
    repeated values cost nothing; the rank lookup uses ``prefix_sums``.
    Returns (group, p, q). With ``accuracy`` the quantiles are Spark's
    approximate ones instead (relative rank error 1 / accuracy), from one
    aggregate without any order. With ``materialize`` the value-count table (small
    next to the input) is written to the shared folder once, so the several
    passes below do not recompute the input.
    """
    if accuracy:
        return (long_df.where(F.col(value).isNotNull()).groupBy(group)
                .agg(F.percentile_approx(value, probs, accuracy).alias("__q"))
                .select(group, F.explode(F.arrays_zip(F.array(*map(F.lit, probs)).alias("p"), F.col("__q").alias("q"))).alias("x"))
                .select(group, "x.p", "x.q"))
    vc = value_counts_long(long_df, group, value)
    if materialize:
        vc = checkpoint_table(vc, "value_counts")
    cum = prefix_sums(vc, [group], value, ["n"])
    # One row per group with the wanted 0-based ranks: (p, pos, k0, k1).
    targets = F.array(*[F.struct(F.lit(float(p)).alias("p"),
                                 ((F.col("__total") - 1) * F.lit(float(p))).alias("pos"))
                        for p in probs])
    tot = (vc.groupBy(group).agg(F.sum("n").alias("__total"))
             .select(group, F.transform(targets, lambda t: F.struct(
                 t["p"].alias("p"), t["pos"].alias("pos"),
                 F.floor(t["pos"]).cast("long").alias("k0"),
                 F.ceil(t["pos"]).cast("long").alias("k1"))).alias("__t")))
    # Distinct value v covers ranks [cum_n - n, cum_n). Many-to-one join to
    # the group's targets, then keep the (target, end) pairs v covers.
    lo = F.col("cum_n") - F.col("n")
    hits = cum.join(tot, on=group, how="inner").select(
        group, value, F.explode(F.filter(F.transform("__t", lambda t: F.struct(
            t["p"].alias("p"), t["pos"].alias("pos"), t["k0"].alias("k0"),
            ((lo <= t["k0"]) & (t["k0"] < F.col("cum_n"))).alias("is0"),
            ((lo <= t["k1"]) & (t["k1"] < F.col("cum_n"))).alias("is1"))),
            lambda s: s["is0"] | s["is1"])).alias("h"))
    res = hits.groupBy(group, F.col("h.p").alias("p")).agg(
        F.first(F.col("h.pos")).alias("__pos"), F.first(F.col("h.k0")).alias("__k0"),
        F.max(F.when(F.col("h.is0"), F.col(value))).alias("__v0"),
        F.max(F.when(F.col("h.is1"), F.col(value))).alias("__v1"))
    return res.select(group, "p", (F.col("__v0") + (F.col("__v1") - F.col("__v0"))
                                   * (F.col("__pos") - F.col("__k0"))).alias("q"))
