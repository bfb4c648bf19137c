"""Expressions and helpers shared by the corpus operators.

A word is a maximal run of characters other than space and U+0009..U+000D.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from ..sources.tables import checkpoint_table, read_table  # noqa: F401  (re-exported)

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def text_of(col: str | Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ids_and_texts(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id long, text), null texts empty; a column that fits is taken as it
    is, so that plans over it compare equal and share their shuffles."""
    fits = id_col == "doc_id" and df.schema[id_col].dataType.simpleString() == "bigint"
    return df.select(F.col("doc_id") if fits else F.col(id_col).cast("long").alias("doc_id"),
                     text_of(text).alias("text"))


def words(text: Column) -> Column:
    """Array of the words of a text, in order (empty for a blank text)."""
    t = F.btrim(text, F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where the body's
    lambdas use it for every element of an array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of ``keys``: the same in every
    run. Rows are first cut to about twice as many by the hash itself, so that
    few reach the final sort, however many tasks there are."""
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    total = df.count()
    if total > 4 * rows:
        df = df.where(place < int(2 * rows / total * (1 << 40)))
    return df.orderBy(place, *keys).limit(rows)


def running_sums(df: DataFrame, order: list[Column], sums: list[str], name: str) -> DataFrame:
    """Adds ``cum_<s>``: the sum of ``s`` over all rows up to this one in the
    order of ``order`` (rows equal in it come in any order).

    Rows are range-partitioned and written once, so that every later pass sees
    the same ranges. One total per range (as many rows as partitions) gives the
    offsets, and a window within each range the rest; no task sees more than a
    range.
    """
    n = shuffle_width(df.sparkSession)
    ranged = checkpoint_table(
        df.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()), name)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("__range").agg(*[F.sum(s).alias(s) for s in sums])
               .select("__range", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"__off_{s}") for s in sums]))
    # one row per range: bounded by the shuffle width
    joined = ranged.join(F.broadcast(offsets), "__range")
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (joined.withColumns({f"cum_{s}": F.col(f"__off_{s}") + F.sum(s).over(within) for s in sums})
            .drop("__range", *[f"__off_{s}" for s in sums]))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def ranges(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Rows sorted by (keys, id) over range partitions: a key with many rows is
    cut into several ranges (see ``split_keys``)."""
    order = [*keys, id_col]
    return df.repartitionByRange(shuffle_width(df.sparkSession), *order).sortWithinPartitions(*order)


def _ends(keys: list[str], id_col: str):
    """The first row of a range's first key, and of its last if that differs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(k).to_numpy() for k in keys]
            new = np.zeros(b.num_rows, dtype=bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(new)
            head = b.slice(0, 1).select([*keys, id_col])
            if first is None:
                first = last = head
            elif any(head.column(k)[0] != last.column(k)[0] for k in keys):
                last = head
            if len(at):
                last = b.slice(int(at[-1]), 1).select([*keys, id_col])
        if first is not None:
            yield first
            if last is not first:
                yield last
    return run


def split_keys(ranged: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Rows of the keys that ``ranges`` cut, with ``owner``: the key's smallest
    id over all ranges. A range cuts two keys at most, so there are no more of
    them than twice the partitions. Both passes read every row and column of
    ``ranged`` (hence the null-safe join), so that its shuffle runs once."""
    kinds = {f.name: f.dataType.simpleString() for f in ranged.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*keys, id_col])
    cut = (map_arrow(ranged, _ends(keys, id_col), schema).groupBy(*keys)
           .agg(F.min(id_col).alias("owner"), F.count("*").alias("n")).where("n > 1")
           .select("owner", *[F.col(k).alias(f"__{k}") for k in keys]))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return ranged.join(F.broadcast(cut), same).drop(*[f"__{k}" for k in keys])
