"""Mixing sources to target weights (DataFrame functions only).

Documents get hash-random keys and are range-sorted by (source, key). One
distributed prefix sum over that order gives each document's place within its
source, and the source's budget cuts there exactly: whole epochs first, then
the documents before the cut; the document at the cut gives only the words
that are left, so that a source's words add up to floor(target).

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating,
and share the total. No target exceeds ``cap`` times its source's size; the
excess goes to the others by weight until none is above. That level is found
in closed form: sources sorted by cap/weight, the capped ones being a prefix.

Defined results: a null text has size 0, a source without words has target 0,
rows of equal id and size are interchangeable, an empty table gives an empty
result, and other columns do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, checkpoint_table, running_sums, text_of

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 17


def word_count(text: str = "text"):
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def random_key(id_: Column, seed: int) -> Column:
    """A hash of seed and id, the same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null"))))


def by_source() -> list:
    return [F.col("source").isNull(), F.col("source")]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, source_start, target): one row per source.

    ``source_start`` is the number of words in earlier sources."""
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("one", F.lit(1)))
    s = running_sums(s, by_source(), ["one", "source_size"], "mix_sources")
    turn = F.pmod(F.col("cum_one") - 1, F.lit(len(weights)))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))
    s = s.select("source", "source_size", (F.col("cum_source_size") - F.col("source_size")).alias("source_start"),
                 "weight", (F.col("source_size") * cap).alias("limit"))
    ratio = F.col("limit") / F.col("weight")
    s = running_sums(s.withColumn("ratio", ratio), [F.col("ratio"), *by_source()], ["limit", "weight"], "mix_caps")
    s = checkpoint_table(s, "mix_levels")
    totals = s.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    # Were this source the first that is not capped, the level would be:
    rest = F.lit(totals["words"] or 0) - (F.col("cum_limit") - F.col("limit"))
    level = rest / (F.lit(totals["weight"] or 1) - (F.col("cum_weight") - F.col("weight")))
    found = s.where(level <= F.col("ratio")).agg(
        F.min_by(level, F.struct("ratio", F.col("source").isNull(), "source")).alias("level")).first()["level"]
    share = F.lit(found) * F.col("weight") if found is not None else F.lit(0.0)
    return s.select("source", "source_size", "source_start",
                    F.least(F.col("limit").cast("double"), share).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text: str = "text",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """(id, size, source_size, target, taken) for every row of ``df``."""
    sizes = checkpoint_table(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                       word_count(text).alias("size"))
                             .withColumn("key", random_key(F.col("id"), seed)), "mix_sizes")
    targets = source_targets(sizes, weights, cap)
    placed = running_sums(sizes, [*by_source(), F.col("key"), F.col("id")], ["size"], "mix_order")
    d = placed.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    budget = F.floor(F.col("target")).cast("long")
    whole = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))).cast("long"), F.lit(0).cast("long"))
    left = budget - whole * F.col("source_size")
    before = F.col("cum_size") - F.col("size") - F.col("source_start")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left - before))
    return d.select(F.col("id").alias(id_col), "size", "source_size", "target",
                    taken.cast("long").alias("taken"))
