"""What each of several filters does alone, together and in every order.

Every row gets a mask with one bit per filter that it fails, and rows are
counted by (part, mask): at most 2^k cells for k filters. Per part, a walk over
all subsets of the filters in Gray-code order toggles one filter at a time. It
keeps, for each cell, the number of active filters that the cell fails, and the
running survivors: a cell leaves when its counter goes from 0 to 1 and comes
back when it returns to 0. The 2^k survivor states are stored; what a filter
removes as a step of any order is the difference of two of them.

The last filter, exact copies, fails a row whose text also has a smaller id
anywhere in the table. Rows are counted by text hash before one row per (hash,
part, label) meets the others of its hash, so a large group of copies costs each
task one row.

Defined results: null text is empty; null part is the empty string; a row of
null id is no copy, nobody's original and has no labels; several label rows of
an id count as good (toxic) if one of them is; repeated rows count each; rows of
equal id and text are not copies of each other; an empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import let, text_of, words

COUNTS = ("kept", "good", "toxic")
MIN_WORDS = 100


def _few_distinct(text: Column) -> Column:
    return let(words(text), lambda ws: 100 * F.size(F.array_distinct(ws)) < 80 * F.size(ws))


def default_filters(text: Column) -> dict[str, Column]:
    """Failure conditions by letter, of a text that is not null."""
    return {
        "A": F.size(words(text)) < MIN_WORDS,
        "B": _few_distinct(text),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, filters: dict[str, Column], labels: DataFrame, part: str, id_col: str,
                  text: str) -> DataFrame:
    """(doc_id, salt, h, part, mask, good, toxic): rows with the bits of
    ``filters`` and their labels. Null ids are spread by the text's hash."""
    mask = F.lit(0)
    for bit, fails in enumerate(filters.values()):
        mask = mask + F.when(fails, 1 << bit).otherwise(0)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.unhex(F.sha2(text_of(text), 256)).alias("h"),
                       F.coalesce(F.col(part), F.lit("")).alias("part"), mask.cast("int").alias("mask"))
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("h"), F.lit(1 << 16))).otherwise(0))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("salt", F.lit(0).cast("long"))
    return rows.join(marks, ["doc_id", "salt"], "left").withColumns(
        {k: F.coalesce(k, F.lit(False)) for k in ("good", "toxic")})


def cells(masks: DataFrame, copy_bit: int) -> DataFrame:
    """(part, mask, kept, good, toxic): row counts per mask, ``copy_bit`` added
    to the rows whose hash also has a smaller id."""
    group = ["h", "part", "mask", "good", "toxic"]
    # one row per id first (no further shuffle: the labels were joined by id), so that the rows of the smallest
    # id can be told even if it is repeated
    by_id = masks.groupBy("doc_id", "salt", *group).agg(F.count("*").alias("c"))
    by_hash = by_id.groupBy(*group).agg(
        F.min("doc_id").alias("low"), F.min_by("c", "doc_id").alias("low_rows"), F.sum("c").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("c")).otherwise(0)).alias("unknown"))
    # as many rows per hash as (part, label) combinations hold it
    owners = by_hash.groupBy("h").agg(F.min("low").alias("owner"))
    met = by_hash.join(owners, "h")
    first = F.when(F.col("low") == F.col("owner"), F.col("low_rows")).otherwise(0) + F.col("unknown")
    both = F.array(F.struct("mask", first.alias("n")),
                   F.struct((F.col("mask") + copy_bit).alias("mask"), (F.col("n") - first).alias("n")))
    split = met.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("kept"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def gray_walk(counts: list[tuple[int, tuple[int, ...]]], k: int) -> list[tuple[int, ...]]:
    """Survivor counts of all 2^k sets of active filters, from the cells
    (mask, counts). Each step toggles the filter whose bit changes."""
    active = [0] * len(counts)
    alive = [sum(c[x] for _, c in counts) for x in range(len(COUNTS))]
    states: list[tuple[int, ...]] = [()] * (1 << k)
    states[0] = tuple(alive)
    for step in range(1, 1 << k):
        bit = (step & -step).bit_length() - 1
        subset = step ^ (step >> 1)
        on = subset >> bit & 1
        for cell, (mask, c) in enumerate(counts):
            if not mask >> bit & 1:
                continue
            active[cell] += 1 if on else -1
            if on and active[cell] == 1:
                alive = [a - v for a, v in zip(alive, c, strict=True)]
            elif not on and active[cell] == 0:
                alive = [a + v for a, v in zip(alive, c, strict=True)]
        states[subset] = tuple(alive)
    return states


def order_steps(states: list[tuple[int, ...]], letters: str) -> list[dict]:
    """One row per order of the filters and step, from the survivor states."""
    full = (1 << len(letters)) - 1
    fails = [states[0][0] - states[1 << b][0] for b in range(len(letters))]
    alone = [states[full & ~(1 << b)][0] - states[full][0] for b in range(len(letters))]
    rows, total = [], [0] * len(letters)
    for order in permutations(range(len(letters))):
        before = 0
        for step, b in enumerate(order, 1):
            old, new = states[before], states[before | 1 << b]
            kept, good, toxic = (x - y for x, y in zip(old, new, strict=True))
            rows.append({"filter_order": "".join(letters[x] for x in order), "step": step, "kept": new[0],
                         "removed": kept, "redundant": fails[b] - kept, "unique_fails": alone[b],
                         "good_lost": good, "toxic_lost": toxic, "bit": b})
            total[b] += kept
            before |= 1 << b
    for r in rows:
        r["shapley"] = total[r.pop("bit")]
    return rows


RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, copies: str = "E",
          part: str = "lang", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``filters`` maps letters to failure conditions (never null) over ``docs``,
    in the order of their bits; ``copies`` is the letter of the exact-copy
    filter. ``labels`` has doc_id, quality and toxic. All orders are returned,
    so the number of filters should stay small (k! rows times k a part).
    """
    filters = default_filters(text_of(text)) if filters is None else filters
    letters = "".join(filters) + copies
    ship_package(docs.sparkSession)

    def steps(frame: pd.DataFrame) -> pd.DataFrame:  # at most 2^k cells of one part
        found = [(int(m), tuple(int(x) for x in c)) for m, *c in frame[["mask", *COUNTS]].itertuples(index=False)]
        out = pd.DataFrame(order_steps(gray_walk(found, len(letters)), letters))
        out.insert(0, "part", frame["part"].iloc[0])
        return out

    counted = cells(failure_masks(docs, filters, labels, part, id_col, text), 1 << (len(letters) - 1))
    return counted.groupBy("part").applyInPandas(steps, RESULT)
