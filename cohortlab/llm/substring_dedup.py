"""Substring deduplication by level-wise doubling of repeated word windows.

Level 1 looks at windows of half the wanted length. Of the half windows that
lie in a full window, only the one with the smallest hash stands for it, so
about one in thirteen is shuffled; equal full windows have equal stand-ins.
Half windows found in one text alone end there. At the next level only full
windows whose stand-in repeated are hashed (96 bits) and shuffled; those found
in a document with a smaller id are repeats, and the words they cover go.
``repeats`` goes on doubling: windows repeated at one length are extended to
twice that length until no candidates survive.

Of documents with equal texts, only the one with the smallest id takes part;
in its copies every window starts in it, so all words go if there are enough
for one window.

Skew: a text enters each of its windows once, however often it has it; half
windows are pre-aggregated before they are shuffled; full windows are sorted
over ranges of (window, id), so that a very frequent one takes several tasks.

Defined results: a null text has no words; a null id is larger than all others
(such rows lose words to no one and take none); rows of equal id count as one
document; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_table, ids_and_texts, map_arrow, ranges, split_keys
from .text_arrays import FIRST, SECOND, Words, sliding_min, texts

MIN_WORDS = 50
ROWS = 1 << 17


def stand_ins(w: Words, half: int, size: int) -> np.ndarray:
    """Per full window the smallest hash of the half windows within it."""
    return sliding_min(w.windows(half), size - half + 1)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _seeds(half: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = b.column("doc_id"), b.column("text_key")
            for lo, hi, data, offsets in texts(b, "text"):
                w = Words(data, offsets)
                full = w.full(size)
                small = stand_ins(w, half, size)
                owner = np.repeat(np.arange(hi - lo), np.diff(w.first))
                at = np.flatnonzero(full)
                at = at[np.lexsort((small[at], owner[at]))]
                at = at[_changes(owner[at], small[at])]
                rows = pa.array(owner[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(small[at].view(np.int64)), ids.take(rows), keys.take(rows)], ["h", "doc_id", "text_key"])
    return run


def _hashed(w: Words, size: int, at: np.ndarray, lo: int, ids: pa.Array) -> Iterator[pa.RecordBatch]:
    """Rows (h1, h2, doc_id, pos, more) of the windows that start at words
    ``at``: one row for each distinct window of a text, ``more`` being its
    places after the first (null if there are none)."""
    owner = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))[at]
    place = (at - w.first[owner]).astype(np.int32)
    h1 = w.windows(size)[at].view(np.int64)
    h2 = (w.windows(size, 1, SECOND)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    order = np.lexsort((place, h2, h1, owner))
    owner, place, h1, h2 = owner[order], place[order], h1[order], h2[order]
    first = np.flatnonzero(_changes(owner, h1, h2))
    last = np.append(first[1:], len(owner))
    who = ids.take(pa.array(owner[first] + lo))
    more = [place[s + 1:e] if e > s + 1 else None for s, e in zip(first.tolist(), last.tolist(), strict=True)] \
        if len(first) < len(owner) else [None] * len(first)
    for k in range(0, len(first), ROWS):
        part = first[k:k + ROWS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(h1[part]), pa.array(h2[part]), who[k:k + ROWS], pa.array(place[part]),
             pa.array(more[k:k + ROWS], pa.list_(pa.int32()))], ["h1", "h2", "doc_id", "pos", "more"])


def _first_level(half: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = b.column("hs")
            for lo, hi, data, offsets in texts(b, "text"):
                w = Words(data, offsets, (FIRST, SECOND))
                small = stand_ins(w, half, size).view(np.int64)
                hit = np.zeros(len(small), dtype=bool)
                for i in range(lo, hi):
                    s, e = w.first[i - lo], w.first[i - lo + 1]
                    hit[s:e] = np.isin(small[s:e], known[i].values.to_numpy(zero_copy_only=False))
                yield from _hashed(w, size, np.flatnonzero(hit & w.full(size)), lo, b.column("doc_id"))
    return run


def _next_level(size: int):
    """Windows of twice ``size`` whose two halves both repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = b.column("at")
            for lo, hi, data, offsets in texts(b, "text"):
                w = Words(data, offsets, (FIRST, SECOND))
                hit = np.zeros(len(w.starts) + size, dtype=bool)
                for i in range(lo, hi):
                    hit[w.first[i - lo] + known[i].values.to_numpy(zero_copy_only=False)] = True
                both = hit[:-size] & hit[size:]
                yield from _hashed(w, 2 * size, np.flatnonzero(both & w.full(2 * size)), lo, b.column("doc_id"))
    return run


def _remove(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known, copy = b.column("at"), b.column("copy").to_pylist()
            for lo, hi, data, offsets in texts(b, "text"):
                w = Words(data, offsets, ())
                raw = data.tobytes()
                counts, kept = np.diff(w.first), []
                removed = np.zeros(hi - lo, dtype=np.int64)
                for i in range(lo, hi):
                    s, n = int(w.first[i - lo]), int(counts[i - lo])
                    keep = np.arange(s, s + n)
                    if copy[i] and n >= size:
                        keep = keep[:0]
                    elif known[i].is_valid:
                        p = known[i].values.to_numpy(zero_copy_only=False)
                        p = p[p <= n - size]
                        edges = np.bincount(p, minlength=n + 1) - np.bincount(p + size, minlength=n + 1)
                        keep = keep[np.cumsum(edges[:n]) == 0]
                    removed[i - lo] = n - len(keep)
                    kept.append(b" ".join([raw[x:y] for x, y in zip(
                        w.starts[keep].tolist(), w.ends[keep].tolist(), strict=True)]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], pa.array(counts.astype(np.int64)), pa.array(removed),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


WINDOW_ROWS = "h1 long, h2 int, doc_id long, pos int, more array<int>"


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by (h1, h2, doc_id), those that are not of the first
    document that has them here."""
    last = (None, None, None)
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, ids = (b.column(k).to_numpy() for k in ("h1", "h2", "doc_id"))
        start = np.maximum.accumulate(np.where(_changes(h1, h2), np.arange(len(h1)), 0))
        owner = ids[start]
        if (h1[0], h2[0]) == last[:2]:
            owner[start == 0] = last[2]
        last = (h1[-1], h2[-1], owner[-1])
        yield b.filter(pa.array(ids > owner)).select(["doc_id", "pos", "more"])


def _places(rows: DataFrame) -> DataFrame:
    """(doc_id, at): all places of the windows of ``rows``; a document has no
    more than it has words."""
    here = F.concat(F.array("pos"), F.coalesce("more", F.array().cast("array<int>")))
    return rows.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list(here))).alias("at"))


def _starts_later(windows: DataFrame) -> DataFrame:
    """Windows that also start in a smaller id. Rows are sorted by window over
    ranges, so a very frequent window takes several tasks; those windows are
    compared with their first document over all ranges as well."""
    keys = ["h1", "h2"]
    ranged = ranges(windows.where("doc_id is not null"), keys, "doc_id")
    cut = split_keys(ranged, keys, "doc_id").where("owner < doc_id").select("doc_id", "pos", "more")
    return map_arrow(ranged, _later, "doc_id long, pos int, more array<int>").union(cut)


def _starts_anywhere(windows: DataFrame) -> DataFrame:
    """Windows found in two documents or more."""
    shared = (windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
              .where("lo < hi").select("h1", "h2"))
    return windows.join(shared, ["h1", "h2"]).select("doc_id", "pos", "more")


def _full_windows(keyed: DataFrame, sole: DataFrame, size: int) -> DataFrame:
    """Full windows of the ``sole`` rows whose stand-in lies in two texts or more."""
    half = (size + 1) // 2
    seeds = checkpoint_table(map_arrow(
        keyed, _seeds(half, size), "h long, doc_id long, text_key long"), "window_seeds")
    shared = (seeds.groupBy("h").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi"))
              .where("lo <> hi").select("h"))
    alive = seeds.select("h", "doc_id").join(shared, "h").groupBy("doc_id").agg(F.collect_set("h").alias("hs"))
    return map_arrow(sole.join(alive, "doc_id"), _first_level(half, size), WINDOW_ROWS)


def _prepared(df: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(docs, docs with a text key, ids that come first among equal texts)."""
    docs = ids_and_texts(df, id_col, text)
    firsts = docs.groupBy(F.sha2("text", 256)).agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    return docs, docs.withColumn("text_key", F.xxhash64("text")), firsts


def repeats(df: DataFrame, size: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, pos, length): windows found in two or more documents with different
    texts, for length ``size``, twice ``size`` and so on until none is left."""
    docs, keyed, firsts = _prepared(df, id_col, text)
    sole = docs.join(firsts, "doc_id", "left_semi")
    found = checkpoint_table(_starts_anywhere(_full_windows(keyed, sole, size)), "repeats")
    levels, length = [], size
    while not found.isEmpty():
        places = _places(found)
        levels.append(places.select("doc_id", F.explode("at").alias("pos"), F.lit(length).alias("length")))
        found = checkpoint_table(_starts_anywhere(map_arrow(
            sole.join(places, "doc_id"), _next_level(length), WINDOW_ROWS)), "repeats")
        length *= 2
    out = levels[0] if levels else found.select("doc_id", "pos", F.lit(size).alias("length"))
    for level in levels[1:]:
        out = out.union(level)
    return out.withColumnRenamed("doc_id", id_col)


def remove_repeats(df: DataFrame, size: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): ``kept`` is the text of the words that
    no window of ``size`` words which also starts in a smaller id covers, joined
    by one space. Longer windows cover nothing more, so doubling ends at ``size``."""
    docs, keyed, firsts = _prepared(df, id_col, text)
    # the same rows and columns in every join, so that their shuffle by id runs once
    known, rest = docs.where("doc_id is not null"), docs.where("doc_id is null")
    sole = known.join(firsts, "doc_id", "left_semi")
    places = _places(_starts_later(_full_windows(keyed, sole, size)))
    marked = (known.join(firsts.withColumn("first", F.lit(True)), "doc_id", "left")
              .join(places, "doc_id", "left").select("doc_id", "text", F.col("first").isNull().alias("copy"), "at"))
    rest = rest.select("doc_id", "text", F.lit(False).alias("copy"), F.lit(None).cast("array<int>").alias("at"))
    done = map_arrow(marked.union(rest), _remove(size), "doc_id long, n_words long, n_removed long, kept string")
    return done.withColumnRenamed("doc_id", id_col)
