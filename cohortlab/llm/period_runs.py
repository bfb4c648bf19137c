"""Periodic runs of words, by recompression.

A run is a stretch of words with smallest period q and length at least
max(least, exponent * q) that no neighbouring word extends keeping period q.

Grammar. The words of a batch of texts (64-bit hashes, with symbols of their own
before, between and after the texts) are compressed in rounds: every block of
one repeated symbol becomes a symbol of (symbol, length), then a hash bit deals
the symbols into left and right ones and every pair (left, right) becomes a
symbol. Names are hashes of what they stand for, so equal symbols of a level
stand for equal words, and equal stretches are cut alike but for their ends.
This is a run-length grammar of O(log n) levels; each level keeps the symbol,
its parent, and each parent's first child.

Extension queries. How far the words from places i and j agree (to either side)
is found by climbing: at each level, while one of the two symbols is not the
outermost child of its parent, both move over what is left of the shorter rest;
if the symbols agree and both are outermost, they climb to their parents; the
first difference then descends through the first (last) children, moving over
the one equal child that a level may have. Many queries run at once.

Candidates. A run of period q holds four consecutive multiples of q, all of the
same word. For each q the words at multiples of q (n/q of them; n log n in all)
give stretches of three equal steps; the first place of each is extended both
ways, places that the run found covers are dropped, the rest follow. A period
that is a multiple of a smaller one gives the same stretch, where the smallest
period stays.

Defined results: null and blank texts have no words, no runs and an empty
collapsed text; repeated rows give repeated results; null ids stay; an empty
table gives an empty result; other columns play no part. Long texts are taken
whole (about 100 bytes of memory a word).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ids_and_texts, let, map_arrow, words
from .text_arrays import Words, mix, texts

EXPONENT = 4
LEAST = 6
WAITING = 1 << 20  # places extended at once
_U64 = np.uint64
_BLOCK, _LEFT, _RIGHT, _EDGE = (_U64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


@dataclass
class Level:
    """Symbols, the parent of each, the first child of each parent (and one more),
    and whether parents stand for blocks (else for pairs)."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    blocks: bool


def _parents(is_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(is_first).astype(np.int64)
    return (np.cumsum(is_first) - 1).astype(np.int32), np.append(first, len(is_first))


def grammar(symbols: np.ndarray) -> list[Level]:
    """Levels of block and pair compression, down to one symbol."""
    levels, seed = [], 0
    while len(symbols) > 1:
        is_first = np.ones(len(symbols), dtype=bool)
        is_first[1:] = symbols[1:] != symbols[:-1]
        if not is_first.all():
            parent, first = _parents(is_first)
            levels.append(Level(symbols, parent, first, True))
            length = np.diff(first).astype(np.uint64)
            head = symbols[first[:-1]]
            symbols = np.where(length > 1, mix(mix(head + _BLOCK) + length), head)
        if len(symbols) < 2:
            break
        seed += 1
        right = (mix(symbols ^ mix(np.full(1, seed, np.uint64))) & _U64(1)).astype(bool)
        is_first = np.ones(len(symbols), dtype=bool)
        is_first[1:] = right[:-1] | ~right[1:]
        if not is_first.all():
            parent, first = _parents(is_first)
            levels.append(Level(symbols, parent, first, False))
            head, pair = symbols[first[:-1]], np.diff(first) == 2
            named = head.copy()
            named[pair] = mix(mix(head[pair] * _LEFT) + mix(symbols[first[:-1][pair] + 1] ^ _RIGHT))
            symbols = named
    return levels


def extension(levels: list[Level], i: np.ndarray, j: np.ndarray, ahead: bool) -> np.ndarray:
    """How many symbols agree from the places ``i`` and ``j`` (different ones) on,
    both included, forwards or backwards. The ends of the whole array must hold
    symbols found nowhere else."""
    sign = 1 if ahead else -1
    x, y = i.astype(np.int64), j.astype(np.int64)
    height = np.zeros(len(x), dtype=np.int16)
    live = np.arange(len(x))

    def rest(level: Level, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a symbol is its parent's outermost, symbols of the parent from it on)."""
        p = level.parent[at]
        lo, hi = level.first[p], level.first[p + 1]
        return (at == lo, hi - at) if ahead else (at == hi - 1, at - lo + 1)

    for k, level in enumerate(levels):  # climb
        a, b = x[live], y[live]
        for _ in range(2):
            (outer_a, rest_a), (outer_b, rest_b) = rest(level, a), rest(level, b)
            step = np.where(~(outer_a & outer_b) & (level.symbols[a] == level.symbols[b]), np.minimum(rest_a, rest_b), 0)
            a, b = a + sign * step, b + sign * step
        same = level.symbols[a] == level.symbols[b]
        x[live], y[live] = np.where(same, level.parent[a], a), np.where(same, level.parent[b], b)
        height[live] = np.where(same, k + 1, k)
        live = live[same]
        if not len(live):
            break
    for k in range(int(height.max(initial=0)) - 1, -1, -1):  # descend
        level = levels[k]
        down = np.flatnonzero(height > k)
        a, b = ((level.first[v[down]] if ahead else level.first[v[down] + 1] - 1) for v in (x, y))
        over = np.minimum(rest(level, a)[1], rest(level, b)[1]) if level.blocks else 1
        step = np.where(level.symbols[a] == level.symbols[b], over, 0)
        x[down], y[down] = a + sign * step, b + sign * step
    return np.abs(x - i)


def _extend(levels: list[Level], at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the stretch of period ``q`` around the places ``at`` and ``at + q``."""
    return at - extension(levels, at, at + q, False) + 1, at + q + extension(levels, at, at + q, True)


def _answered(levels: list[Level], at: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, end, q) of the stretches around places sorted by (q, at), where a
    place lies in no stretch that another of its q has given already."""
    for turn in range(4):
        if not len(at):
            return
        head = np.ones(len(at), dtype=bool)
        if turn < 3:  # one place of each row of neighbours on the grid; then all that are left
            head[1:] = (q[1:] != q[:-1]) | (at[1:] - at[:-1] != q[1:])
        start, end = _extend(levels, at[head], q[head])
        yield start, end, q[head]
        reach = end[np.cumsum(head) - 1]
        left = ~head & (at + q >= reach)
        at, q = at[left], q[left]


def runs_of(symbols: np.ndarray, longest: int, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs among ``symbols``, by start and
    period; no run spans more than ``longest`` symbols."""
    if exponent < 4:
        raise ValueError("the grid finds runs of exponent 4 and more")
    levels: list[Level] | None = None
    found, at, periods, waiting = [], [], [], 0

    def answer() -> None:
        nonlocal levels, waiting
        if waiting and levels is None:
            levels = grammar(symbols)
        for start, end, q in _answered(levels, np.concatenate(at), np.concatenate(periods)) if waiting else ():
            keep = end - start >= np.maximum(least, exponent * q)
            found.append(np.stack([start[keep], end[keep], q[keep]], axis=1))
        at.clear()
        periods.clear()
        waiting = 0

    for q in range(1, longest // exponent + 1):
        grid = symbols[::q]
        same = grid[1:] == grid[:-1]
        places = np.flatnonzero(same[2:] & same[1:-1] & same[:-2])
        if len(places):
            at.append(places * q)
            periods.append(np.full(len(places), q))
            waiting += len(places)
            if waiting > WAITING:
                answer()
    answer()
    if not found:
        return np.empty((0, 3), dtype=np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), dtype=bool)  # of equal stretches, the smallest period
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _bounded(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an edge symbol before, between and after the texts, and
    the place of each text's first word among them."""
    n = len(w.first) - 1
    counts = np.diff(w.first)
    begin = w.first[:-1] + np.arange(n) + 1
    out = np.empty(len(w.starts) + n + 1, dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[0] = False
    inner[begin + counts] = False
    out[inner] = w.hashes[0][w.first[0]:w.first[-1]]
    out[~inner] = mix(_EDGE + np.arange(n + 1, dtype=np.uint64))
    return out, begin


def joined(data: np.ndarray, w: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and bounds of the texts made of the kept words, joined by one space."""
    n = len(w.first) - 1
    owner = np.repeat(np.arange(n), np.diff(w.first))[keep]
    starts, ends = w.starts[keep], w.ends[keep]
    more = np.zeros(len(owner), dtype=bool)
    more[:-1] = owner[1:] == owner[:-1]
    out = data.copy()
    out[ends[more]] = 32  # a word that another follows has a blank behind it
    turn = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(turn, starts, 1)
    np.add.at(turn, ends + more, -1)
    inside = np.cumsum(turn[:-1]) > 0
    bounds = np.concatenate([[0], np.cumsum(inside)])[w.offsets]
    return out[inside], bounds


RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _find(exponent: int, least: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in texts(b, "text"):
                w = Words(data, offsets)
                symbols, begin = _bounded(w)
                rows = runs_of(symbols, int(np.diff(w.first).max(initial=0)), exponent, least)
                owner = np.searchsorted(begin, rows[:, 0], side="right") - 1
                turn = np.zeros(len(symbols) + 1, dtype=np.int64)
                np.add.at(turn, rows[:, 0] + rows[:, 2], 1)
                np.add.at(turn, rows[:, 1], -1)
                row_of = np.repeat(np.arange(hi - lo), np.diff(w.first))
                keep = np.cumsum(turn)[np.arange(len(w.starts)) + row_of + 1] == 0
                kept, bounds = joined(data, w, keep)
                bounds = bounds.astype(np.int64)
                out = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(bounds), pa.py_buffer(kept))
                cut = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays(
                    [pa.array(rows[:, 0] - begin[owner]), pa.array(rows[:, 1] - rows[:, 0]), pa.array(rows[:, 2])],
                    fields=list(kind))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], pa.array(np.diff(w.first).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(cut), values), out.cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text: str = "text", exponent: int = EXPONENT,
                  least: int = LEAST) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row: the runs by start and period
    (places are word numbers from 0), and the text without the words that a run
    holds after its first period, the rest joined by one space."""
    docs = ids_and_texts(df, id_col, text)
    return map_arrow(docs, _find(exponent, least), RESULT).withColumnRenamed("doc_id", id_col)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and
    digests of all runs and of the collapsed text."""
    c = F.col
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(
        ",", r.start.cast("string"), r.length.cast("string"), F.concat(r.period.cast("string"), F.lit("\n")))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    rows = found.select(id_col, "runs", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        lines.alias("lines"))
    length, period = c("best.length"), -c("best.period")
    return rows.select(
        id_col, "n_runs", (-c("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        ((1000 * length - (1000 * length) % period) / period).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_period(text: Column, doc_id: Column) -> Column:
    """The text, but for ids whose crc32 ends in 0 repeated from a word on: word
    i >= a becomes word a + (i - a) % p, with a and p taken from the hash."""
    h = F.crc32(doc_id.cast("string"))
    g = (h - h % 10) / 10

    def repeated(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        whole = g.cast("long")
        a = whole % n
        part = 3 + whole % 8
        p = 1 + ((n - a - (n - a) % part) / part).cast("long")
        return F.when(n == 0, "").otherwise(F.array_join(F.transform(
            ws, lambda w, i: F.when(i < a, w).otherwise(F.get(ws, (a + (i - a) % p).cast("int")))), " "))

    return F.when(h % 10 == 0, let(words(text), repeated)).otherwise(text)
