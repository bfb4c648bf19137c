"""N-gram Jaccard join with set-relation skipping.

A document's set holds the 64-bit hashes of its distinct word n-grams. Two
documents link when their sets' Jaccard similarity reaches ``percent``.

Index lists, skipped by position: hashing deals a set into positions (segments)
whose number m depends on its size class. Sets that link differ in at most H
n-grams, so with m = H + 2 positions and a little over, one that is not empty
is equal in both. The index therefore has one list per (class, position,
content of the position): a set reads the lists of its own positions alone and
skips every entry that sits at another position or holds anything else there.
Sets near the upper end of their class also enter the next one. (A set with
more empty positions than m allows for enters those as well.)

At a low threshold a position holds few n-grams, and a common one that is alone
there puts all its documents into one list. ``rare`` has a list per n-gram
instead, which a set enters with its least common n-grams alone, as many as
linked sets must share one of. A part of the documents tells which are common.

Answers from similar sets: the first set of a list is its pivot, and its
overlaps with the members of its lists are counted first. Members that link
with the pivot are one component without looking at each other. For any other
pair x, y of members, |x & y| is at most min(|x & p|, |y & p|) plus
min(|x - p|, |y - p|), both known from the pivot's answers; pairs whose bound
does not reach the threshold are skipped and only the rest are counted. The
members of a pivot are compared in blocks, several tasks sharing a large group.
Before any text is shuffled for that, members are compared by sketches (parities
of their n-grams over twice as many bits): the bits in which two sketches differ
are n-grams that the sets differ in, so members that cannot link with any other
of their group drop out.

Documents with equal sets are one class (128-bit hash of the set), whose
smallest id stands for it; a task enters a set once, so a large group of copies
costs each list at most one row per task. Lists are sorted over ranges of (list, id)
and streamed, so a very long one takes several tasks; its members are paired
with its first set over all ranges as well.

Defined results: null and blank texts have an empty set and link with nothing;
a text of fewer than n words is one n-gram; rows of null id get a null
component; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_table, ids_and_texts, map_arrow, ranges, shuffle_width, split_keys
from .components import components
from .text_arrays import PIECE, Words, lower_ascii, mix, texts

SHINGLE = 4
PERCENT = 85
RATIO = 1.3
BLOCK = 1024
CELLS = 4096
COUNTED = 16     # one document in as many is read to find common n-grams
OFTEN = 4        # documents of those that have a common one
NAMED = 1 << 18  # common n-grams that go to the tasks
_U64 = np.uint64


class Classes:
    """Size classes [low, high] and the number of positions of each."""

    def __init__(self, percent: int, most: int = 1 << 40):
        self.percent, self.lows, self.highs, self.parts, self.spare = percent, [], [], [], []
        low = 1
        while low <= most:
            high = max(low, math.floor(low * max(RATIO, 100 / percent)))
            # |x| + |y| - 2|x & y| with |x & y| >= p/(100 + p) (|x| + |y|) and both sizes at most high;
            # it never falls from one total to the next but one, so the largest even and odd totals bound it
            differ = max(both - 2 * -(-percent * both // (100 + percent)) for both in (2 * high - 1, 2 * high))
            spare = 1 + differ // 50
            self.lows.append(low)
            self.highs.append(high)
            self.parts.append(differ + 1 + spare)
            self.spare.append(spare)
            low = high + 1
        self.lows = np.array(self.lows)
        self.parts = np.array(self.parts)
        self.spare = np.array(self.spare)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, n, side="right") - 1

    def also_next(self, n: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Whether a set of size n can link with one of the next class."""
        return 100 * n >= self.percent * self.lows[c + 1]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, concatenated, and their bounds."""
    w = Words(lower_ascii(data), offsets)
    counts = np.diff(w.first)
    grams = w.windows(size)
    full = w.full(size)
    short = {}
    for k in range(1, size):
        rows = np.flatnonzero(counts == k)
        if len(rows):
            short.update(zip(rows.tolist(), mix(w.windows(k)[w.first[rows]] + _U64(k)).tolist(), strict=True))
    for r, h in short.items():
        at = w.first[r]
        grams[at], full[at] = h, True
    h = grams[full]
    bounds = _before(full)[w.first]
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):  # text by text, far faster than all by two keys
        h[s:e].sort()
    first = np.ones(len(h), dtype=bool)
    first[1:] = h[1:] != h[:-1]
    first[bounds[:-1][bounds[:-1] < len(h)]] = True
    return h[first], _before(first)[bounds]


def _before(marks: np.ndarray) -> np.ndarray:
    """How many marks are set before each place, and in all."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(marks)])


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def identities(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify each set."""
    return (_sums(mix(h + _U64(0x9E3779B97F4A7C15)), at).view(np.int64),
            _sums(mix(h ^ _U64(0xD1B54A32D192ED03)), at).view(np.int64))


def sketches(h: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Per set, the parities of its n-grams over 2^k >= 2n bits."""
    place = mix(h ^ _U64(0x8EBC6AF09C88C6E3))
    out = []
    for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        bits = 1 << max(6, (2 * (e - s) - 1).bit_length())
        odd = np.bincount((place[s:e] & _U64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8)).tobytes())
    return out


def _nodes(size: int, sketch: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in texts(b, "text"):
                h, at = shingle_sets(data, offsets, size)
                k1, k2 = identities(h, at)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], pa.array(np.diff(at).astype(np.int64)), pa.array(k1), pa.array(k2),
                     pa.array(sketches(h, at) if sketch else [None] * (hi - lo), pa.binary())], ["doc_id", "n", "k1", "k2", "sketch"])
    return run


def entries(h: np.ndarray, at: np.ndarray, rows: np.ndarray, classes: Classes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, list key) of the index entries of the sets ``rows``."""
    n = np.diff(at)
    own = classes.of(n[rows])
    more = classes.also_next(n[rows], own)
    for chosen, c in ((rows, own), (rows[more], own[more] + 1)):
        if not len(chosen):
            continue
        m = classes.parts[c]
        base = np.concatenate([[0], np.cumsum(m)])
        sizes = n[chosen]
        who = np.repeat(np.arange(len(chosen)), sizes)
        flat = np.repeat(at[chosen] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(who))
        values = h[flat]
        cell = base[who] + (mix(values ^ _U64(0xA0761D6478BD642F)) % m[who].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(base[-1], dtype=np.uint64)
        np.add.at(sums, cell, mix(values + _U64(0xE7037ED1A0B428DB)))
        filled = np.zeros(base[-1], dtype=bool)
        filled[cell] = True
        set_of = np.repeat(np.arange(len(chosen)), m)
        position = np.arange(base[-1]) - base[set_of]
        empty = np.bincount(set_of, weights=~filled, minlength=len(chosen))
        keep = filled | (empty > classes.spare[c])[set_of]
        key = mix(sums + mix(position.astype(np.uint64) + (c[set_of].astype(np.uint64) << _U64(40))))
        yield chosen[set_of[keep]], key[keep]


def _entries(size: int, percent: int, common: tuple[np.ndarray, np.ndarray] | None = None):
    """Index entries of each set, once per task: by position, or with ``common`` by its least common n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(percent)
        entered: set[tuple[int, int]] = set()
        for b in batches:
            for lo, hi, data, offsets in texts(b, "text"):
                h, at = shingle_sets(data, offsets, size)
                rows = []
                for i, key in enumerate(zip(*[k.tolist() for k in identities(h, at)], strict=True)):
                    if at[i + 1] > at[i] and key not in entered:
                        if len(entered) > 1 << 18:
                            entered.clear()
                        entered.add(key)
                        rows.append(i)
                rows = np.array(rows, dtype=np.int64)
                found = entries(h, at, rows, classes) if common is None else [first_entries(h, at, rows, percent, common)]
                for row, key in found:
                    ids = b.column("doc_id").take(pa.array(row + lo))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids], ["key", "doc_id"])
    return run


def _grams(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offsets in texts(b, "text"):
                h, _ = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["gram"])
    return run


def common_grams(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that are common among one document in ``COUNTED``, sorted, and
    their levels (1 to 255, by the logarithm of their counts); those of the
    highest levels, as many levels as ``NAMED`` n-grams have room for. They set
    an order alone: which documents link does not depend on them."""
    some = docs.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(COUNTED)) == 0))
    counts = map_arrow(some, _grams(size), "gram long").groupBy("gram").agg(F.count("*").alias("n"))
    level = F.least(F.ceil(8 * F.log2("n")), F.lit(255)).cast("int")
    counts = checkpoint_table(counts.where(F.col("n") >= OFTEN).select("gram", level.alias("level")), "common_grams")
    lowest, room = 256, NAMED
    for r in sorted(counts.groupBy("level").count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        lowest = r["level"]
    top = counts.where(F.col("level") >= lowest).toPandas()
    grams = top["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], top["level"].to_numpy(np.uint64)[order]


def levels(h: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How common each n-gram is: 0 for those that ``common`` (sorted n-grams,
    their levels) does not name."""
    grams, level = common
    if not len(grams):
        return np.zeros(len(h), dtype=np.uint64)
    at = np.searchsorted(grams, h)
    at[at == len(grams)] = 0
    return np.where(grams[at] == h, level[at], 0).astype(np.uint64)


def first_entries(h: np.ndarray, at: np.ndarray, rows: np.ndarray, percent: int,
                  common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, n-gram) of the first n-grams of the sets ``rows``, the least common
    first and equally common ones in an order of their hashes. Linked sets share
    percent/100 of either's n-grams at least, so that one of them is among the
    first n - ceil(percent/100 n) + 1 of both, whatever the order."""
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    keep = np.zeros(len(n), dtype=bool)
    keep[rows] = True
    keep = keep[owner]
    h, owner = h[keep], owner[keep]
    place = (levels(h, common) << _U64(56)) | (mix(h ^ _U64(0x2545F4914F6CDD1D)) >> _U64(8))
    order = np.lexsort((h, place, owner))
    h, owner = h[order], owner[order]
    position = np.arange(len(h)) - np.searchsorted(owner, owner)
    first = position < (n + (-percent * n // 100) + 1)[owner]
    return owner[first], h[first]


def _pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, doc_id) to (pivot, member): the first id of each list with each other one."""
    last_key, last_id = None, None
    for b in batches:
        key, ids = b.column("key").to_numpy(), b.column("doc_id").to_numpy()
        if not len(key):
            continue
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        pivot = ids[start]
        if key[0] == last_key:
            pivot[start == 0] = last_id
        last_key, last_id = key[-1], pivot[-1]
        keep = pivot != ids
        pairs = np.unique(np.stack([pivot[keep], ids[keep]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["p", "x"])


def least_differences(rows: list[bytes], cols: list[bytes]) -> np.ndarray:
    """For all pairs, how many n-grams two sets differ in at least: n-grams that
    both have leave the same parities. Sketches are folded to the shortest."""
    size = min(map(len, rows + cols))
    sides = [np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, size), axis=0) for x in side])
             for side in (rows, cols)]
    out = np.zeros((len(rows), len(cols)), dtype=np.float32)
    for lo in range(0, size, CELLS // 8):
        a, b = (np.unpackbits(x[:, lo:lo + CELLS // 8], axis=1).astype(np.float32) for x in sides)
        out += a.sum(axis=1)[:, None] + b.sum(axis=1)[None, :] - 2 * (a @ b.T)
    return out.astype(np.int64)


def may_link(rows: list[bytes], cols: list[bytes], n_rows: np.ndarray, n_cols: np.ndarray, percent: int) -> np.ndarray:
    both = np.add.outer(n_rows, n_cols)
    most = np.minimum((both - least_differences(rows, cols)) // 2, np.minimum.outer(n_rows, n_cols))
    return 100 * most >= percent * (both - most)


def _hopeful(percent: int):
    """Rows sorted by (p, i, j), each a member's sketch, to the members (p, x)
    that may link with the pivot or with another member."""
    def members(key, rows) -> list[int]:
        p, i, j = key
        main = next(r for r in rows if r[0] == p)
        rest = [r for r in rows if r[0] != p]
        if not rest:
            return []
        n = np.array([r[2] for r in rest])
        marks = [r[3] for r in rest]
        side = np.array([r[1] for r in rest])
        keep = may_link(marks, [main[3]], n, np.array([main[2]]), percent)[:, 0]
        out = np.flatnonzero(~keep)
        for lo in range(0, len(out), BLOCK):
            r = out[lo:lo + BLOCK]
            hit = may_link([marks[k] for k in r], marks, n[r], n, percent)
            hit &= (side[r][:, None] != side[None, :]) if i != j else (r[:, None] != np.arange(len(rest))[None, :])
            keep[r] |= hit.any(axis=1)
            keep |= hit.any(axis=0)
        return [rest[k][0] for k in np.flatnonzero(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def found() -> pa.RecordBatch:
            x = members(key, rows)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(x), pa.int64()), pa.array(x, pa.int64())], ["p", "x"])

        for b in batches:
            for p, i, j, *row in zip(*[b.column(k).to_pylist() for k in ("p", "i", "j", "x", "side", "n", "sketch")], strict=True):
                if (p, i, j) != key:
                    if key is not None:
                        yield found()
                    key, rows = (p, i, j), []
                rows.append(row)
        if key is not None:
            yield found()
    return run


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (a plain sort, which is faster than numpy's hash table)."""
    values = np.sort(values)
    first = np.ones(len(values), dtype=bool)
    first[1:] = values[1:] != values[:-1]
    return values[first]


def overlap_matrix(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (a, b)]
    common, other = (_distinct(values) for values, _ in sides)
    if len(common) and len(other):
        at = np.searchsorted(other, common)
        at[at == len(other)] = 0
        common = common[other[at] == common]
    else:
        common = common[:0]
    places = []
    for values, owner in sides:
        at = np.searchsorted(common, values)
        at[at == len(common)] = 0
        keep = common[at] == values if len(common) else np.zeros(len(values), dtype=bool)
        places.append((owner[keep], at[keep]))
    for lo in range(0, len(common), CELLS):
        width = min(CELLS, len(common) - lo)
        parts = []
        for (owner, at), s in zip(places, (a, b), strict=True):
            here = (at >= lo) & (at < lo + width)
            m = np.zeros((len(s), width), dtype=np.float32)
            m[owner[here], at[here] - lo] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def group_links(ids: list[int], sides: list[int], sets: list[np.ndarray], pivot: int, cross: bool,
                percent: int) -> list[tuple[int, int]]:
    """Links among a pivot's members, enough of them to join all that are
    connected; with ``cross`` only between sides 0 and 1 (each side's own pairs
    and its links with the pivot are another task's)."""
    at = ids.index(pivot)
    main = sets[at]
    members = [k for k in range(len(ids)) if k != at]
    ids, sides, sets = ([x[k] for k in members] for x in (ids, sides, sets))
    n = np.array([len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    found = np.searchsorted(main, values)
    found[found == len(main)] = 0
    o = np.bincount(np.repeat(np.arange(len(sets)), n), weights=main[found] == values, minlength=len(sets)).astype(np.int64)
    linked = 100 * o >= percent * (len(main) + n - o)
    edges = [] if cross else [(pivot, ids[k]) for k in np.flatnonzero(linked)]
    root = list(range(len(ids)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    together = np.flatnonzero(linked)
    for k in together[1:].tolist():
        root[k] = int(together[0])
    side = np.array(sides)
    rounds = [(~linked & (side == 0), side == 1), (~linked & (side == 1), side == 0)] if cross else \
        [(~linked, np.ones(len(ids), dtype=bool))]
    for rows, cols in rounds:
        rows, cols = np.flatnonzero(rows), np.flatnonzero(cols)
        for lo in range(0, len(rows), BLOCK):
            r = rows[lo:lo + BLOCK]
            # the pivot's answers bound the overlap of every pair
            most = np.minimum.outer(o[r], o[cols]) + np.minimum.outer(n[r] - o[r], n[cols] - o[cols])
            both = np.add.outer(n[r], n[cols])
            open_ = (100 * most >= percent * (both - most)) & (r[:, None] != cols[None, :])
            use_r, use_c = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if not len(use_r):
                continue
            exact = overlap_matrix([sets[k] for k in r[use_r]], [sets[k] for k in cols[use_c]])
            hit = 100 * exact >= percent * (both[np.ix_(use_r, use_c)] - exact)
            for i, j in np.argwhere(hit & open_[np.ix_(use_r, use_c)]).tolist():
                x, y = int(r[use_r[i]]), int(cols[use_c[j]])
                fx, fy = find(x), find(y)
                if fx != fy:
                    root[fx] = fy
                    edges.append((ids[x], ids[y]))
    return edges


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text on its own as zstd makes it, and its bytes before: it is shuffled
    twice, and Spark's own packing leaves half as much again."""
    zstd = pa.Codec("zstd")
    for b in batches:
        raw = b.column("text").cast(pa.large_binary())
        small = [zstd.compress(x.as_buffer(), asbytes=True) for x in raw]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.as_buffer().size for x in raw], pa.int32()),
                                          pa.array(small, pa.binary())], ["doc_id", "size", "packed"])


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``texts`` of packed ones, as many at once as ``PIECE`` bytes hold."""
    zstd, packed = pa.Codec("zstd"), batch.column("packed")
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(batch.column("size").to_numpy(), dtype=np.int64)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PIECE, side="right")) - 1)
        raw = [zstd.decompress(packed[k].as_buffer(), int(ends[k + 1] - ends[k]), asbytes=True) for k in range(lo, hi)]
        yield lo, hi, np.frombuffer(b"".join(raw), np.uint8), ends[lo:hi + 1] - ends[lo]
        lo = hi


def _compare(size: int, percent: int):
    """Rows sorted by (p, i, j), each a member's packed text, to links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sides, sets = None, [], [], []

        def links() -> pa.RecordBatch:
            e = group_links(ids, sides, sets, key[0], key[1] != key[2], percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in e], pa.int64()),
                                               pa.array([x[1] for x in e], pa.int64())], ["a", "b"])

        for b in batches:
            rows = list(zip(*[b.column(k).to_pylist() for k in ("p", "i", "j", "x", "side")], strict=True))
            for lo, hi, data, offsets in unpacked(b):
                h, at = shingle_sets(data, offsets, size)
                for r in range(lo, hi):
                    p, i, j, x, side = rows[r]
                    if (p, i, j) != key:
                        if key is not None:
                            yield links()
                        key, ids, sides, sets = (p, i, j), [], [], []
                    ids.append(x)
                    sides.append(side)
                    sets.append(h[at[r - lo]:at[r - lo + 1]].copy())
        if key is not None:
            yield links()
    return run


def dealt(stars: DataFrame, held: DataFrame) -> DataFrame:
    """The members of each pivot with what ``held`` (doc_id, ...) has of them,
    in tasks (p, i, j).

    A pivot's members are dealt by hash into blocks of about ``BLOCK``; a task
    compares two blocks (or one with itself), and has the pivot in both cases.
    Members travel once per task, not once per pair."""
    counts = stars.groupBy("p").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = stars.join(counts, "p").select(
        "p", "x", "blocks", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int").alias("block"))
    pivots = counts.select("p", F.col("p").alias("x"), "blocks", F.lit(-1).alias("block"))
    rows = members.union(pivots).join(held.withColumnRenamed("doc_id", "x"), "x")
    c = F.col
    all_ = F.sequence(F.lit(0), c("blocks") - 1)
    own = F.transform(all_, lambda k: F.struct(
        F.least(k, c("block")).alias("i"), F.greatest(k, c("block")).alias("j"),
        F.when(k < c("block"), 1).otherwise(0).alias("side")))
    every = F.flatten(F.transform(all_, lambda i: F.transform(F.sequence(i, c("blocks") - 1), lambda j: F.struct(
        i.alias("i"), j.alias("j"), F.lit(0).alias("side")))))
    more = [k for k in held.columns if k != "doc_id"]
    out = rows.select("p", "x", *more, F.explode(F.when(c("block") < 0, every).otherwise(own)).alias("t")) \
        .select("p", "t.i", "t.j", "t.side", "x", *more)
    return out.repartition(shuffle_width(stars.sparkSession), "p", "i", "j").sortWithinPartitions("p", "i", "j")


def star_pairs(lists: DataFrame, rep_of: DataFrame) -> DataFrame:
    """(p, x): the first set of each index list with every other member, both by
    their class. Joining on the ids drops null ones; that condition is set on the
    entries themselves, or Spark would add it to one of the three readers of the
    sorted ranges alone, whose entries would then be computed and shuffled again."""
    ranged = ranges(lists.where("doc_id is not null"), ["key"], "doc_id")
    cut = split_keys(ranged, ["key"], "doc_id").select(F.col("owner").alias("p"), F.col("doc_id").alias("x"))
    stars = map_arrow(ranged, _pivots, "p long, x long").union(cut)
    return (stars.distinct()
            .join(rep_of.select(F.col("doc_id").alias("p"), F.col("rep").alias("rp")), "p")
            .join(rep_of.select(F.col("doc_id").alias("x"), F.col("rep").alias("rx")), "x")
            .select(F.col("rp").alias("p"), F.col("rx").alias("x")).where("p <> x").distinct())


def link_components(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                    id_col: str = "doc_id", text: str = "text", sketch: bool = False, rare: bool = False) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``df``. ``sketch`` drops
    members by their sketches first, ``rare`` indexes sets by their least common
    n-grams instead of by position; both pay at low thresholds."""
    docs = ids_and_texts(df, id_col, text)
    nodes = checkpoint_table(map_arrow(docs, _nodes(size, sketch), "doc_id long, n long, k1 long, k2 long, sketch binary"),
                             "shingle_sets")
    firsts = nodes.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"))
    reps = checkpoint_table(nodes.join(firsts, ["k1", "k2", "n"], "left").select("doc_id", "n", "rep"), "set_classes")

    known = docs.where(F.col("doc_id").isNotNull())
    common = common_grams(known, size) if rare else None
    lists = map_arrow(known, _entries(size, percent, common), "key long, doc_id long")
    rep_of = reps.where("rep is not null").select("doc_id", "rep").distinct()
    stars = star_pairs(lists, rep_of)
    stars = checkpoint_table(stars, "stars")
    marks = nodes.where("n > 0 and doc_id is not null").select("doc_id", "n", "sketch")
    hopeful = checkpoint_table(map_arrow(dealt(stars, marks), _hopeful(percent), "p long, x long").distinct(),
                               "hopeful") if sketch else stars
    packed = map_arrow(known, _packed, "doc_id long, size int, packed binary")
    # written, as the rounds that follow read the links from both sides
    links = checkpoint_table(map_arrow(dealt(hopeful, packed), _compare(size, percent), "a long, b long"), "found_links")
    comp = components(links)
    return (reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
            .select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id")))
