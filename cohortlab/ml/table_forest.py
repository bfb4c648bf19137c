"""Random forests whose nodes stay a distributed table.

A forest of unlimited trees has nodes in proportion to rows times trees, which
Spark's own forest keeps on the driver. Here the driver holds only the top of
each tree, down to nodes of at most ``PART_ROWS`` drawn rows: their splits are
chosen from counts that Spark sums by (node, feature, bin), a level a pass. The
rows of each node below, a part, are then dealt to one task, which grows the
part's subtree; a part's nodes are one row of a table. To score, rows are dealt
to the parts they reach, meet the nodes there and are summed up again; rows of a
stream stay where they are and the nodes come to them.

As in Spark's forest: rows drawn with replacement (a Poisson count of mean 1 for
each row and tree), ceil(sqrt(features)) random features at every node, Gini
gain over at most ``BINS`` quantile bins, and two leaves of one label are put
together from the bottom up (within a part). Values are added as whole numbers
of 2^-40, so that a score does not depend on the order of rows or trees.
"""

from __future__ import annotations

import glob
import json
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path, ship_package
from ..sources.tables import checkpoint_table, shuffles_dropped, written_table
from .boosting import fit_cuts
from .forest import Forest, Setting, cut_back, leaves_of

BINS = 64
PART_ROWS = 100_000  # drawn rows of a node that one task grows a subtree from
CELLS = 1 << 21      # counts that a task holds at once for (node, feature, bin)
FEW = 64             # rows of a node up to which its splits are found by sorting them
ONE = 1 << 40
DEALT = 50_000_000   # rows times trees that are shuffled at once
READ_FOR = 50_000    # rows of a stream that a task reads the nodes for
KNOWN = 8            # features whose sets are all gone through for contributions
TABLE = 1 << 23      # values of a table over some features' bins that a task holds at once
WALKED = 1 << 14     # rows that walk down a tree together
HELD = 2_000_000     # nodes of the trees that a task takes contributions from
BLOCK_ROWS = 250_000
NODE = np.dtype([("feature", "<i2"), ("cut", "<i2"), ("left", "<i4"), ("rows", "<i4"), ("value", "<i8")])  # the right child follows the left one
DRAWS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def _packed(rows: np.ndarray) -> pa.Array:
    """A matrix of bytes as a column of binaries."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    if not len(column):
        return np.empty((0, width), np.uint8)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)
    return np.frombuffer(data, np.uint8)[ends[column.offset]:ends[column.offset + len(column)]].reshape(len(column), width)


def drawn(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    x = ids.astype(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.searchsorted(DRAWS, (x >> np.uint64(11)) / (1 << 53), side="right")


@dataclass
class Top:
    """The upper nodes of all trees, roots first; leaves (feature -1) are parts."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    depth: list[int]
    tree: list[int]
    up: list[int]
    value: list[int]
    share: list[float] = field(default_factory=list)  # of the drawn rows of the node above

    def reached(self) -> "Walk":
        return Walk(np.array(self.feature), np.array(self.cut), np.array(self.left))

    def split(self, node: int, feature: int, cut: int, values: list[float], shares: list[float]) -> int:
        """Two children of these values and shares of rows below a part; the first one's place."""
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, at
        for v, share in zip(values, shares, strict=True):
            for column, x in ((self.feature, -1), (self.cut, -1), (self.left, -1), (self.depth, self.depth[node] + 1),
                              (self.tree, self.tree[node]), (self.up, node), (self.value, round(v * ONE)), (self.share, share)):
                column.append(x)
        return at

    def value_at(self, part: int, depth: int) -> int | None:
        """The value of the node above a part at a depth, none from the part itself on."""
        if depth >= self.depth[part]:
            return None
        while self.depth[part] > depth:
            part = self.up[part]
        return self.value[part]


@dataclass
class Walk:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray

    def __call__(self, bins: np.ndarray, root: int = 0) -> np.ndarray:
        """The leaf that each row reaches."""
        at, rows = np.full(len(bins), root), np.arange(len(bins))
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            here = at[rows]
            at[rows] = self.left[here] + (bins[rows, self.feature[here]] > self.cut[here])
        return at


def best_splits(w: np.ndarray, p: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature place, bin) of the best split of each node from drawn rows
    and positives by (node, feature place, bin); no split has a gain of 0."""
    all_w, all_p = (x.sum(axis=2)[:, :1, None] for x in (w, p))
    lw, lp = (np.cumsum(x, axis=2)[:, :, :-1] for x in (w, p))
    rw, rp = all_w - lw, all_p - lp
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((lp ** 2 + (lw - lp) ** 2) / lw + (rp ** 2 + (rw - rp) ** 2) / rw
                - (all_p ** 2 + (all_w - all_p) ** 2) / all_w)
    gain = np.where((lw >= leaf) & (rw >= leaf), gain, 0).reshape(len(w), -1)
    best = gain.argmax(axis=1)
    return gain[np.arange(len(w)), best], best // (BINS - 1), best % (BINS - 1)


def some_features(rng: np.random.Generator, nodes: int, width: int, of: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The random features of the nodes ``of``; the others' chances are drawn all the same."""
    return np.argsort(rng.random((nodes, width))[of], axis=1)[:, :max(1, math.ceil(math.sqrt(width)))]


def _by_counts(bins: np.ndarray, w: np.ndarray, p: np.ndarray, at: np.ndarray, features: np.ndarray,
               leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_splits`` of nodes from their rows (in node ``at``), by counts in all bins."""
    nodes, k = features.shape
    cell = (at[:, None] * k + np.arange(k)) * BINS + np.take_along_axis(bins, features[at], axis=1)
    counts = [np.bincount(cell.ravel(), np.repeat(v, k), nodes * k * BINS).reshape(-1, k, BINS) for v in (w, p)]
    return best_splits(*counts, leaf)


def _by_order(bins: np.ndarray, w: np.ndarray, p: np.ndarray, at: np.ndarray, features: np.ndarray,
              leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_by_counts``, the same splits bit for bit, but from the rows sorted by
    (node, feature place, bin): nodes of a few rows fill few of their bins. Draws
    are below 32, labels 0 and 1; both travel in the key."""
    nodes, k = features.shape
    cell = (at[:, None] * k + np.arange(k)) * BINS + np.take_along_axis(bins, features[at], axis=1)
    key = np.sort(((cell << 6) | (w.astype(np.int64) * 2 + (p > 0))[:, None]).ravel())
    w = key >> 1 & 31
    cells, lw, lp = key >> 6, np.cumsum(w), np.cumsum(w * (key & 1))
    end = np.flatnonzero(np.append(cells[1:] != cells[:-1], True))
    cells, lw, lp = cells[end], lw[end], lp[end]
    place = cells // BINS
    last = np.flatnonzero(np.append(place[1:] != place[:-1], True))  # every place has a row
    before = [np.concatenate([[0], v[last[:-1]]]) for v in (lw, lp)]
    all_w, all_p = ((v[last] - b)[place].astype(float) for v, b in zip((lw, lp), before, strict=True))
    lw, lp = ((v - b[place]).astype(float) for v, b in zip((lw, lp), before, strict=True))
    rw, rp = all_w - lw, all_p - lp
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((lp ** 2 + (lw - lp) ** 2) / lw + (rp ** 2 + (rw - rp) ** 2) / rw
                - (all_p ** 2 + (all_w - all_p) ** 2) / all_w)
    gain = np.where((lw >= leaf) & (rw >= leaf), gain, 0)
    node = place // k
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    best = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero(gain == best[node])[::-1]
    found = np.empty(nodes, np.int64)
    found[node[hit]] = hit  # the first one stays
    return best, place[found] % k, cells[found] % BINS


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, leaf: int, rng: np.random.Generator) -> np.ndarray:
    """The nodes of the subtree over the rows, level by level from its root."""
    levels, begin, nodes = [], 0, 1
    rows, slot, p = np.arange(len(y)), np.zeros(len(y), dtype=np.int64), w * y
    few = FEW if (w < 32).all() and (w == np.floor(w)).all() else 0
    while nodes:
        all_w, all_p = np.bincount(slot, w[rows], nodes), np.bincount(slot, p[rows], nodes)
        level = np.zeros(nodes, NODE)
        level["feature"] = -1
        level["rows"], level["value"] = all_w, np.round(all_p / all_w * ONE)
        open_ = np.flatnonzero((all_p > 0) & (all_p < all_w) & (len(levels) < depth))
        features = some_features(rng, nodes, bins.shape[1], open_)
        k = features.shape[1]
        keep = np.zeros(nodes, bool)
        keep[open_] = True
        keep = keep[slot]
        # sorted by (node, row): what is left of a closed node is done with
        order = np.sort(slot[keep] << 32 | rows[keep])
        rows, slot = order & 0xFFFFFFFF, order >> 32
        starts = np.searchsorted(slot, open_)
        sizes = np.diff(np.append(starts, len(slot)))
        place = np.empty(nodes, np.int64)
        for of, split, step in ((sizes <= few, _by_order, CELLS // 8 // k), (sizes > few, _by_counts, 0)):
            of = np.flatnonzero(of)
            if not len(of):
                continue
            pieces = np.array_split(of, -(-len(of) * k * BINS // CELLS)) if not step else \
                np.split(of, np.flatnonzero(np.diff(np.cumsum(sizes[of]) // step)) + 1)
            for part in pieces:
                place[open_[part]] = np.arange(len(part))
                n = sizes[part]
                at = np.repeat(starts[part] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                here = rows[at]
                gain, which, cut = split(bins[here], w[here], p[here], place[slot[at]], features[part], leaf)
                good = np.flatnonzero(gain > 1e-9)
                level["feature"][open_[part[good]]] = features[part[good], which[good]]
                level["cut"][open_[part[good]]] = cut[good]
        split = np.flatnonzero(level["feature"] >= 0)
        child = np.full(nodes, -1)
        child[split] = 2 * np.arange(len(split))
        level["left"] = np.where(child >= 0, begin + nodes + child, -1)
        keep = np.flatnonzero(child[slot] >= 0)
        rows, here = rows[keep], slot[keep]
        slot = child[here] + (bins[rows, level["feature"][here]] > level["cut"][here])
        levels.append(level)
        begin, nodes = begin + nodes, 2 * len(split)
    out = np.concatenate(levels)
    ends = np.cumsum([len(x) for x in levels])
    for lo, hi in reversed(list(zip(ends - [len(x) for x in levels], ends, strict=True))):
        inner = lo + np.flatnonzero(out["feature"][lo:hi] >= 0)
        left = out["left"][inner]
        same = (out["feature"][left] < 0) & (out["feature"][left + 1] < 0) & \
            ((out["value"][left] > ONE // 2) == (out["value"][left + 1] > ONE // 2))
        out["feature"][inner[same]] = -1
    return out


def _binned(cuts: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(cuts))
            bins = np.empty(x.shape, np.uint8)
            for k, c in enumerate(cuts):  # a NaN is above all cuts
                bins[:, k] = np.where(np.isnan(x[:, k]), BINS - 1, np.searchsorted(np.array(c), x[:, k], side="left"))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), _packed(bins)], ["id", "y", "bins"])
    return run


def _counts(walk: Walk, trees: int, open_: list[int], width: int, seed: int):
    """Drawn rows and positives by (node, feature, bin) of the open nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(len(walk.feature), -1)
        place[open_] = np.arange(len(open_))
        sums = np.zeros((2, len(open_) * width * BINS))
        for b in batches:
            bins, ids, y = _unpacked(b.column("bins"), width), b.column("id").to_numpy(), b.column("y").to_numpy()
            for tree in range(trees):
                at = place[walk(bins, tree)]
                rows = np.flatnonzero(at >= 0)
                w = drawn(ids[rows], tree, seed)
                cell = ((at[rows][:, None] * width + np.arange(width)) * BINS + bins[rows]).ravel()
                for k, v in enumerate((w, w * y[rows])):
                    np.add.at(sums[k], cell, np.repeat(v, width).astype(float))
        cell = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(open_)[cell // (width * BINS)]), pa.array(cell % (width * BINS)), pa.array(sums[0][cell]), pa.array(sums[1][cell])],
            ["node", "cell", "w", "p"])
    return run


def _best(width: int, leaf: int, seed: int):
    def run(pdf):
        node = int(pdf["node"].iloc[0])
        features = some_features(np.random.default_rng([seed, node]), 1, width)[0]
        w, p = np.zeros(width * BINS), np.zeros(width * BINS)
        w[pdf["cell"]], p[pdf["cell"]] = pdf["w"], pdf["p"]
        w, p = w.reshape(width, BINS), p.reshape(width, BINS)
        gain, which, cut = best_splits(w[features][None], p[features][None], leaf)
        f, c = int(features[which[0]]), int(cut[0])
        (lw, lp), (rw, rp) = ([x[f, side].sum() for x in (w, p)] for side in (slice(c + 1), slice(c + 1, None)))
        return pdf.iloc[:1][["node"]].assign(feature=f if gain[0] > 1e-9 else -1, cut=c, left=lw, right=rw, left_p=lp, right_p=rp)
    return run


def _dealt(walk: Walk, trees: Iterable[int], width: int, seed: int):
    """The drawn rows of each part, those of a batch as one matrix of bytes: a row's bins, then twice its draws plus its label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, ids, y = _unpacked(b.column("bins"), width), b.column("id").to_numpy(), b.column("y").to_numpy()
            for tree in trees:
                w = drawn(ids, tree, seed)
                rows = np.flatnonzero(w)
                if not len(rows):
                    continue
                part = walk(bins[rows], tree)
                order = np.argsort(part, kind="stable")
                rows, part = rows[order], part[order]
                data = np.column_stack([bins[rows], (2 * w[rows] + y[rows]).astype(np.uint8)])
                starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[starts].astype(np.int32)), pa.array([data[lo:hi].tobytes() for lo, hi in zip(starts, [*starts[1:], len(part)], strict=True)],
                                                                       pa.binary())], ["part", "data"])
    return run


def _grown(depths: list[int], width: int, depth: int, leaf: int, seed: int):
    """Matrices sorted by part to one row of nodes a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def nodes() -> pa.RecordBatch:
            rows = np.frombuffer(b"".join(held), np.uint8).reshape(-1, width + 1)
            y, w = (rows[:, -1] & 1).astype(np.int64), (rows[:, -1] >> 1).astype(float)
            out = grow(rows[:, :-1], y, w, depth - depths[part], leaf, np.random.default_rng([seed, part, 1]))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["part", "nodes"])

        for b in batches:
            for p, data in zip(b.column("part").to_pylist(), b.column("data"), strict=True):
                if p != part:
                    if held:
                        yield nodes()
                    part, held = p, []
                held.append(data.as_py())
        if held:
            yield nodes()
    return run


def _sent(walk: Walk, trees: Iterable[int], cuts: list[list[float]]):
    """Each row once for the part it reaches in each of ``trees``, those of a
    batch and part together: their ids, then their bins."""
    binned = _binned(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in binned(batches):
            bins, ids = _unpacked(b.column("bins"), len(cuts)), b.column("id").to_numpy()
            if not len(ids):
                continue
            for tree in trees:
                part = walk(bins, tree)
                order = np.argsort(part, kind="stable")
                sorted_ids, sorted_bins, part = ids[order], bins[order], part[order]
                starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                data = [sorted_ids[lo:hi].tobytes() + sorted_bins[lo:hi].tobytes() for lo, hi in zip(starts, [*starts[1:], len(part)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), pa.array([True] * len(starts)), pa.array(data, pa.binary())],
                                                 ["part", "rows", "data"])
    return run


def _met(width: int, value_of, outputs: list[str]):
    """Each part's nodes and then its rows (sorted by part and ``rows``) to the ids
    and the values that ``value_of(part, nodes)`` gives to rows of bins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = None
        for b in batches:
            for part, rows, data in zip(b.column("part").to_pylist(), b.column("rows").to_pylist(), b.column("data"), strict=True):
                data = np.frombuffer(data.as_buffer(), np.uint8)
                if not rows:
                    values = value_of(part, data.copy().view(NODE))
                    continue
                n = len(data) // (8 + width)
                found = values(data[8 * n:].reshape(n, width))
                yield pa.RecordBatch.from_arrays([pa.array(data[:8 * n].copy().view(np.int64)), *map(pa.array, found)], ["id", *outputs])
    return run


def _full(part: int, nodes: np.ndarray):
    walk = Walk(*(nodes[k].astype(np.int64) for k in ("feature", "cut", "left")))
    return lambda bins: [nodes["value"][walk(bins)]]


def _read_nodes(folder: str, copied: bool, top: Top, cuts: list[list[float]], kept: list[str]):
    """Rows with ``__sum``, the sum of their values: nodes are read once for about
    ``READ_FOR`` rows, some parts at a time."""
    binned = _binned(cuts)

    def values(bins: np.ndarray) -> np.ndarray:
        files = sorted(glob.glob(f"{SparkFiles.get(folder) if copied else folder}/*.parquet"))
        if not files:
            raise FileNotFoundError(f"no nodes in {folder}")
        walk, sums, reached = top.reached(), np.zeros(len(bins), np.int64), {}
        for file in files:
            for b in pq.ParquetFile(file).iter_batches(8, columns=["part", "nodes"]):
                for part, nodes in zip(b.column("part").to_pylist(), b.column("nodes"), strict=True):
                    tree = top.tree[part]
                    if tree not in reached:
                        reached[tree] = walk(bins, tree).astype(np.int32)
                    rows = np.flatnonzero(reached[tree] == part)
                    if len(rows):
                        sums[rows] += _full(part, np.frombuffer(nodes.as_buffer(), NODE))(bins[rows])[0]
        return sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def scored() -> Iterator[pa.RecordBatch]:
            rows = [pa.RecordBatch.from_arrays([pa.nulls(b.num_rows), pa.nulls(b.num_rows), b.column("__x")], ["id", "y", "x"]) for b in held]
            sums = values(np.concatenate([_unpacked(b.column("bins"), len(cuts)) for b in binned(iter(rows))]))
            lo = 0
            for b in held:
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(sums[lo:lo + b.num_rows])], [*kept, "__sum"])
                lo += b.num_rows

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= READ_FOR:
                yield from scored()
                held = []
        if sum(x.num_rows for x in held):
            yield from scored()
    return run


def _cut_back(top: Top, settings: list[Setting]):
    """The values of a part's rows in the tree cut back to each setting, 0 in those of fewer trees."""
    def value_of(part: int, nodes: np.ndarray):
        depth = np.full(len(nodes), -1)  # nodes that were put together stay at -1
        level, here = np.zeros(1, np.int64), top.depth[part]
        while len(level):
            depth[level], here = here, here + 1
            level = nodes["left"][level[nodes["feature"][level] >= 0]].astype(np.int64)
            level = np.concatenate([level, level + 1])
        left = np.where(nodes["feature"] >= 0, nodes["left"], -1).astype(np.int64)
        tree = Forest(nodes["feature"].astype(np.int64), nodes["cut"].astype(float), left, np.where(left >= 0, left + 1, -1), depth,
                      nodes["rows"], nodes["rows"], nodes["value"] / ONE, np.zeros(1, np.int64))
        sizes = sorted({(s.depth, s.split) for s in settings})
        stops = {k: leaves_of(tree, *k) for k in sizes}

        def values(bins: np.ndarray) -> list[np.ndarray]:
            found = np.round(cut_back(tree, bins, [Setting(1, *k) for k in sizes], stops) * ONE).astype(np.int64)
            out = []
            for s in settings:
                above = top.value_at(part, s.depth)
                v = found[:, sizes.index((s.depth, s.split))] if above is None else np.full(len(bins), above)
                out.append(v if top.tree[part] < s.trees else np.zeros(len(bins), np.int64))
            return out
        return values
    return value_of


# ------------------------------------------------------------------ contributions

@dataclass
class Nodes:
    """Whole trees: the upper nodes (of all trees) and below them the nodes of
    the parts at hand; ``share`` is the left child's of a node's drawn rows."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    share: np.ndarray
    value: np.ndarray


def joined(top: Top, parts: list[tuple[int, np.ndarray]]) -> Nodes:
    """A part's root takes its place among the upper nodes, its other nodes follow."""
    upper = len(top.feature)
    out = [np.array(top.feature), np.array(top.cut), np.array(top.left), np.zeros(upper), np.array(top.value) / ONE]
    inner = np.flatnonzero(out[0] >= 0)
    out[3][inner] = np.array(top.share)[out[2][inner]]
    columns, base = [[c] for c in out], upper
    for part, nodes in parts:
        left = nodes["left"].astype(np.int64)
        split = np.flatnonzero(nodes["feature"] >= 0)
        share = np.zeros(len(nodes))
        share[split] = nodes["rows"][left[split]] / nodes["rows"][split]
        for column, v in zip(columns, (nodes["feature"], nodes["cut"], base + left - 1, share, nodes["value"] / ONE), strict=True):
            column[0][part] = v[0]
            column.append(v[1:])
        base += len(nodes) - 1
    return Nodes(*(np.concatenate(c) for c in columns))


def boxes(nodes: Nodes, roots: list[int], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every leaf its least and greatest bins and its share of rows by
    feature, and its value."""
    found, at = [], np.array(roots, dtype=np.int64)
    low, high, share = np.zeros((len(at), width), np.uint8), np.full((len(at), width), BINS - 1, np.uint8), np.ones((len(at), width))
    while len(at):
        leaf = nodes.feature[at] < 0
        found.append((low[leaf], high[leaf], share[leaf], nodes.value[at[leaf]]))
        at, low, high, share = at[~leaf], low[~leaf], high[~leaf], share[~leaf]
        row, f, cut, left = np.arange(len(at)), nodes.feature[at], nodes.cut[at], nodes.share[at]
        sides = [[nodes.left[at] + k, low.copy(), high.copy(), share.copy()] for k in (0, 1)]
        sides[0][2][row, f] = np.minimum(high[row, f], cut)
        sides[1][1][row, f] = np.maximum(low[row, f], cut + 1)
        for side, part in zip(sides, (left, 1 - left), strict=True):
            side[3][row, f] *= part
        at, low, high, share = (np.concatenate(x) for x in zip(*sides, strict=True))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def known_by_tables(low: np.ndarray, high: np.ndarray, weight: np.ndarray, sizes: list[int], bins: np.ndarray) -> np.ndarray:
    """For each row of bins, the sum of the weights of the boxes that hold it. The
    first feature is swept bin by bin; what begins and ends there changes the
    differences over the other features, whose running sums are the answers."""
    shape = tuple(n + 1 for n in sizes[1:])
    steps = np.cumprod([1, *shape[::-1]])[::-1][1:].astype(np.int64)
    ends = [low.astype(np.int64), np.minimum(high.astype(np.int64) + 1, sizes)]
    events = []
    for corner in range(1 << len(sizes)):
        side = [corner >> k & 1 for k in range(len(sizes))]
        cell = sum((ends[side[k]][:, k] * steps[k - 1] for k in range(1, len(sizes))), np.zeros(len(low), np.int64))
        events.append((ends[side[0]][:, 0].astype(np.uint8), cell, weight if sum(side) % 2 == 0 else -weight))
    first, cell, change = (np.concatenate(x) for x in zip(*events, strict=True))
    order = np.argsort(first, kind="stable")
    first, cell, change = first[order], cell[order], change[order]
    at = np.searchsorted(first, np.arange(sizes[0] + 1))
    rows = np.argsort(bins[:, 0], kind="stable")
    row_at = np.searchsorted(bins[rows, 0], np.arange(sizes[0] + 1))
    places = bins[:, 1:].astype(np.int64) @ steps if len(sizes) > 1 else np.zeros(len(bins), np.int64)
    out, running = np.zeros(len(bins)), np.zeros(math.prod(shape))
    for b in range(sizes[0]):
        np.add.at(running, cell[at[b]:at[b + 1]], change[at[b]:at[b + 1]])
        here = rows[row_at[b]:row_at[b + 1]]
        if len(here):
            sums = running.reshape(shape)
            for axis in range(len(shape)):
                sums = np.cumsum(sums, axis=axis)
            out[here] = sums.ravel()[places[here]]
    return out


def known_by_walks(nodes: Nodes, roots: list[int], unknown: list[int], bins: np.ndarray) -> np.ndarray:
    """For each row of bins, the sum of the trees' values where rows go down both
    sides of the splits on ``unknown`` features."""
    width = bins.shape[1]
    open_, out = np.zeros(width + 1, bool), np.zeros(len(bins))
    open_[unknown] = True
    flat = bins.ravel()
    for root in roots:
        for lo in range(0, len(bins), WALKED):
            row = np.arange(lo, min(lo + WALKED, len(bins)))
            at, weight = np.full(len(row), root, np.int64), np.ones(len(row))
            while len(row):
                f = nodes.feature[at]
                leaf = f < 0
                if leaf.any():
                    part = out[lo:lo + WALKED]
                    part += np.bincount(row[leaf] - lo, weight[leaf] * nodes.value[at[leaf]], len(part))
                    keep = ~leaf
                    row, at, weight, f = row[keep], at[keep], weight[keep], f[keep]
                both = np.flatnonzero(open_[f])
                left = nodes.left[at]
                more = (row[both], left[both] + 1, weight[both] * (1 - nodes.share[at[both]]))
                right = flat[row * width + f] > nodes.cut[at]
                if len(both):
                    right[both] = False
                    weight[both] *= nodes.share[at[both]]
                    row, at, weight = (np.concatenate(x) for x in zip((row, left + right, weight), more, strict=True))
                else:
                    at = left + right
    return out


def shapley(nodes: Nodes, roots: list[int], sizes: list[int], bins: np.ndarray) -> np.ndarray:
    """(rows, features) contributions to the sum of the trees' values: the mean
    gains over all orders, from the values with each set of features known. A
    set's values come from tables over its features' bins, whose work does not
    grow with rows, or from walks, whichever takes less."""
    width, out = len(sizes), np.zeros(bins.shape)
    bins = np.minimum(bins, np.array(sizes, np.uint8) - 1)  # a missing value is above all cuts, as the last bin is
    low, high, share, value = boxes(nodes, roots, width)
    for n in range(width + 1):
        for known in combinations(range(width), n):
            known = sorted(known, key=lambda k: -sizes[k])
            unknown = [k for k in range(width) if k not in known]
            cells = math.prod(sizes[k] + 1 for k in known)
            visits = 16 * len(roots) * (len(value) / len(roots)) ** (len(unknown) / width)
            if n and (cells // (sizes[known[0]] + 1) > TABLE or (cells + len(value) * 2 ** (n + 1)) > 12 * visits * len(bins)):
                v = known_by_walks(nodes, roots, unknown, bins)
            elif n:
                weight = value * share[:, unknown].prod(axis=1)
                v = known_by_tables(low[:, known], high[:, known], weight, [sizes[k] for k in known], bins[:, known])
            else:
                v = np.full(len(bins), (value * share.prod(axis=1)).sum())
            for k in range(width):
                m = n - (k in known)  # features known before k
                w = math.factorial(m) * math.factorial(width - m - 1) / math.factorial(width)
                out[:, k] += v * w if k in known else -v * w
    return out


def _contributed(top: Top, trees: int, sizes: list[int], outputs: list[str]):
    """Rows sorted by (key, id), each key's nodes (null id) first, to the ids and
    their contributions to these trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, ids, rows = None, [], [], []

        def found() -> pa.RecordBatch:
            roots = sorted({top.tree[p] for p, _ in parts})
            values = shapley(joined(top, parts), roots, sizes, np.concatenate(rows))
            whole = np.round(values / trees * ONE).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), *(pa.array(whole[:, k].copy()) for k in range(len(sizes)))],
                                              ["id", *outputs])

        for b in batches:
            keys, nodes = b.column("key").to_numpy(), b.column("id").is_null().to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])]))
            for lo, hi in zip(starts, [*starts[1:], len(keys)], strict=True):
                if keys[lo] != key:
                    if ids:
                        yield found()
                    key, parts, ids, rows = keys[lo], [], [], []
                piece = b.slice(lo, hi - lo)
                if nodes[lo]:
                    parts += [(p, np.frombuffer(x, NODE)) for p, x in zip(piece.column("part").to_pylist(), piece.column("data").to_pylist(), strict=True)]
                else:
                    ids.append(piece.column("id").to_numpy().copy())
                    rows.append(_unpacked(piece.column("data"), len(sizes)).copy())
        if ids:
            yield found()
    return run


def _spread_keys(spark: SparkSession, n: int) -> list[int]:
    """A number for each of ``n`` partitions that hashing deals there."""
    found: dict[int, int] = {}
    step = 20 * n
    while len(found) < n:
        lo = step
        step *= 2
        for r in spark.range(lo, step).selectExpr("cast(id as int) as k", f"pmod(hash(cast(id as int)), {n}) as at").collect():
            found.setdefault(r["at"], r["k"])
    return [found[k] for k in range(n)]


def tree_groups(trees: int, rows: int) -> list[range]:
    """The trees in groups of at most ``DEALT`` rows times trees (or one tree), whose
    rows are shuffled together: what lies on disk at once does not grow with the trees."""
    step = max(1, DEALT // max(rows, 1))
    return [range(lo, min(lo + step, trees)) for lo in range(0, trees, step)]


@dataclass
class TableForest:
    """A fitted forest: the folder of its parts' nodes, the trees' upper nodes
    and the cuts of the features' bins."""

    spark: SparkSession
    path: str
    top: Top
    cuts: list[list[float]]
    trees: int

    def _sums(self, rows: DataFrame, x: Column, value_of, outputs: list[str]) -> DataFrame:
        """``rows`` (with ``__row``) with the sums of the values over all trees;
        the trees are gone through in groups, each written before the next one's
        rows are shuffled."""
        ship_package(self.spark)
        inputs = rows.select(F.col("__row").alias("id"), F.lit(0).alias("y"), x.alias("x"))
        width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        sums, found = [F.sum(c).alias(c) for c in outputs], []
        for trees in tree_groups(self.trees, rows.count()):
            sent = inputs.mapInArrow(_sent(self.top.reached(), trees, self.cuts), "part int, rows boolean, data binary")
            nodes = self.spark.read.parquet(self.path).select("part", F.lit(False).alias("rows"), F.col("nodes").alias("data"))
            if len(trees) < self.trees:
                mine = self.spark.createDataFrame([(k,) for k, t in enumerate(self.top.tree) if t in trees], "part int")
                nodes = nodes.join(F.broadcast(mine), "part", "left_semi")
            met = nodes.union(sent).repartition(width, "part").sortWithinPartitions("part", "rows") \
                .mapInArrow(_met(len(self.cuts), value_of, outputs), "id long, " + ", ".join(f"{c} long" for c in outputs))
            found.append(checkpoint_table(met.groupBy(F.col("id").alias("__row")).agg(*sums), "forest_sums"))
        whole = found[0] if len(found) == 1 else reduce(DataFrame.union, found).groupBy("__row").agg(*sums)
        return rows.join(whole, "__row")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` and ``prediction``. Rows are written once,
        so that both their uses see the same numbers; those of a stream stay in
        their task, which reads the nodes, and lose ``features``."""
        if df.isStreaming:
            return self._answers(self._streamed(df))
        rows = checkpoint_table(df.withColumn("__row", F.monotonically_increasing_id()), "forest_rows")
        out = self._sums(rows, vector_to_array("features"), _full, ["__sum"])
        return self._answers(out.drop("__row"))

    def _answers(self, out: DataFrame) -> DataFrame:
        p = F.col("__sum") / F.lit(float(self.trees * ONE))
        return out.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn(
            "prediction", (p > 0.5).cast("double")).drop("__sum")

    def _streamed(self, df: DataFrame) -> DataFrame:
        """A stream's rows with the same sums as ``_sums``, without state or files of
        their own. Tasks read the folder of nodes where it is a shared path, else
        Spark's own copy of it."""
        spark, kept = self.spark, [f for f in df.schema.fields if f.name != "features"]
        ship_package(spark)
        if re.match(r"(file:|/)", self.path):
            folder, copied = re.sub(r"^file:(//)?(?=/)", "", self.path), False
        else:
            spark.sparkContext.addFile(self.path, recursive=True)
            folder, copied = self.path.rstrip("/").rsplit("/", 1)[-1], True
        rows = df.repartition(spark.sparkContext.defaultParallelism).select(*[f.name for f in kept], vector_to_array("features").alias("__x"))
        return rows.mapInArrow(_read_nodes(folder, copied, self.top, self.cuts, [f.name for f in kept]),
                               T.StructType([*kept, T.StructField("__sum", T.LongType())]))

    def cut_back_scores(self, df: DataFrame, features: str, settings: list[Setting], output: str = "probs") -> DataFrame:
        """``df`` with an array of the probabilities of all ``settings``, as ``forest.cut_back_scores``."""
        if max(s.trees for s in settings) > self.trees:
            raise ValueError("the forest has fewer trees than a setting asks for")
        rows = checkpoint_table(df.withColumn("__row", F.monotonically_increasing_id()), "forest_rows")
        names = [f"__s{k}" for k in range(len(settings))]
        out = self._sums(rows, F.col(features), _cut_back(self.top, settings), names)
        probs = [F.col(c) / F.lit(float(s.trees * ONE)) for c, s in zip(names, settings, strict=True)]
        return out.withColumn(output, F.array(*probs)).drop("__row", *names)


    def contributions(self, df: DataFrame, features: str, output: str = "contributions") -> tuple[DataFrame, float]:
        """As ``forest.contributions``, exact, without visiting every leaf for
        every row. Whole trees are dealt to tasks in groups and meet blocks of
        rows there; a group has no more nodes than ``HELD``, or one tree."""
        spark, width = self.spark, len(self.cuts)
        if width > KNOWN:
            raise ValueError(f"contributions over all sets of {width} features")
        ship_package(spark)
        rows = checkpoint_table(df.withColumn("__row", F.monotonically_increasing_id()), "forest_rows")
        nodes = spark.read.parquet(self.path)
        held = nodes.agg(F.sum(F.length("nodes")).alias("n")).first()["n"] // NODE.itemsize
        groups = min(self.trees, max(spark.sparkContext.defaultParallelism, -(-held // HELD)))
        blocks = max(1, -(-rows.count() // BLOCK_ROWS))
        keys = F.array(*map(F.lit, _spread_keys(spark, groups * blocks)))
        names = spark.createDataFrame([(k, t % groups) for k, t in enumerate(self.top.tree)], "part int, g int")
        nodes = nodes.join(F.broadcast(names), "part")
        nodes = nodes.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            F.get(keys, F.col("g") * blocks + F.col("b")).alias("key"), "part", F.lit(None).cast("long").alias("id"), F.col("nodes").alias("data"))
        inputs = rows.select(F.col("__row").alias("id"), F.lit(0).alias("y"), F.col(features).alias("x"))
        sent = inputs.mapInArrow(_binned(self.cuts), "id long, y int, bins binary") \
            .withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
                F.get(keys, F.col("g") * blocks + F.col("b")).alias("key"), F.lit(None).cast("int").alias("part"), "id", F.col("bins").alias("data"))
        names = [f"__c{k}" for k in range(width)]
        sizes = [len(c) + 1 for c in self.cuts]
        found = nodes.union(sent).repartition(groups * blocks, "key").sortWithinPartitions("key", F.col("id").asc_nulls_first(), "part") \
            .mapInArrow(_contributed(self.top, self.trees, sizes, names), "id long, " + ", ".join(f"{c} long" for c in names))
        sums = checkpoint_table(found.groupBy(F.col("id").alias("__row")).agg(*[F.sum(c).alias(c) for c in names]), "forest_contributions")
        out = rows.join(sums, "__row").withColumn(output, F.array(*[F.col(c) / F.lit(float(ONE)) for c in names]))
        roots = spark.read.parquet(self.path).where(F.col("part") < self.trees).select("part", F.substring("nodes", 1, NODE.itemsize).alias("root")).collect()
        value = dict(enumerate(self.top.value[:self.trees])) | {r["part"]: int(np.frombuffer(r["root"], NODE)["value"][0]) for r in roots}
        return out.drop("__row", *names), sum(value.values()) / self.trees / ONE


def fit_forest(data: DataFrame, label: str, trees: int, depth: int, leaf: int, seed: int) -> TableForest:
    """A forest on the vectors ``features`` and labels 0 and 1 of ``data``."""
    spark = data.sparkSession
    ship_package(spark)
    rows, input_path = written_table(data.select(F.monotonically_increasing_id().alias("id"), F.col(label).cast("int").alias("y"),
                                                 vector_to_array("features").alias("x")), "forest_input")
    width = len(rows.first()["x"])
    names = [f"f{k}" for k in range(width)]
    cuts = fit_cuts(rows.select(*[F.get("x", F.lit(k)).alias(c) for k, c in enumerate(names)]), names, BINS)
    binned, binned_path = written_table(rows.mapInArrow(_binned(cuts), "id long, y int, bins binary"), "forest_bins")
    drop_path(spark, input_path)
    none = [-1] * trees
    top = Top([*none], [*none], [*none], [0] * trees, list(range(trees)), [*none], [0] * trees, [1.0] * trees)
    n = binned.count()
    open_ = list(range(trees)) if n > PART_ROWS and depth > 0 else []
    while open_:
        sums = binned.mapInArrow(_counts(top.reached(), trees, open_, width, seed), "node long, cell long, w double, p double") \
            .groupBy("node", "cell").agg(F.sum("w").alias("w"), F.sum("p").alias("p"))
        found = sums.groupBy("node").applyInPandas(_best(width, leaf, seed), "node long, feature int, cut int, left double, right double, left_p double, right_p double").collect()
        open_ = []
        for r in sorted(found):
            if r["feature"] < 0:
                continue
            top.value[r["node"]] = round((r["left_p"] + r["right_p"]) / (r["left"] + r["right"]) * ONE)
            at = top.split(r["node"], r["feature"], r["cut"], [r["left_p"] / r["left"], r["right_p"] / r["right"]],
                           [n / (r["left"] + r["right"]) for n in (r["left"], r["right"])])
            open_ += [at + k for k, n in enumerate((r["left"], r["right"])) if n > PART_ROWS and top.depth[at] < depth]
    path = scratch_path(spark, "forest_nodes")
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = binned.rdd.getNumPartitions()
    for group in tree_groups(trees, n):
        step = max(1, len(group) * tasks // (2 * spark.sparkContext.defaultParallelism))
        dealt = [binned.mapInArrow(_dealt(top.reached(), group[k:k + step], width, seed), "part int, data binary") for k in range(0, len(group), step)]
        grown = (reduce(DataFrame.union, dealt).repartition(shuffle, "part").sortWithinPartitions("part")
                 .mapInArrow(_grown(top.depth, width, depth, leaf, seed), "part int, nodes binary"))
        with shuffles_dropped(spark):
            grown.write.mode("append").option("compression", "zstd").parquet(path)
    drop_path(spark, binned_path)
    return TableForest(spark, path, top, cuts, trees)


class ForestPipeline:
    """Preprocessor stages and a table forest, saved and loaded as one model."""

    def __init__(self, before: PipelineModel, forest: TableForest):
        self.before, self.forest = before, forest
        self.stages = [*before.stages, forest]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.forest.transform(self.before.transform(df))

    def save(self, path: str) -> None:
        spark, f = self.forest.spark, self.forest
        self.before.write().overwrite().save(path)
        spark.read.parquet(f.path).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/forest_nodes")
        shape = json.dumps([vars(f.top), f.cuts, f.trees])
        spark.createDataFrame([(shape,)], "shape string").write.mode("overwrite").parquet(f"{path}/forest_shape")


def load_forest_pipeline(spark: SparkSession, path: str) -> ForestPipeline | None:
    """The model of a folder, none if it holds no table forest."""
    shape = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/forest_shape")
    if not shape.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(shape):
        return None
    top, cuts, trees = json.loads(spark.read.parquet(f"{path}/forest_shape").first()["shape"])
    return ForestPipeline(PipelineModel.load(path), TableForest(spark, f"{path}/forest_nodes", Top(**top), cuts, trees))
