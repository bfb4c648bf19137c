"""Fitted random forests as node tables: scores of cut-back forests, and exact
contributions (M17, W9).

``node_table`` reads the nodes of a fitted Spark forest from the files that
Spark's own writer makes of it. ``Forest`` holds them as arrays, as large as the
fitted model itself, and goes to the tasks with the job.

Cut-back forests. A tree grown to a depth limit, or with a least number of rows
to split a node, is the unlimited tree cut back there, as a node's split depends
on its own rows alone. One forest therefore answers for every smaller depth,
larger split size and (its first trees) smaller number of trees: ``cut_back_scores``
gives a probability per setting in one pass.

Contributions (path-dependent Shapley values). Where a feature is not known, a
row goes down both sides of its splits in proportion to the training rows there.
A feature's contribution is its mean gain over all orders in which features
become known; contributions and the base value add up to the forest's
probability. Each leaf is one product over the features on its path (interval of
values, share of rows), whose sums over all subsets come from its polynomial:
O(d^2) for a leaf below d features.

Defined results: a NaN input follows Spark's own rule (it is not below any
threshold, so it goes right); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path, ship_package

CELLS = 1 << 22  # values that a task holds at once for (rows, leaves)


@dataclass(frozen=True)
class Setting:
    """A random forest's size: trees, depth limit, least rows to split a node."""

    trees: int
    depth: int
    split: int = 2


@dataclass
class Forest:
    """All nodes of all trees: feature (-1: a leaf), threshold (at most it goes
    left), children, depth, training rows and probability of label 1; ``roots``
    has the place of each tree's root."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    rows: np.ndarray
    weight: np.ndarray
    value: np.ndarray
    roots: np.ndarray


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """(tree, node, feature, threshold, left, right, rows, weight, value) of a
    saved RandomForestClassificationModel. ``weight`` counts a training row as
    often as the tree drew it."""
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    stats = F.col("impurityStats")
    weight = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return nodes.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).alias("feature"),
        F.when(F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.col("split.numCategories").alias("categories"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.col("rawCount").alias("rows"), weight.alias("weight"), (stats[1] / weight).alias("value"))


def load_forest(model: RandomForestClassificationModel, spark: SparkSession) -> Forest:
    """The nodes of a fitted forest as arrays (as many as the model itself holds)."""
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    frame = node_table(spark, path).orderBy("tree", "node").toPandas()
    drop_path(spark, path)
    split = frame["feature"].notna()
    if (frame.loc[split, "categories"] >= 0).any():
        raise ValueError("splits on categories have no thresholds")
    tree = frame["tree"].to_numpy()
    roots = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]])) if len(frame) else np.empty(0, np.int64)
    base = roots[np.searchsorted(roots, np.arange(len(frame)), side="right") - 1] if len(frame) else roots
    # ids run from 0 within a tree, so a node's place is its root's plus its id
    left = np.where(split, base + frame["left"].to_numpy(), -1)
    right = np.where(split, base + frame["right"].to_numpy(), -1)
    depth = np.zeros(len(frame), dtype=np.int32)
    for i in np.flatnonzero(split):  # parents come before their children
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    return Forest(frame["feature"].fillna(-1).to_numpy(np.int32), frame["threshold"].fillna(math.nan).to_numpy(np.float64),
                  left, right, depth, frame["rows"].to_numpy(np.int64), frame["weight"].to_numpy(np.float64),
                  frame["value"].to_numpy(np.float64), roots)


def _rows(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


# ------------------------------------------------------------------ cut-back forests

def leaves_of(forest: Forest, depth: int, split: int) -> np.ndarray:
    """Which nodes are leaves of the forest cut back to a depth and split size.
    As Spark does after growing, two leaves that predict the same label are put
    together, from the bottom up."""
    out = (forest.feature < 0) | (forest.depth >= depth) | (forest.rows < split)
    label = forest.value > 0.5
    for level in range(int(forest.depth.max(initial=0)) - 1, -1, -1):
        inner = np.flatnonzero((forest.depth == level) & ~out)
        left, right = forest.left[inner], forest.right[inner]
        out[inner[out[left] & out[right] & (label[left] == label[right])]] = True
    return out


def cut_back(forest: Forest, x: np.ndarray, settings: list[Setting], stops: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
    """(rows, settings) probabilities of label 1; ``stops`` has ``leaves_of`` of every depth and split size."""
    most = max(s.trees for s in settings)
    if most > len(forest.roots):
        raise ValueError("the forest has fewer trees than a setting asks for")
    at = np.repeat(forest.roots[None, :most], len(x), axis=0)
    value = {k: np.full(at.shape, np.nan) for k in stops}
    row = np.arange(len(x))[:, None]
    while True:
        for k, v in value.items():
            ends = np.isnan(v) & stops[k][at]
            v[ends] = forest.value[at[ends]]
        f = forest.feature[at]
        open_ = f >= 0
        if not open_.any():
            break
        left = x[row, np.maximum(f, 0)] <= forest.threshold[at]
        at = np.where(open_, np.where(left, forest.left[at], forest.right[at]), at)
    return np.stack([value[s.depth, s.split][:, :s.trees].mean(axis=1) for s in settings], axis=1)


def cut_back_scores(df: DataFrame, features: str, forest: Forest, settings: list[Setting], output: str = "probs") -> DataFrame:
    """``df`` with an array of the probabilities of all ``settings``; ``features``
    is an array of doubles."""
    ship_package(df.sparkSession)
    kept, room = df.columns, max(1, CELLS // (max(s.trees for s in settings) * 4))
    stops = {k: leaves_of(forest, *k) for k in {(s.depth, s.split) for s in settings}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, room):
                b = whole.slice(lo, room)
                probs = cut_back(forest, _rows(b.column(features)), settings, stops)
                lists = pa.ListArray.from_arrays(np.arange(len(probs) + 1, dtype=np.int32) * len(settings), pa.array(probs.ravel()))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], lists], [*kept, output])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.DoubleType()))]))


# ------------------------------------------------------------------ contributions

@dataclass
class Leaves:
    """Leaves below the same number of distinct features: which ones, the
    interval (low, high] of each, the share of rows that its splits let through,
    and the leaf's value."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaf_paths(forest: Forest) -> tuple[float, dict[int, Leaves]]:
    """The base value (mean over trees of the value with nothing known), and all
    leaves by their number of features."""
    found: dict[int, list] = {}
    base = 0.0
    for root in forest.roots.tolist():
        stack = [(root, {})]
        while stack:
            i, path = stack.pop()
            f = int(forest.feature[i])
            if f < 0:
                share = math.prod(p[2] for p in path.values())
                base += share * forest.value[i]
                found.setdefault(len(path), []).append(([(k, *p) for k, p in path.items()], forest.value[i]))
                continue
            low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
            cut = forest.threshold[i]
            for child, bounds in ((forest.left[i], (low, min(high, cut))), (forest.right[i], (max(low, cut), high))):
                stack.append((int(child), path | {f: (*bounds, share * forest.weight[child] / forest.weight[i])}))
    out = {}
    for d, rows in found.items():
        columns = [np.array([[p[k] for p in path] for path, _ in rows], dtype=kind).reshape(len(rows), d)
                   for k, kind in enumerate((np.int32, float, float, float))]
        out[d] = Leaves(*columns, np.array([v for _, v in rows]))
    return base / max(len(forest.roots), 1), out


def leaf_contributions(leaves: Leaves, x: np.ndarray, width: int) -> np.ndarray:
    """(rows, width) sums over the leaves of every feature's contribution."""
    d, out = leaves.feature.shape[1], np.zeros((len(x), width))
    if d == 0 or not len(x):
        return out
    weights = [math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)]
    step = max(1, CELLS // (len(x) * (d + 2)))
    for lo in range(0, len(leaves.value), step):
        part = slice(lo, lo + step)
        z, v = leaves.share[part], leaves.value[part]
        own = x[:, leaves.feature[part]]
        # a NaN is not at most any threshold: it is inside only where nothing bounds it from above
        inside = ((own > leaves.low[part]) | np.isnan(own) | np.isneginf(leaves.low[part])) & \
            ((own <= leaves.high[part]) | np.isposinf(leaves.high[part]))
        poly = [np.ones(inside.shape[:2])] + [np.zeros(inside.shape[:2]) for _ in range(d)]
        for j in range(d):  # times (share + inside * t)
            for s in range(j + 1, 0, -1):
                poly[s] = poly[s] * z[:, j] + poly[s - 1] * inside[:, :, j]
            poly[0] = poly[0] * z[:, j]
        for j in range(d):
            one, total = inside[:, :, j], np.zeros(inside.shape[:2])
            # the product without feature j: divided by (share + t) from the top, or by share
            q = np.zeros(inside.shape[:2])
            for s in range(d - 1, -1, -1):
                q = np.where(one, poly[s + 1] - z[:, j] * q, poly[s] / z[:, j])
                total += weights[s] * q
            gain = total * (one - z[:, j]) * v
            for f in np.unique(leaves.feature[part, j]):
                out[:, f] += gain[:, leaves.feature[part, j] == f].sum(axis=1)
    return out


def contributions(df: DataFrame, features: str, forest: Forest, width: int, output: str = "contributions") -> tuple[DataFrame, float]:
    """``df`` with an array of every feature's contribution to the probability of
    label 1, and the base value that they start from."""
    ship_package(df.sparkSession)
    base, groups = leaf_paths(forest)
    kept, trees, room = df.columns, max(len(forest.roots), 1), 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, room):
                b = whole.slice(lo, room)
                x = _rows(b.column(features))
                total = sum((leaf_contributions(g, x, width) for g in groups.values()), np.zeros((len(x), width))) / trees
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * width, pa.array(total.ravel()))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], lists], [*kept, output])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.DoubleType()))])), base


def ranked(df: DataFrame, key: str, names: list[str], n: int, column: str = "contributions") -> DataFrame:
    """Per row the ``n`` features with the largest contributions by size
    (ties by name), with their direction; sorted inside each row's array."""
    items = F.transform(column, lambda v, i: F.struct((-F.abs(v)).alias("size"), F.get(F.array(*map(F.lit, names)), i).alias("feature"),
                                                      v.alias("contribution")))
    top = F.slice(F.array_sort(items), 1, n)
    out = df.select(key, F.posexplode(top).alias("place", "c"))
    return out.select(key, (F.col("place") + 1).alias("rank"), F.col("c.feature").alias("feature"),
                      F.col("c.contribution").alias("contribution"), direction(F.col("c.contribution")).alias("direction"))


def direction(v: Column) -> Column:
    return F.when(v >= 0, "raises").otherwise("lowers")
