"""Second-order gradient boosting over histograms.

Every feature is cut into at most 255 bins at its quantiles; a missing value has
a bin of its own. A round grows one tree level by level. For each level one job
sums gradients p - y and Hessians p (1 - p) of the log loss by (node, feature,
bin): within tasks in numpy, and dealt by (node, feature). Running sums over the
bins of each (node, feature) give the regularised gain of every cut, with the
missing rows on the left and on the right, and the best ones come back to the
driver (at most 2^depth rows a task). Leaves take the Newton step
-G / (H + reg), times the learning rate.

Rows never leave the executors: tasks rebuild
their margins from the stored one and the trees since, and every few rounds (``STORED``;
``STORED_SMALL`` if one task has all rows) margins are written to the shared folder. A task holds 24 bytes for each (node of
the level, feature, bin).

Defined results: a null or NaN feature is missing and follows the side learned
for its node (right where training had none); rows without a label are not
learned from; a constant feature is never cut; without rows, or with all labels
equal, trees are single leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import exact_quantiles
from ..session import drop_path, ship_package
from ..sources.tables import written_table

ABSENT = 255  # the bin of missing values
STORED = 2         # walking a tree again in every level costs more than writing margins
STORED_SMALL = 10  # for a small table the writing job costs more
LEAST_GAIN = 1e-6
ROWS_PER_TASK = 50_000
ONE_TASK = 1 << 21  # sums of a level that one task may add up
_HISTOGRAM = "node int, feature int, bin int, g double, h double, n long"


@dataclass(frozen=True)
class BoostSpec:
    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    reg: float = 1.0
    min_gain: float = 0.0
    child_weight: float = 1.0
    bins: int = 255
    base: float = 0.5


@dataclass
class Tree:
    """A binary tree in heap order: children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray       # -1: a leaf
    cut: np.ndarray           # bins up to this one go left
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of ``bins`` ends in."""
        at = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            b = bins[rows, np.maximum(f, 0)]
            left = np.where(b == ABSENT, self.missing_left[at], b <= self.cut[at])
            at = np.where(inner, 2 * at + 2 - left, at)


@dataclass
class Booster:
    features: list[str]
    cuts: list[list[float]]  # per feature: x belongs to the first bin whose cut is not below it
    spec: BoostSpec
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # mean log loss before each round, and after the last

    def table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, missing_left, value) of all nodes in use."""
        rows = []
        for t, tree in enumerate(self.trees):
            use = [0]
            while use:
                i = use.pop()
                f = int(tree.feature[i])
                # all known values to the left of the missing ones: no cut, so an infinite one
                cut = None if f < 0 else [*self.cuts[f], math.inf][int(tree.cut[i])]
                rows.append((t, i, None if f < 0 else self.features[f], cut, bool(tree.missing_left[i]), float(tree.value[i])))
                use += [2 * i + 1, 2 * i + 2] if f >= 0 else []
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, missing_left boolean, value double")


# ------------------------------------------------------------------ bins

def fit_cuts(df: DataFrame, features: list[str], bins: int, exact: bool = False) -> list[list[float]]:
    """Cut values per feature at its quantiles; the last bin is open. ``exact``
    interpolates between values, otherwise a mergeable sketch picks among them."""
    if not 2 <= bins <= ABSENT:
        raise ValueError(f"2 to {ABSENT} bins")
    probs = [k / bins for k in range(1, bins)]
    if exact:
        long = df.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot([], features, "column", "value")
        found: dict[str, list] = {}
        for r in exact_quantiles(long, "column", "value", probs).collect():
            found.setdefault(r["column"], []).append(r["q"])
    else:
        row = df.agg(*[F.percentile_approx(_number(c), probs, 20_000).alias(c) for c in features]).first()
        found = {c: row[c] or [] for c in features}
    return [sorted({float(v) for v in found.get(c, []) if v is not None}) for c in features]


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _bins(columns: list[np.ndarray], cuts: list[list[float]]) -> np.ndarray:
    out = np.empty((len(columns[0]) if columns else 0, len(columns)), dtype=np.uint8)
    for k, (x, c) in enumerate(zip(columns, cuts, strict=True)):
        out[:, k] = np.where(np.isnan(x), ABSENT, np.searchsorted(np.array(c), x, side="left"))
    return out


def _numbers(b: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [b.column(c).fill_null(math.nan).to_numpy(zero_copy_only=False) for c in names]


def _binned(cuts: list[list[float]], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = _bins(_numbers(b, names), cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in raw], pa.binary()), b.column("y"), pa.array(np.zeros(b.num_rows))],
                ["bins", "y", "margin"])
    return run


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Values of ``width`` bytes each as a matrix, read where Arrow holds them."""
    if not len(column):
        return np.empty((0, width), np.uint8)
    _, places, held = column.buffers()
    ends = np.frombuffer(places, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    first, last = int(ends[column.offset]), int(ends[column.offset + len(column)])
    return np.frombuffer(held, np.uint8)[first:last].reshape(len(column), width)


# ------------------------------------------------------------------ one level

def _margins(b: pa.RecordBatch, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    out = b.column("margin").to_numpy().copy()
    for t in trees:
        out += t.value[t.nodes(bins)]
    return out


def _level(trees: list[Tree], tree: Tree, level: int, width: int):
    """Sums of each (node of the level, feature, bin) in a task; node -1 has the
    loss (as g) and the rows before the tree."""
    first, nodes = 2 ** level - 1, 2 ** level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, nodes * width * 256))
        loss, rows = 0.0, 0
        for b in batches:
            bins, y = _matrix(b.column("bins"), width), b.column("y").to_numpy()
            margin = _margins(b, bins, trees)
            p = 1 / (1 + np.exp(-margin))
            loss += float(np.logaddexp(0, np.where(y > 0.5, -margin, margin)).sum())
            rows += len(y)
            at = tree.nodes(bins) - first
            use = (at >= 0) & (at < nodes)
            cell = ((at[use, None] * width + np.arange(width)) * 256 + bins[use]).ravel()
            for k, v in enumerate(((p - y)[use], (p * (1 - p))[use], np.ones(int(use.sum())))):
                sums[k] += np.bincount(cell, weights=np.repeat(v, width), minlength=sums.shape[1])
        found = np.flatnonzero(sums[2])
        node, rest = np.divmod(found, width * 256)
        columns = [node, rest // 256, rest % 256, sums[0][found], sums[1][found], sums[2][found]]
        columns = [np.append(c, v) for c, v in zip(columns, (-1, -1, -1, loss, 0.0, rows), strict=True)]
        kinds = [pa.int32()] * 3 + [pa.float64()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c).cast(k, safe=False) for c, k in zip(columns, kinds, strict=True)],
                                         ["node", "feature", "bin", "g", "h", "n"])
    return run


_CUTS = ("node int, feature int, bin int, gain double, missing_left boolean, g_left double, h_left double, n_left long, "
         "g double, h double, n long")


def _cut_rows(batches: Iterator[pa.RecordBatch], spec: BoostSpec) -> dict[str, np.ndarray]:
    """Every cut of the (node, feature) groups whose sums a task has, by node,
    feature and bin; a loss row (node -1) keeps its sums."""
    parts = [[b.column(c).to_numpy() for c in ("node", "feature", "bin", "g", "h", "n")] for b in batches]
    node, feature, bin_, g, h, n = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.empty(0)] * 6
    loss = node < 0
    wide = int(feature.max(initial=0)) + 1
    keys, group = np.unique(node[~loss].astype(np.int64) * wide + feature[~loss], return_inverse=True)
    sums = np.zeros((3, len(keys), 256))
    for k, v in enumerate((g, h, n)):
        np.add.at(sums[k], (group, bin_[~loss].astype(np.int64)), v[~loss])
    whole, gone, upto = sums.sum(axis=2), sums[:, :, ABSENT], np.cumsum(sums[:, :, :ABSENT], axis=2)

    def side(extra: int) -> tuple[np.ndarray, np.ndarray]:
        left = upto + extra * gone[:, :, None]
        right = whole[:, :, None] - left
        score = left[0] ** 2 / (left[1] + spec.reg) + right[0] ** 2 / (right[1] + spec.reg) - (whole[0] ** 2 / (whole[1] + spec.reg))[:, None]
        ok = (left[2] > 0) & (right[2] > 0) & (left[1] >= spec.child_weight) & (right[1] >= spec.child_weight)
        return np.where(ok, score, -np.inf), left

    with np.errstate(divide="ignore", invalid="ignore"):
        (gain_l, left_l), (gain_r, left_r) = side(1), side(0)
    to_left = (gone[2] > 0)[:, None] & (np.maximum(gain_l, -1) > np.maximum(gain_r, -1))
    gain, left = np.where(to_left, gain_l, gain_r), np.where(to_left, left_l, left_r)
    at, cut = np.nonzero(sums[2][:, :ABSENT])
    out = {"node": keys[at] // wide, "feature": keys[at] % wide, "bin": cut, "gain": gain[at, cut], "missing_left": to_left[at, cut],
           "g_left": left[0][at, cut], "h_left": left[1][at, cut], "n_left": left[2][at, cut],
           "g": whole[0][at], "h": whole[1][at], "n": whole[2][at]}
    if loss.any():
        own = {"node": -1, "feature": -1, "bin": -1, "gain": -np.inf, "missing_left": False, "g": g[loss].sum(), "n": n[loss].sum()}
        out = {k: np.append(v, own.get(k, 0)) for k, v in out.items()}
    return out


def _cuts(spec: BoostSpec, best: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _cut_rows(batches, spec)
        if best:  # of each node here: the greatest gain, then the first feature and bin
            order = np.lexsort((rows["bin"], rows["feature"], -np.maximum(rows["gain"], -1), rows["node"]))
            node = rows["node"][order]
            first = np.ones(len(node), dtype=bool)
            first[1:] = node[1:] != node[:-1]
            rows = {k: v[order[first]] for k, v in rows.items()}
        kinds = {"node": pa.int32(), "feature": pa.int32(), "bin": pa.int32(), "missing_left": pa.bool_(), "n_left": pa.int64(), "n": pa.int64()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, mask=np.isneginf(v) if k == "gain" else None).cast(kinds.get(k, pa.float64()), safe=False) for k, v in rows.items()],
            list(rows))
    return run


def gains(sums: DataFrame, spec: BoostSpec) -> DataFrame:
    """Every cut of every node: (node, feature, bin, gain, missing_left, g, h, n
    of its left side and of the node). Gains are null where a side has no rows or
    too little weight."""
    return sums.mapInArrow(_cuts(spec, False), _CUTS)


# ------------------------------------------------------------------ fitting

def histogram(data: DataFrame, trees: list[Tree], tree: Tree, level: int, width: int, tasks: int) -> DataFrame:
    """Sums of (node, feature, bin), a task's sums each, dealt by (node, feature); to
    one task if they are few in total."""
    parts = data.mapInArrow(_level(trees, tree, level, width), _HISTOGRAM)
    if tasks * 2 ** level * width * 256 > ONE_TASK:
        # loss rows have a feature of their own, so they fall to one of the tasks
        parts = parts.repartition(int(data.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node", "feature")
    elif tasks > 1:
        parts = parts.repartition(1)
    return parts


def binned(df: DataFrame, features: list[str], label: str, cuts: list[list[float]]) -> DataFrame:
    """(bins, y, margin) of the labelled rows, margins at zero."""
    ship_package(df.sparkSession)
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), *[_number(c).alias(c) for c in features])
    return rows.mapInArrow(_binned(cuts, features), "bins binary, y double, margin double")


def _grown(data: DataFrame, trees: list[Tree], spec: BoostSpec, width: int, tasks: int) -> tuple[Tree, float]:
    """The next tree, and the mean loss before it."""
    tree, loss = Tree.empty(spec.depth), math.nan
    for level in range(spec.depth):
        first = 2 ** level - 1
        sums = histogram(data, trees, tree, level, width, tasks)
        found = sums.mapInArrow(_cuts(spec, True), _CUTS).collect()  # a row for each node of the level that a task has
        lost = [r for r in found if r["node"] < 0]
        if level == 0 and sum(r["n"] for r in lost):
            loss = sum(r["g"] for r in lost) / sum(r["n"] for r in lost)
        best: dict[int, Row] = {}
        for r in sorted(found, key=lambda r: (-1 if r["gain"] is None else r["gain"], -r["feature"], -r["bin"])):
            best[r["node"]] = r
        rows = [r for k, r in best.items() if k >= 0]
        split = False
        for r in rows:
            i = first + r["node"]
            tree.value[i] = -spec.rate * r["g"] / (r["h"] + spec.reg)
            if r["gain"] is None or r["gain"] - spec.min_gain <= LEAST_GAIN:
                continue
            split = True
            tree.feature[i], tree.cut[i], tree.missing_left[i] = r["feature"], r["bin"], r["missing_left"]
            tree.value[2 * i + 1] = -spec.rate * r["g_left"] / (r["h_left"] + spec.reg)
            tree.value[2 * i + 2] = -spec.rate * (r["g"] - r["g_left"]) / (r["h"] - r["h_left"] + spec.reg)
        if not split:
            break
    return tree, loss


def _advanced(trees: list[Tree], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margin = _margins(b, _matrix(b.column("bins"), width), trees)
            yield pa.RecordBatch.from_arrays([b.column("bins"), b.column("y"), pa.array(margin)], ["bins", "y", "margin"])
    return run


def _loss(trees: list[Tree], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y, margin = b.column("y").to_numpy(), _margins(b, _matrix(b.column("bins"), width), trees)
            yield pa.RecordBatch.from_arrays([pa.array(np.logaddexp(0, np.where(y > 0.5, -margin, margin)))], ["loss"])
    return run


def fit_boosting(df: DataFrame, features: list[str], label: str, spec: BoostSpec = BoostSpec(),
                 cuts: list[list[float]] | None = None) -> Booster:
    """Trees fitted to the rows with a label (0 or 1)."""
    cuts = fit_cuts(df.where(F.col(label).isNotNull()), features, spec.bins) if cuts is None else cuts
    out, width = Booster(features, cuts, spec), len(features)
    start = math.log(spec.base / (1 - spec.base))
    rows = binned(df, features, label, cuts).withColumn("margin", F.lit(start))
    tasks = max(1, -(-df.where(F.col(label).isNotNull()).count() // ROWS_PER_TASK))  # a small table is all overhead
    if tasks < rows.rdd.getNumPartitions():
        rows = rows.coalesce(tasks)
    data, path = written_table(rows, "boost_rows")
    since: list[Tree] = []
    tasks = data.rdd.getNumPartitions()
    for k in range(spec.rounds):
        tree, loss = _grown(data, since, spec, width, tasks)
        out.trees.append(tree)
        out.losses.append(loss)
        since.append(tree)
        if len(since) == (STORED if tasks > 1 else STORED_SMALL) and k + 1 < spec.rounds:
            moved, new = written_table(data.mapInArrow(_advanced(since, width), "bins binary, y double, margin double"), "boost_rows")
            drop_path(df.sparkSession, path)
            data, path, since = moved, new, []
    last = data.mapInArrow(_loss(since, width), "loss double").agg(F.avg("loss")).first()[0]
    out.losses.append(math.nan if last is None else last)
    drop_path(df.sparkSession, path)
    return out


def score_boosted(df: DataFrame, model: Booster, output: str = "prob") -> DataFrame:
    """``df`` with the probability of label 1 added; the features must be columns of it."""
    ship_package(df.sparkSession)
    kept, names = df.columns, [f"__x{i}" for i in range(len(model.features))]
    start = math.log(model.spec.base / (1 - model.spec.base))
    trees, cuts = model.trees, model.cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = _bins(_numbers(b, names), cuts)
            margin = np.full(b.num_rows, start)
            for t in trees:
                margin += t.value[t.nodes(bins)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(1 / (1 + np.exp(-margin)))], [*kept, output])

    rows = df.select(*kept, *[_number(c).alias(n) for c, n in zip(model.features, names, strict=True)])
    return rows.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(output, T.DoubleType())]))


def save_boosted(model: Booster, path: str, spark: SparkSession) -> str:
    """The model as two tables: nodes, and cuts by feature."""
    model.table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(i, f, c, model.spec.depth, model.spec.base) for i, (f, c) in enumerate(zip(model.features, model.cuts, strict=True))],
                          "place int, feature string, cuts array<double>, depth int, base double") \
        .write.mode("overwrite").parquet(f"{path}/cuts")
    return path


def load_boosted(path: str, spark: SparkSession) -> Booster:
    rows = spark.read.parquet(f"{path}/cuts").orderBy("place").collect()
    out = Booster([r["feature"] for r in rows], [list(r["cuts"]) for r in rows],
                  BoostSpec(depth=rows[0]["depth"], base=rows[0]["base"]))
    place = {f: i for i, f in enumerate(out.features)}
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
        while len(out.trees) <= r["tree"]:
            out.trees.append(Tree.empty(out.spec.depth))
        t, i = out.trees[r["tree"]], r["node"]
        t.value[i], t.missing_left[i] = r["value"], r["missing_left"]
        if r["feature"] is not None:
            f = place[r["feature"]]
            t.feature[i], t.cut[i] = f, [*out.cuts[f], math.inf].index(r["threshold"])
    return out
