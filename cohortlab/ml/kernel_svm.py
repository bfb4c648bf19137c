"""Kernel support vector machine by Nystrom landmarks.

The radial kernel k(x, y) = exp(-gamma |x - y|^2) is replaced by inner products
of z(x) = k(x, landmarks) M, where M is the inverse square root of the
landmarks' own kernel matrix, computed once: on the landmarks the products equal
the kernel exactly. Landmarks are the rows with the smallest hashes of their
keys, ``landmarks`` of them at most, whatever the size of the table.

The machine minimises |w|^2 / 2 + cost * sum(max(0, 1 - y (w.z + b))^2) by Newton
steps. One pass over the rows gives objective, gradient and Hessian of the whole
fit and of all folds at once, in numpy within tasks; matrices are summed over a
tree of tasks, so the driver gets one row. Probabilities are a logistic curve
(Platt) over margins of rows that the respective fold's machine has not seen.

Defined results: rows without a label or key are not learned from; equal rows may
both be landmarks (the map then drops the direction they share); without both
labels the margin is the constant that the labels give.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

LANDMARKS = 256
FOLDS = 5
STEPS = 25
FLAT = 1e-6
FAN_IN = 16
_ROW = "objective binary, n long"


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(square, 0))


def inverse_root(kernel: np.ndarray) -> np.ndarray:
    """M with M M^T the (pseudo-)inverse of a kernel matrix."""
    values, vectors = np.linalg.eigh(kernel)
    keep = values > 1e-10 * values.max(initial=0)
    return vectors[:, keep] / np.sqrt(values[keep])


@dataclass
class KernelSvm:
    gamma: float
    landmarks: np.ndarray
    root: np.ndarray
    weights: np.ndarray  # one per column of ``root``, then the intercept
    slope: float = 1.0   # probability = 1 / (1 + exp(-(slope * margin + offset)))
    offset: float = 0.0

    def mapped(self, x: np.ndarray) -> np.ndarray:
        """z(x), and a column of ones."""
        return np.hstack([rbf(x, self.landmarks, self.gamma) @ self.root, np.ones((len(x), 1))])

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.mapped(x) @ self.weights


def _rows(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _pass(model: KernelSvm, weights: np.ndarray, folds: int):
    """Objective, gradient and Hessian of every fold's loss at its weights, as one
    row a task: problem k leaves out fold k, the last one nothing."""
    size = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = np.zeros((folds + 1, 1 + size + size * size)), 0
        for b in batches:
            if not b.num_rows:
                continue
            z, fold = model.mapped(_rows(b.column("x"))), b.column("fold").to_numpy()
            sign = np.where(b.column("y").to_numpy() > 0.5, 1.0, -1.0)
            n += len(z)
            for k in range(folds + 1):
                short = 1 - sign * (z @ weights[k])
                use = (short > 0) & (fold != k)
                zu, su, gap = z[use], sign[use], short[use]
                out[k, 0] += (gap * gap).sum()
                out[k, 1:1 + size] += -2 * (zu * (su * gap)[:, None]).sum(axis=0)
                out[k, 1 + size:] += (2 * zu.T @ zu).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary()), pa.array([n])], ["objective", "n"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for b in batches:
        for raw in b.column("objective"):
            mine = np.frombuffer(raw.as_buffer(), np.float64)
            total = mine.copy() if total is None else total + mine
        n += sum(b.column("n").to_pylist())
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n])], ["objective", "n"])


def _summed(parts: DataFrame, tasks: int) -> np.ndarray:
    """The sum of the rows of ``parts`` (one a task), over a tree of tasks."""
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(_added, _ROW)
    return np.frombuffer(parts.repartition(1).mapInArrow(_added, _ROW).first()["objective"], np.float64)


def _newton(data: DataFrame, model: KernelSvm, cost: float, folds: int, steps: int) -> np.ndarray:
    """Weights of every problem (one a fold, and the whole), by Newton steps that
    are halved while they do not lower the objective."""
    size, tasks = model.root.shape[1] + 1, data.rdd.getNumPartitions()
    w = np.zeros((folds + 1, size))
    step, best, base = np.zeros_like(w), np.full(folds + 1, math.inf), w.copy()
    ridge = np.ones(size)
    ridge[-1] = 1e-8  # the intercept is not shrunk
    open_ = np.ones(folds + 1, dtype=bool)
    for _ in range(steps):
        found = _summed(data.mapInArrow(_pass(model, w, folds), _ROW), tasks).reshape(folds + 1, -1)
        for k in np.flatnonzero(open_):
            value = 0.5 * (ridge * w[k] * w[k]).sum() + cost * found[k, 0]
            if value > best[k] and np.abs(step[k]).max() > FLAT:
                step[k] /= 2
                w[k] = base[k] + step[k]
                continue
            slope = ridge * w[k] + cost * found[k, 1:1 + size]
            bend = np.diag(ridge) + cost * found[k, 1 + size:].reshape(size, size)
            open_[k] = best[k] - value > FLAT * max(1.0, abs(value))
            best[k], base[k] = value, w[k].copy()
            if open_[k]:
                step[k] = -np.linalg.solve(bend, slope)
                w[k] = base[k] + step[k]
        if not open_.any():
            break
    return np.where(open_[:, None], base, w)


def _scale(data: DataFrame, width: int) -> float:
    """gamma = 1 / (features * variance of all their values)."""
    var = data.select(F.explode("x").alias("v")).agg(F.var_pop("v")).first()[0]
    return 1.0 / (max(width, 1) * (var or 1.0))


def fit_kernel_svm(df: DataFrame, features: str, label: str, key: str, landmarks: int = LANDMARKS, cost: float = 1.0,
                   gamma: float | None = None, folds: int = FOLDS, steps: int = STEPS) -> KernelSvm:
    """``features`` is an array of doubles of one length, without nulls."""
    ship_package(df.sparkSession)
    place = F.xxhash64(F.lit("fold"), F.col(key))
    data = df.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(features).alias("x"), F.col(label).cast("double").alias("y"),
        F.pmod(place, F.lit(folds)).cast("int").alias("fold"), F.xxhash64(F.col(key)).alias("place")).persist()
    try:
        chosen = data.orderBy("place", "x").limit(landmarks).select("x").collect()  # bounded by ``landmarks``
        points = np.array([r["x"] for r in chosen], dtype=np.float64).reshape(len(chosen), -1)
        gamma = _scale(data, points.shape[1]) if gamma is None else gamma
        model = KernelSvm(gamma, points, inverse_root(rbf(points, points, gamma)) if len(points) else np.empty((0, 0)), np.zeros(1))
        if not len(points):
            return model
        w = _newton(data, model, cost, folds, steps)
        model.weights = w[-1]
        model.slope, model.offset = _platt(data, model, w[:-1])
    finally:
        data.unpersist()
    return model


def _unseen(model: KernelSvm, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                z, fold = model.mapped(_rows(b.column("x"))), b.column("fold").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array((z * weights[fold]).sum(axis=1)), b.column("y")], ["margin", "y"])
    return run


def _platt(data: DataFrame, model: KernelSvm, weights: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve over the margins of unseen rows,
    with labels moved in by one row each, as Platt does, by Newton steps."""
    m = data.mapInArrow(_unseen(model, weights), "margin double, y double").persist()
    try:
        counts = m.agg(F.sum("y").alias("up"), F.count("*").alias("n")).first()
        up, down = counts["up"] or 0.0, counts["n"] - (counts["up"] or 0.0)
        high, low = (up + 1) / (up + 2), 1 / (down + 2)
        a, b, best, step = 0.0, math.log((up + 1) / (down + 1)), math.inf, (0.0, 0.0)
        for _ in range(steps):
            v = F.col("margin") * a + b
            p, t = 1 / (1 + F.exp(-v)), F.when(F.col("y") > 0.5, high).otherwise(low)
            h = p * (1 - p)
            # log(1 + e^v) - t v, without overflow
            loss = F.greatest(v, F.lit(0.0)) + F.log1p(F.exp(-F.abs(v))) - t * v
            r = m.agg(F.sum(loss).alias("loss"), F.sum((p - t) * F.col("margin")).alias("ga"), F.sum(p - t).alias("gb"),
                      F.sum(h * F.col("margin") * F.col("margin")).alias("haa"), F.sum(h * F.col("margin")).alias("hab"),
                      F.sum(h).alias("hbb")).first()
            if r["loss"] > best + 1e-12 and max(map(abs, step)) > 1e-10:
                step = (step[0] / 2, step[1] / 2)
                a, b = a - step[0], b - step[1]
                continue
            if best - r["loss"] < 1e-9 * max(1.0, best if math.isfinite(best) else 1.0):
                break
            best = r["loss"]
            haa, hbb = r["haa"] + 1e-12, r["hbb"] + 1e-12
            det = haa * hbb - r["hab"] ** 2
            step = (-(hbb * r["ga"] - r["hab"] * r["gb"]) / det, -(haa * r["gb"] - r["hab"] * r["ga"]) / det)
            a, b = a + step[0], b + step[1]
        return a, b
    finally:
        m.unpersist()


def score_kernel_svm(df: DataFrame, model: KernelSvm, features: str, margin: str = "margin", prob: str = "prob") -> DataFrame:
    """``df`` with the margin and the probability of label 1 added."""
    ship_package(df.sparkSession)
    kept = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = model.margins(_rows(b.column(features))) if b.num_rows else np.empty(0)
            p = 1 / (1 + np.exp(-(model.slope * m + model.offset)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(m), pa.array(p)], [*kept, margin, prob])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(margin, T.DoubleType()), T.StructField(prob, T.DoubleType())]))


def save_kernel_svm(model: KernelSvm, path: str, spark: SparkSession) -> str:
    """One row a landmark (its point, its row of the map), and one of the rest."""
    spark.createDataFrame([(i, x.tolist(), r.tolist()) for i, (x, r) in enumerate(zip(model.landmarks, model.root, strict=True))],
                          "place int, x array<double>, root array<double>").write.mode("overwrite").parquet(f"{path}/landmarks")
    spark.createDataFrame([(model.gamma, model.weights.tolist(), model.slope, model.offset)],
                          "gamma double, weights array<double>, slope double, shift double").write.mode("overwrite").parquet(f"{path}/machine")
    return path


def load_kernel_svm(path: str, spark: SparkSession) -> KernelSvm:
    rows = spark.read.parquet(f"{path}/landmarks").orderBy("place").collect()
    m = spark.read.parquet(f"{path}/machine").first()
    return KernelSvm(m["gamma"], np.array([r["x"] for r in rows]), np.array([r["root"] for r in rows]),
                     np.array(m["weights"]), m["slope"], m["shift"])
