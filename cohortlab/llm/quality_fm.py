"""Document quality by a factorisation machine over hashed words, structure
statistics and metadata (the length in characters).

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), the pairwise
part as 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2): linear in the
number of features that a document has.

The model is fitted in numpy on at most ``SAMPLE_ROWS`` labelled documents (the
smallest hashes of their ids, so that reruns agree); features are computed on
the executors, for the sample and for scoring, by the same code.

Defined results: null and empty texts have no words and get the score of that;
labels without a value, or of unknown documents, do not count; without labelled
rows the score is 0.5; repeated rows get equal scores; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, map_arrow, text_of
from .text_arrays import Words, texts

BUCKETS = 1 << 14
FACTORS = 8
SAMPLE_ROWS = 6000
FOLDS = 3
HELD_OUT = 1

_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "wide": bytes(range(0xC2, 0xF5)),
    "digit": b"0123456789", "blank": b" \t\n\x0b\x0c\r", "line": b"\n", "symbol": b"#*$%&|<>@~^_=+\\{}[]/",
    "stop": b".", "comma": b",;:", "loud": b"!?", "quote": b"\"'()-",
}
_TABLES = {k: np.isin(np.arange(256), np.frombuffer(v, np.uint8)) for k, v in _CLASSES.items()}


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string")) % folds


def _distinct(h: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, owners, count per row) of the distinct values of each owner."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, owner, np.bincount(owner, minlength=rows)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(statistics [rows x k], word buckets, bounds of each row's buckets)."""
    rows = len(offsets) - 1
    w = Words(data, offsets)
    counts = np.diff(w.first)
    owner = np.repeat(np.arange(rows), counts)
    n = np.maximum(counts, 1)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.float64)

    c = {k: per_row(t[data]) for k, t in _TABLES.items()}
    chars = per_row((data & 0xC0) != 0x80)
    solid = np.maximum(chars - c["blank"], 1)
    hashes, owners, distinct = _distinct(w.hashes[0], owner, rows)
    cols = [np.log1p(chars), np.log1p(counts), np.minimum(solid / n, 40) / 10, 1 - distinct / n]
    cols += [c[k] / solid for k in ("upper", "wide", "digit", "symbol", "stop", "comma", "loud", "quote")]
    cols += [c["line"] / n, c["upper"] / np.maximum(c["upper"] + c["lower"], 1)]
    for size in (3, 8):  # share of windows that are not the first of their kind
        full = w.full(size)
        _, _, d = _distinct(w.windows(size)[full], owner[full], rows)
        total = np.bincount(owner[full], minlength=rows)
        cols.append(1 - d / np.maximum(total, 1) * (total > 0) - (total == 0))
    for k in ("symbol", "loud"):  # words that end so
        cols.append(np.bincount(owner[_TABLES[k][data[w.ends - 1]]], minlength=rows) / n)
    cols.append(np.bincount(owner, weights=(w.ends - w.starts) > 30, minlength=rows) / n)
    stats = np.stack(cols, axis=1)
    buckets, owners, _ = _distinct((hashes % np.uint64(BUCKETS)).astype(np.int64), owners, rows)
    return stats, buckets, np.searchsorted(owners, np.arange(rows + 1))


class Machine:
    """Parameters and scoring; statistics are features BUCKETS, BUCKETS + 1, ..."""

    def __init__(self, stats: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.center, self.scale = np.zeros(stats), np.ones(stats)
        self.w0 = np.zeros(1)
        self.w = np.zeros(BUCKETS + stats)
        self.v = rng.normal(0, 0.01, (BUCKETS + stats, FACTORS))

    def inputs(self, stats, buckets, at):
        """CSR (index, value, row) of the standardised features."""
        rows = len(at) - 1
        x = np.clip((stats - self.center) / self.scale, -4, 4)
        size = np.diff(at)
        row = np.concatenate([np.repeat(np.arange(rows), size), np.repeat(np.arange(rows), x.shape[1])])
        index = np.concatenate([buckets, np.tile(np.arange(x.shape[1]) + BUCKETS, rows)])
        value = np.concatenate([np.repeat(1 / np.sqrt(np.maximum(size, 1)), size), x.ravel() / 2])
        return index, value, row, rows

    def sums(self, index, value, row, rows):
        """(linear part, sum_i v_i x_i, sum_i v_i^2 x_i^2) of each row."""
        vx = self.v[index] * value[:, None]
        first = np.stack([np.bincount(row, weights=vx[:, f], minlength=rows) for f in range(FACTORS)], axis=1)
        second = np.stack([np.bincount(row, weights=vx[:, f] ** 2, minlength=rows) for f in range(FACTORS)], axis=1)
        return np.bincount(row, weights=self.w[index] * value, minlength=rows), first, second

    def scores(self, stats, buckets, at) -> np.ndarray:
        linear, first, second = self.sums(*self.inputs(stats, buckets, at))
        return sigmoid(self.w0[0] + linear + 0.5 * (first ** 2 - second).sum(axis=1))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(stats: np.ndarray, lists: list[np.ndarray], y: np.ndarray, epochs: int = 20, batch: int = 128,
        rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Machine:
    """Log loss by Adam; the same rows in the same order give the same model."""
    m = Machine(stats.shape[1], seed)
    if not len(y):
        return m
    m.center, m.scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    rng = np.random.default_rng(seed)
    params = [m.w0, m.w, m.v]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            pick = order[lo:lo + batch]
            at = np.concatenate([[0], np.cumsum([len(lists[i]) for i in pick])])
            index, value, row, rows = m.inputs(stats[pick], np.concatenate([lists[i] for i in pick]), at)
            linear, first, second = m.sums(index, value, row, rows)
            p = sigmoid(m.w0[0] + linear + 0.5 * (first ** 2 - second).sum(axis=1))
            g = (p - y[pick]) / rows
            gx = g[row] * value
            grads = [np.array([g.sum()]), np.bincount(index, weights=gx, minlength=len(m.w)) + decay * m.w]
            dv = gx[:, None] * (first[row] - m.v[index] * value[:, None])
            grads.append(np.stack([np.bincount(index, weights=dv[:, f], minlength=len(m.w))
                                   for f in range(FACTORS)], axis=1) + decay * m.v)
            step += 1
            for q, gr, (a, b) in zip(params, grads, moments, strict=True):
                a += 0.1 * (gr - a)
                b += 0.001 * (gr * gr - b)
                q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return m


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offsets in texts(b, "text"):
            stats, buckets, at = features(data, offsets)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id")[lo:hi], b.column("label")[lo:hi], pa.array(list(stats)),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(buckets.astype(np.int32)))],
                ["doc_id", "label", "stats", "buckets"])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on the labelled documents outside the held-out fold."""
    known = (labels.where(F.col("quality").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
             .select("doc_id", F.col("quality").alias("label")))
    chosen = hash_sample(known, ["doc_id", "label"], sample_rows)
    rows = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    got = map_arrow(rows, _features_of, "doc_id long, label int, stats array<double>, buckets array<int>").toPandas()
    if not len(got):
        return Machine(features(np.empty(0, np.uint8), np.zeros(1, np.int64))[0].shape[1])
    got["tie"] = [hash(tuple(x)) for x in got["stats"]]
    got = got.sort_values(["doc_id", "label", "tie"])
    return fit(np.stack(got["stats"].to_list()), got["buckets"].to_list(), (got["label"] > 0).to_numpy(float))


def _scorer(m: Machine, keep: list[str], output: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in texts(b, "__text"):
                out = pa.array(m.scores(*features(data, offsets)))
                yield pa.RecordBatch.from_arrays([*[b.column(k)[lo:hi] for k in keep], out], [*keep, output])
    return run


def score(docs: DataFrame, model: Machine, text: str = "text", keep: list[str] | None = None, output: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) and the score as ``output``,
    which replaces a column of that name; ``text`` stays as it is."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != output]
    d = docs.select(*keep, text_of(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields if f.name != "__text")
    return map_arrow(d, _scorer(model, keep, output), f"{schema}, `{output}` double")
