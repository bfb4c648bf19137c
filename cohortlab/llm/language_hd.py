"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is bound as
rot2(a) * rot1(b) * c (rotation keeps the order, the product binds), a document
is the bundle (sum) of its trigrams, a language the bundle of its documents at
unit length. A document takes the language of the largest cosine, and that
cosine (0 at least) is its score. Runs of other characters count as one blank,
which has a vector of its own.

Prototypes come from about ``PER_LANGUAGE`` documents of each language at most,
chosen by a hash of the id; their sums are whole numbers, so reruns agree.

Defined results: without a letter (or text) the language is ``und`` and the
score 0, as it is for all if nothing is learned; ties go to the first language
in code-point order; repeated rows get equal results; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_of
from .quality_fm import fold

DIMENSIONS = 1024
PER_LANGUAGE = 2000
FOLDS = 4
HELD_OUT = 2
MOST_LANGUAGES = 4096
UNIT = 1 << 20
CHUNK = 1 << 19
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Lower-case code point of each letter, 0 for every other code point."""
    table = np.zeros(0x110000, dtype=np.int64)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


@lru_cache(maxsize=1 << 13)
def letter_vector(cp: int) -> np.ndarray:
    return np.random.default_rng(cp + 1).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1


def trigrams(cps: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, owner row, letters per row) of the texts' letter trigrams."""
    rows = len(bounds) - 1
    letters = letter_table()[cps]
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    per_row = np.bincount(owner[letters > 0], minlength=rows)
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = (letters[1:] > 0) | (letters[:-1] > 0) | (owner[1:] != owner[:-1])
    letters, owner = letters[keep], owner[keep]
    # a blank on either side of each text
    edge = np.flatnonzero(np.diff(owner, prepend=-1, append=rows))
    letters, owner = np.insert(letters, edge, 0), np.insert(owner, edge, owner[np.minimum(edge, len(owner) - 1)] if len(owner) else 0)
    a, b, c = letters[:-2], letters[1:-1], letters[2:]
    ok = (owner[:-2] == owner[2:]) & (a + b + c > 0)
    return ((a << 42) | (b << 21) | c)[ok], owner[:-2][ok], per_row


def bind(codes: np.ndarray) -> np.ndarray:
    """The bound vectors of distinct trigram codes."""
    mask = (1 << 21) - 1
    parts = [codes >> 42, (codes >> 21) & mask, codes & mask]
    out = np.ones((len(codes), DIMENSIONS), dtype=np.int8)
    for turn, p in zip((2, 1, 0), parts, strict=True):
        values, at = np.unique(p, return_inverse=True)
        out *= np.stack([np.roll(letter_vector(int(v)), turn) for v in values])[at]
    return out


def bundles(cps: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, letters) of each text; a text without letters is all 0."""
    codes, owner, per_row = trigrams(cps, bounds)
    rows = len(bounds) - 1
    out = np.zeros((rows, DIMENSIONS), dtype=np.float32)
    values, at = np.unique(codes, return_inverse=True)
    for lo in range(0, len(values), 8192):  # a bounded number of trigrams at a time
        here = (at >= lo) & (at < lo + 8192)
        width = min(8192, len(values) - lo)
        counts = np.bincount(owner[here] * width + at[here] - lo, minlength=rows * width).reshape(rows, width)
        out += counts.astype(np.float32) @ bind(values[lo:lo + width]).astype(np.float32)
    size = np.sqrt((out.astype(np.float64) ** 2).sum(axis=1))
    return out / np.maximum(size, 1e-9)[:, None].astype(np.float32), per_row


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    lo, size, held = 0, 0, []
    values = column.to_pylist()
    for i, t in enumerate(values):
        held.append(t or "")
        size += len(held[-1])
        if size >= CHUNK or i + 1 == len(values):
            raw = "".join(held).encode("utf-32-le", "replace")
            yield lo, i + 1, np.frombuffer(raw, np.uint32).astype(np.int64), \
                np.concatenate([[0], np.cumsum([len(x) for x in held])])
            lo, size, held = i + 1, 0, []


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), dtype=object)
        for lo, hi, cps, bounds in _chunks(b.column("text")):
            v, letters = bundles(cps, bounds)
            whole = np.rint(v.astype(np.float64) * UNIT).astype(np.int64)
            here = langs[lo:hi]
            for lang in sorted(set(here[letters > 0])):
                total = whole[(here == lang) & (letters > 0)].sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total])], ["lang", "v"])


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Unit prototypes of the languages outside the held-out fold."""
    known = docs.where(F.col("lang").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
    sizes = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang")
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(place < F.element_at(share, F.col("lang"))).select("lang", text_of("text").alias("text"))
    rows = (map_arrow(sample, _profiles, "lang string, v array<long>")
            .select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .toPandas().sort_values(["lang", "i"]))
    out = {}
    for lang, part in rows.groupby("lang", sort=True):
        v = part["x"].to_numpy(float)
        out[lang] = v / max(np.sqrt((v ** 2).sum()), 1e-9)
    return out


def _predict(langs: list[str], prototypes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, cps, bounds in _chunks(b.column("text")):
                v, letters = bundles(cps, bounds)
                pred = np.full(hi - lo, UNKNOWN, dtype=object)
                score = np.zeros(hi - lo)
                if langs:
                    cosine = np.round(v.astype(np.float64) @ prototypes.T, 9)
                    best = cosine.argmax(axis=1)
                    has = letters > 0
                    pred[has] = np.array(langs, dtype=object)[best[has]]
                    score[has] = np.clip(cosine[np.arange(hi - lo), best], 0, 1)[has]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], pa.array(pred.tolist(), pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score)"""
    langs = sorted(prototypes)
    table = np.stack([prototypes[k] for k in langs]) if langs else np.zeros((0, DIMENSIONS))
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")),
                     _predict(langs, table), "doc_id long, lang_pred string, score double")
