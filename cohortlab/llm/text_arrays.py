"""Words and word windows of many texts at once, as numpy arrays.

Works on the UTF-8 bytes of an Arrow string column, so no Python object is made
per word. A word is a maximal run of bytes other than space and U+0009..U+000D
(all ASCII, so bytes and characters agree). Hashes are polynomials modulo 2**64
over random byte values, finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 21
MASK = (1 << 64) - 1
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_U64 = np.uint64


class Polynomial:
    """Rolling 64-bit polynomial hash; ``seed`` picks an independent one."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.bytes = rng.integers(0, 1 << 64, size=256, dtype=np.uint64)
        self.base = (int(rng.integers(1 << 62)) * 4 + 3) & MASK
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hash of ``values[s:e]`` for each pair of bounds."""
        up, down = self.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:len(values)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


FIRST, SECOND = Polynomial(1), Polynomial(2)


class Words:
    """The words of consecutive texts: byte bounds in ``data``, the hash of each
    word, and ``first[i]:first[i + 1]``, the words of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, hashes: tuple[Polynomial, ...] = (FIRST,)):
        self.data, self.offsets = data, offsets
        solid = ~_BLANK[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(len(data), dtype=bool)
        before[:1] = False
        before[1:] = solid[:-1]
        self.starts = np.flatnonzero(solid & (~before | edge[:-1]))
        after = np.empty(len(data), dtype=bool)
        after[-1:] = False
        after[:-1] = solid[1:]
        self.ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = [self._hash(h) for h in hashes]

    def _hash(self, h: Polynomial) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        lo = 0
        while lo < len(out):  # pieces that end with a word, so that long texts need no long arrays
            at = self.starts[lo]
            hi = max(lo + 1, int(np.searchsorted(self.ends, at + PIECE, side="right")))
            piece = self.data[at:self.ends[hi - 1]]
            out[lo:hi] = h.spans(h.bytes[piece], self.starts[lo:hi] - at, self.ends[lo:hi] - at)
            lo = hi
        return out

    def windows(self, size: int, which: int = 0, h: Polynomial = FIRST) -> np.ndarray:
        """Hash of the ``size`` words from each word on; entries whose window
        leaves the text are meaningless (see ``full``)."""
        w = self.hashes[which]
        out = np.zeros(len(w), dtype=np.uint64)
        n = len(w) - size + 1
        if n > 0:
            starts = np.arange(n)
            out[:n] = h.spans(w, starts, starts + size)
        return out

    def full(self, size: int) -> np.ndarray:
        """Whether the window of ``size`` words from each word on stays in its text."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))
        return left >= size


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def texts(batch: pa.RecordBatch, column: str, most_bytes: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about
    ``most_bytes`` of text, a long text being a run of its own. Nulls are empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, ends, data = col.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most_bytes, side="right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of ``size`` entries from each entry on (fewer at the end)."""
    out, have = x.copy(), 1
    while have < size:
        step = min(have, size - have)
        np.minimum(out[:-step], out[step:].copy(), out=out[:-step])
        have += step
    return out
