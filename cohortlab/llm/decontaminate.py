"""Benchmark decontamination: BM25 search of test items with block-max skipping.

Every passage of every document is a query against an inverted index of the
test items. Impacts are BM25 term scores divided by the item's score against
itself, so a passage that holds a whole item scores 1 for it whatever its
length, and one threshold serves all items. Items are stored in blocks of
``BLOCK``; for each term the index keeps its largest impact over all items and
over each block. As in WAND, the sum of a passage's largest impacts bounds its
score: passages, then blocks, whose bound misses the threshold are skipped, and
only items of the blocks left are scored. All items above the threshold are
retrieved and verified: of the item's five-word shingles at least 80% must lie
in the passage, and of its question's and its answer's at least half each. As one
changed word removes five shingles, an item of 5 to ``LENGTHS`` words that fails
so is verified by its words instead, with the same shares: those that a stretch
of about its length has in the same order. The answer is the item's last sentence, the question what stands before it (an item
of one sentence is both).

Items are grouped by length; a group's passages have twice its longest length
and overlap by half, so a copied item lies whole in one of them. A benchmark of
any size is searched in shards of bounded rows and bytes, one pass each.

Words are lower-cased; characters other than letters, digits and those beyond
ASCII separate them. Defined results: null and empty texts match nothing; items
of fewer than five words match as one exact sequence; repeated documents
or items match alike; an empty table gives no hits; other columns play no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_of
from .text_arrays import FIRST, PIECE, Words, texts

BLOCK = 16
THRESHOLD = 0.6
ITEM_OVERLAP = 0.8
PART_OVERLAP = 0.5
SHINGLE = 5
K1, B = 1.2, 0.75
SHARD_ITEMS = 2000
SHARD_BYTES = 4 << 20
LENGTHS = 64
CELLS = 1 << 18  # entries that passages scored together hold
_SEPARATE = np.array([i if chr(i).isalnum() or i >= 128 else 32 for i in range(256)], dtype=np.uint8)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def item_words(text: str) -> np.ndarray:
    lower = pc.utf8_lower(pa.scalar(text)).as_py()  # as the documents are, also where Python would do it differently
    data = _SEPARATE[np.frombuffer(lower.encode(), np.uint8)]
    return Words(data, np.array([0, len(data)])).hashes[0]


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle are one."""
    size = min(size, len(words))
    if not size:
        return np.empty(0, np.uint64)
    starts = np.arange(len(words) - size + 1)
    return np.unique(FIRST.spans(words, starts, starts + size))


@dataclass(frozen=True)
class Part:
    """The shingles of an item or of its question or answer; a part of fewer
    than five words is one shingle of its own length."""
    hashes: np.ndarray
    size: int
    words: np.ndarray

    @staticmethod
    def of(words: np.ndarray) -> Part:
        return Part(shingles(words), min(SHINGLE, len(words)), words)


@dataclass
class Group:
    """The index of items of similar length."""
    rows: np.ndarray        # positions in the shard's list of items
    vocabulary: np.ndarray  # sorted word hashes
    most: np.ndarray        # [terms] largest impact
    block_most: np.ndarray  # [terms, blocks]
    start: np.ndarray       # postings of term t: start[t]:start[t + 1]
    item: np.ndarray
    impact: np.ndarray
    passage: int


def build(items: list[str]) -> tuple[list[Group], list[tuple[Part, ...]]]:
    """(indexes by length, parts of each item: the whole, question and answer)"""
    words = [item_words(t) for t in items]
    parts = []
    for t, w in zip(items, words, strict=True):
        sentences = [s for s in _SENTENCE.split(t) if len(item_words(s))]
        question = item_words("\n".join(sentences[:-1])) if len(sentences) > 1 else w
        answer = item_words(sentences[-1]) if len(sentences) > 1 else w
        parts.append((Part.of(w), Part.of(question), Part.of(answer)))
    held = [np.unique(w, return_counts=True) for w in words]
    usable = [i for i, w in enumerate(words) if len(w)]
    if not usable:
        return [], parts
    frequency: dict[int, int] = {}
    for i in usable:
        for h in held[i][0].tolist():
            frequency[h] = frequency.get(h, 0) + 1
    mean = np.mean([len(words[i]) for i in usable])
    groups: dict[int, list[int]] = {}
    for i in usable:
        groups.setdefault(max(0, math.ceil(math.log2(len(words[i]) / LENGTHS))), []).append(i)
    out = []
    for size, rows in sorted(groups.items()):
        terms, owners, impacts = [], [], []
        for k, i in enumerate(rows):
            h, tf = held[i]
            idf = np.array([math.log(1 + (len(usable) - frequency[x] + 0.5) / (frequency[x] + 0.5)) for x in h.tolist()])
            score = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words[i]) / mean))
            terms.append(h)
            owners.append(np.full(len(h), k))
            impacts.append(score / score.sum())
        term, owner, impact = np.concatenate(terms), np.concatenate(owners), np.concatenate(impacts)
        order = np.lexsort((owner, term))
        term, owner, impact = term[order], owner[order], impact[order]
        vocabulary, start = np.unique(term, return_index=True)
        block_most = np.zeros((len(vocabulary), -(-len(rows) // BLOCK)))
        np.maximum.at(block_most, (np.searchsorted(vocabulary, term), owner // BLOCK), impact)
        out.append(Group(np.array(rows), vocabulary, block_most.max(axis=1), block_most.astype(np.float32),
                         np.append(start, len(term)), owner, impact, 2 * LENGTHS << size))
    return out, parts


def _passage_terms(w: Words, g: Group) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (passage, term) pairs, and each passage's document and first word."""
    at = np.searchsorted(g.vocabulary, w.hashes[0])
    at[at == len(g.vocabulary)] = 0
    known = np.flatnonzero(g.vocabulary[at] == w.hashes[0])
    step = g.passage // 2
    counts = np.diff(w.first)
    n = np.maximum(1, -(-counts // step) - 1)  # passages: steps k and k + 1 for each k
    base = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(counts)), n)
    first = w.first[doc] + (np.arange(base[-1]) - base[doc]) * step
    owner = np.searchsorted(w.first, known, side="right") - 1
    k = (known - w.first[owner]) // step
    last = n[owner] - 1
    pairs = []
    for p in (k - 1, k):
        ok = (p >= 0) & (p <= last)
        pairs.append((base[owner[ok]] + p[ok]) * len(g.vocabulary) + at[known[ok]])
    pair = np.unique(np.concatenate(pairs))
    return pair // len(g.vocabulary), pair % len(g.vocabulary), doc, first


def _candidates(g: Group, passage: np.ndarray, term: np.ndarray, n: int,
                threshold: float) -> Iterator[tuple[int, int, float]]:
    """(passage, item of the group, score) of all pairs that reach the threshold,
    in order, from sorted (passage, term) pairs. Passages whose bound reaches it
    are scored many at a time, as many as fit into about ``CELLS`` entries."""
    bound = np.bincount(passage, weights=g.most[term], minlength=n)
    hopeful = (bound >= threshold - 1e-9)[passage]
    passage, term = passage[hopeful], term[hopeful]
    if not len(passage):
        return
    first = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    count = g.start[term + 1] - g.start[term]
    width = g.block_most.shape[1]
    load = np.maximum(np.add.reduceat(np.maximum(count, width), first), len(g.rows))
    cuts = np.flatnonzero(np.diff(np.cumsum(load) // CELLS, prepend=-1))
    at = np.append(first, len(passage))
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(first)], strict=True):
        own = slice(at[lo], at[hi])
        blocks = np.add.reduceat(g.block_most[term[own]], first[lo:hi] - at[lo], axis=0) >= threshold - 1e-4
        which = np.repeat(np.arange(hi - lo), np.diff(at[lo:hi + 1]))
        some = blocks.any(axis=1)[which]
        which, begin, many = which[some], g.start[term[own][some]], count[own][some]
        if not len(which):
            continue
        posting = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
        which = np.repeat(which, many)
        keep = blocks[which, g.item[posting] // BLOCK]
        posting, which = posting[keep], which[keep]
        scores = np.bincount(which * len(g.rows) + g.item[posting], weights=g.impact[posting])
        for k in np.flatnonzero(scores >= threshold).tolist():
            yield int(passage[first[lo + k // len(g.rows)]]), k % len(g.rows), float(scores[k])


def search(w: Words, groups: list[Group], parts: list, threshold: float = THRESHOLD) -> list[tuple]:
    """(row, item, score, item overlap, question overlap, answer overlap) of verified hits."""
    best: dict[tuple[int, int], tuple] = {}
    for g in groups:
        passage, term, doc, first = _passage_terms(w, g)
        for p, k, score in _candidates(g, passage, term, len(doc), threshold):
            d, i = int(doc[p]), int(g.rows[k])
            end = min(int(first[p]) + g.passage, int(w.first[d + 1]))
            mine = w.hashes[0][first[p]:end]
            held = [_overlap(x, mine) for x in parts[i]]
            if not _verified(held):
                held = _in_order(parts[i], mine)
            if _verified(held):
                hit = (d, i, score, *held)
                best[d, i] = max(best.get((d, i), hit), hit, key=lambda x: x[2:])
    return [best[k] for k in sorted(best)]


def _overlap(part: Part, words: np.ndarray) -> float:
    return float(np.isin(part.hashes, shingles(words, part.size)).mean())


def _verified(held: list[float]) -> bool:
    return held[0] >= ITEM_OVERLAP and min(held[1:]) >= PART_OVERLAP


def in_order(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def _in_order(item: tuple[Part, ...], words: np.ndarray) -> list[float]:
    """Of the item, its question and its answer the share of words that the best
    stretch of ``words``, a quarter longer than the item, has in order; zeros for
    an item that is not verified by words."""
    n = len(item[0].words)
    best = [0.0] * len(item)
    if not SHINGLE <= n <= LENGTHS:
        return best
    known = np.isin(words, item[0].words)
    width = n + n // 4
    for s in np.flatnonzero(known).tolist():  # a stretch begins with a word of the item
        if known[s:s + width].sum() < ITEM_OVERLAP * n:
            continue
        stretch = words[s:s + width].tolist()
        share = [in_order(p.words.tolist(), stretch) / len(p.words) for p in item]
        best = max(best, share, key=lambda x: (_verified(x), x))
    return best


def _searched(batch: pa.RecordBatch, groups, parts) -> Iterator[tuple[int, int, list[tuple]]]:
    low = pa.RecordBatch.from_arrays([pc.utf8_lower(batch.column("__text"))], ["text"])
    for lo, hi, data, offsets in texts(low, "text", PIECE // 2):
        yield lo, hi, search(Words(_SEPARATE[data], offsets), groups, parts)


def _hits(ids: list, groups, parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, found in _searched(b, groups, parts):
                rows = pa.array([lo + f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), pa.array([ids[f[1]] for f in found], pa.int64()),
                     *[pa.array([f[k] for f in found], pa.float64()) for k in (2, 3, 4, 5)]],
                    ["doc_id", "item_id", "score", "item_overlap", "question_overlap", "answer_overlap"])
    return run


def _clean(keep: list[str], groups, parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fine = np.ones(b.num_rows, dtype=bool)
            for lo, _, found in _searched(b, groups, parts):
                fine[[lo + f[0] for f in found]] = False
            yield b.select(keep).filter(pa.array(fine))
    return run


def shards(items: DataFrame, most_items: int = SHARD_ITEMS, most_bytes: int = SHARD_BYTES) -> Iterator[tuple[list, list]]:
    """(ids, texts) of the items, at most about so many rows and bytes at a time."""
    size = items.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("b")).first()
    n = max(1, -(-size["n"] // most_items), -(-(size["b"] or 0) // most_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) \
            .select("item_id", text_of("text").alias("text")).orderBy("item_id", "text").collect()
        if part:
            yield [r["item_id"] for r in part], [r["text"] for r in part]


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, item_overlap, question_overlap, answer_overlap):
    the best passage of every document for every item that it holds."""
    schema = ("doc_id long, item_id long, score double, item_overlap double, "
              "question_overlap double, answer_overlap double")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("__text"))
    out = None
    for ids, item_texts in shards(items):
        found = map_arrow(d, _hits(ids, *build(item_texts)), schema)
        out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in out.columns[2:]])


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    for _, item_texts in shards(items):
        d = docs.withColumn("__text", text_of("text"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        docs = map_arrow(d, _clean(docs.columns, *build(item_texts)), schema)
    return docs
