"""Chosen-path set similarity join for near duplicates.

A document's set holds the 64-bit hashes of its distinct word n-grams, and
``TOKENS`` minwise tokens stand for it: two sets share a token with a
probability equal to their Jaccard similarity. Documents link when that
similarity reaches ``percent``.

Forest. In a node of a tree every (position, value) of a token is chosen with
probability ``FANOUT`` / ``TOKENS``, by a hash of the node's path and the token;
a document goes to the child of each chosen token that it has, so it enters
FANOUT children on average and a pair at the threshold shares
percent * FANOUT of them, more than one: its expected number of common nodes
never falls. Unrelated documents part at once. The first levels (their number
grows with the logarithm of the table) are taken in one pass, as paths depend on
nothing but the document; later levels branch only the nodes that are still
large. Trees are independent and repeated until a pair at the threshold meets
with probability ``RECALL``.

Comparison. Only nodes of two or more members matter. Nodes of more
than ``SMALL`` members are cut by set size first. In a node of at most that many all are compared by their tokens: a linked pair agrees in fewer
than the least number with probability ``MISS`` at most. What that connects is a
group, known by its smallest id, which is nearly always the same in all nodes
that a group of copies meets in; members of larger nodes are compared with one
pivot. Then every member is confirmed against its group's smallest id (the
pivot) on the full sets of the whole texts, and what is linked is joined. Groups
that this leaves in several components are compared exhaustively, all members
against those outside the largest component, dealt in blocks to several tasks. A larger
node that is left so has its tokens compared in the same way if no more than
``NEAR`` members lie outside its largest component, and is branched otherwise. So a group of k near copies
costs about k comparisons as long as few of them miss its smallest id. Texts of
documents in groups are set aside once and joined to the comparisons from there.

Documents with equal sets are one class, whose smallest id stands for it; the
join that finds it spreads large classes by a salt.

Defined results: null and blank texts have an empty set and link with nothing;
a text of fewer than n words is one n-gram; rows of null id get a null
component and are not kept; rows of one id and different texts count as one
document with all their links; an empty table gives an empty result; other
columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_table, ids_and_texts, map_arrow, shuffle_width
from .components import components
from .ngram_join import identities, overlap_matrix, shingle_sets
from .text_arrays import mix, texts

SHINGLE = 2
PERCENT = 80
TOKENS = 64
FANOUT = 1.5
RECALL = 0.9995
MISS = 1e-5
SMALL = 512
NEAR = 16 * SMALL  # members outside its largest component up to which a larger node is compared, in blocks of SMALL
UNRELATED = 0.01  # similarity of documents that have nothing to do with each other, to choose the first depth
DEALT = 512       # members that one task compares with a pivot or a block
SALTS = 16
WORD_BITS = 20    # words of the bitmap of wanted ids, as a power of two
SEED = 11
_U64 = np.uint64


# ------------------------------------------------------------------ parameters

def meeting(percent: int, depth: int) -> float:
    """Probability that a pair at the threshold shares a node of a tree's level ``depth``."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - (1 - FANOUT / TOKENS * alive) ** (percent / 100 * TOKENS)
    return alive


def trees_for(percent: int, depth: int, recall: float) -> int:
    """Trees until a pair at the threshold meets with probability ``recall``,
    two levels below ``depth``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - meeting(percent, depth + 2)))


def first_depth(documents: int) -> int:
    """Levels after which few unrelated documents share a node."""
    return max(2, math.ceil(math.log(max(documents / 64, 1)) / math.log(1 / UNRELATED)))


def least_common(percent: int) -> int:
    """The most agreeing tokens that a linked pair falls short of with probability ``MISS`` at most."""
    p, tail = percent / 100, 0.0
    for k in range(TOKENS + 1):
        tail += math.comb(TOKENS, k) * p ** k * (1 - p) ** (TOKENS - k)
        if tail > MISS:
            return k
    return TOKENS


# ------------------------------------------------------------------ tokens

def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * _U64(2) + _U64(1), rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64)


def minwise(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(sets, TOKENS) smallest values of ``TOKENS`` hashes of each set's n-grams; zeros for an empty set."""
    out = np.zeros((len(at) - 1, TOKENS), dtype=np.uint32)
    rows = np.flatnonzero(np.diff(at))
    if len(rows):
        a, b = _multipliers()
        for k in range(TOKENS):
            out[rows, k] = np.minimum.reduceat(((h * a[k] + b[k]) >> _U64(32)).astype(np.uint32), at[:-1][rows])
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(rows)
    width = raw.shape[1] * raw.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), TOKENS)


def _signatures(size: int):
    """Texts to the size, identity, tokens and marks (a byte of each token) of their sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in texts(b, "text"):
                h, at = shingle_sets(data, offsets, size)
                k1, k2 = identities(h, at)
                tokens = minwise(h, at)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], pa.array(np.diff(at).astype(np.int64)), pa.array(k1), pa.array(k2),
                     _binary(tokens), _binary(tokens.astype(np.uint8))], ["doc_id", "n", "k1", "k2", "tokens", "marks"])
    return run


# ------------------------------------------------------------------ forest

def children(paths: np.ndarray, who: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(path, row) of the children that rows ``who`` of ``tokens`` (hashed) enter from the nodes ``paths``."""
    bound = _U64(int(FANOUT / TOKENS * 2 ** 64))
    found = [], []
    for k in range(TOKENS):
        key = mix(paths ^ tokens[who, k])
        chosen = key < bound
        found[0].append(mix(key[chosen] + _U64(SEED)))
        found[1].append(who[chosen])
    return np.concatenate(found[0]), np.concatenate(found[1])


def _hashed(values: np.ndarray) -> np.ndarray:
    return mix(values.astype(np.uint64) + (np.arange(TOKENS, dtype=np.uint64) << _U64(33)))


def _first_levels(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            tokens = _hashed(_matrix(b.column("tokens"), "u4"))
            for tree in range(trees):
                who = np.arange(len(tokens))
                paths = np.full(len(tokens), mix(np.array([tree + 1], dtype=np.uint64))[0])
                for _ in range(depth):
                    paths, who = children(paths, who, tokens)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), b.column("doc_id").take(pa.array(who))],
                                                 ["node", "doc_id"])
    return run


def _next_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            tokens = _hashed(_matrix(b.column("tokens"), "u4"))
            paths, who = children(b.column("node").to_numpy().view(np.uint64), np.arange(len(tokens)), tokens)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), b.column("doc_id").take(pa.array(who))],
                                             ["node", "doc_id"])


# ------------------------------------------------------------------ candidates

def _alike(least: int):
    """Rows with a member's and its pivot's marks to the candidates (p, x) among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                same = (_matrix(b.column("marks"), "u1") == _matrix(b.column("pivot_marks"), "u1")).sum(axis=1)
                yield b.filter(pa.array(same >= least)).select(["p", "x"])
    return run


def common_marks(marks: np.ndarray) -> np.ndarray:
    """For all pairs of rows, in how many marks they agree."""
    out = np.zeros((len(marks), len(marks)), dtype=np.uint8)
    for k in range(TOKENS):
        out += marks[:, k][:, None] == marks[:, k][None, :]
    return out


def groups_of(good: np.ndarray) -> np.ndarray:
    """The smallest place that each row of a symmetric matrix reaches."""
    root = np.arange(len(good), dtype=np.int32)
    while True:
        # the smallest root among a row and its neighbours, then the root of that
        near = np.where(good, root[None, :], np.int32(len(good))).min(axis=1, initial=len(good))
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _grouped(least: int):
    """Rows sorted by (node, block, doc_id) to (p, x): the members of each group in
    a block but its smallest id. Groups hold together by pairs of different
    components with a ``minor`` member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.RecordBatch | None = None

        def found(b: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
            ids, comp, minor = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "comp", "minor"))
            marks = _matrix(b.column("marks"), "u1")
            out = [np.empty((0, 2), np.int64)]
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                part = slice(lo, hi)
                good = common_marks(marks[part]) >= least
                good &= (comp[part][:, None] != comp[part]) & (minor[part][:, None] | minor[part])
                root = groups_of(good)
                x = np.flatnonzero(root != np.arange(hi - lo))
                out.append(np.stack([ids[lo + root[x]], ids[lo + x]], axis=1))
            rows = np.unique(np.concatenate(out), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["p", "x"])

        for b in batches:
            if left is not None:
                b = pa.Table.from_batches([left, b]).combine_chunks().to_batches()[0]
            node, block = b.column("node").to_numpy(), b.column("block").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero((node[1:] != node[:-1]) | (block[1:] != block[:-1])) + 1])
            left = b.slice(int(bounds[-1])) if len(node) else None
            if len(bounds) > 1:
                yield found(b, bounds)
        if left is not None:
            yield found(left, np.array([0, left.num_rows]))
    return run


def grouped(rows: DataFrame, marks: DataFrame, least: int) -> DataFrame:
    """(p, x): groups by tokens of the rows (node, block, doc_id, comp, minor); a
    block has about twice ``SMALL`` rows at most."""
    dealt = rows.join(marks, "doc_id").repartition(shuffle_width(rows.sparkSession), "node", "block") \
        .sortWithinPartitions("node", "block", "doc_id")
    return map_arrow(dealt, _grouped(least), "p long, x long").distinct()


def size_bands(large: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Large nodes cut by set size: a member goes to its own band and the next.
    Sets that link have equal or neighbouring bands, so they share the upper one's
    node; one that only members of the band below enter (not ``own``) is not needed."""
    width = math.log(101 / percent)  # a little over the largest ratio of two linked sizes
    band = F.floor(F.log(F.col("n").cast("double")) / width)
    return large.join(sizes, "doc_id").select(
        "doc_id", F.inline(F.array(F.struct(F.xxhash64("node", band).alias("node"), F.lit(True).alias("own")),
                                   F.struct(F.xxhash64("node", band + 1).alias("node"), F.lit(False).alias("own")))))


def minor_blocks(labelled: DataFrame, nodes: DataFrame) -> DataFrame:
    """The members of large nodes in blocks of about ``SMALL``, once with each
    block of the members outside the node's largest component."""
    rows = labelled.join(nodes, "node").withColumn("minor", F.col("comp") != F.col("main"))
    place = F.xxhash64("doc_id")
    i, j = (F.pmod(place, F.col(k)).cast("int") for k in ("minor_blocks", "blocks"))
    all_i, all_j = (F.sequence(F.lit(0), F.col(k) - 1) for k in ("minor_blocks", "blocks"))
    columns = F.transform(all_i, lambda k: k * F.col("blocks") + j)
    lines = F.transform(all_j, lambda k: i * F.col("blocks") + k)
    tasks = F.when(F.col("minor"), F.array_distinct(F.concat(columns, lines))).otherwise(columns)
    return rows.select("node", F.explode(tasks).alias("block"), "doc_id", "comp", "minor")


# ------------------------------------------------------------------ confirmation

def _confirm(size: int, percent: int):
    """Rows sorted by (p, deal, x first for the pivot), each with a text, to links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, main = None, []
        for b in batches:
            p, deal, x, pivot = (b.column(k).to_pylist() for k in ("p", "deal", "x", "is_pivot"))
            a_out, b_out = [], []
            for lo, hi, data, offsets in texts(b, "text"):
                h, at = shingle_sets(data, offsets, size)
                for r in range(lo, hi):
                    mine = h[at[r - lo]:at[r - lo + 1]]
                    if (p[r], deal[r]) != key:
                        key, main = (p[r], deal[r]), []
                    if pivot[r]:
                        main.append(mine.copy())  # more than one if rows share the id
                        continue
                    for other in main:
                        o = len(np.intersect1d(mine, other, assume_unique=True))
                        if 100 * o >= percent * (len(mine) + len(other) - o):
                            a_out.append(p[r])
                            b_out.append(x[r])
                            break
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])
    return run


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): the pairs (p, x) whose full sets link. The members of a pivot are
    dealt to tasks of about ``DEALT``, each of which gets the pivot."""
    deals = pairs.groupBy("p").agg(F.ceil(F.count("*") / DEALT).cast("int").alias("deals"))
    members = pairs.join(deals, "p").select(
        "p", "x", F.pmod(F.xxhash64("x"), F.col("deals")).cast("int").alias("deal"), F.lit(False).alias("is_pivot"))
    pivots = deals.select("p", F.col("p").alias("x"), F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"),
                          F.lit(True).alias("is_pivot"))
    rows = members.union(pivots).join(docs.withColumnRenamed("doc_id", "x"), "x")
    dealt = rows.repartition(shuffle_width(docs.sparkSession), "p", "deal").sortWithinPartitions(
        "p", "deal", F.col("is_pivot").desc(), "x")
    return map_arrow(dealt, _confirm(size, percent), "a long, b long")


def _blocks(size: int, percent: int):
    """Rows sorted by (p, i, j, side), each with a text, to enough links between
    the rows of side 0 and those of side 1 that belong to other components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def links() -> pa.RecordBatch:
            sides = [[r for r in rows if r[0] == s] for s in (0, 1)]
            edges = []
            if all(sides):
                exact = overlap_matrix([r[3] for r in sides[0]], [r[3] for r in sides[1]])
                n = [np.array([len(r[3]) for r in s]) for s in sides]
                comp = [np.array([r[2] for r in s]) for s in sides]
                hit = (100 * exact >= percent * (np.add.outer(n[0], n[1]) - exact)) & (comp[0][:, None] != comp[1][None, :])
                joined: dict[int, int] = {}
                for i, j in np.argwhere(hit).tolist():
                    a, b = (_root(joined, s[k][2]) for s, k in zip(sides, (i, j), strict=True))
                    if a != b:
                        joined[a] = b
                        edges.append((sides[0][i][1], sides[1][j][1]))
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            columns = list(zip(*[b.column(c).to_pylist() for c in ("p", "i", "j", "side", "x", "comp")], strict=True))
            for lo, hi, data, offsets in texts(b, "text"):
                h, at = shingle_sets(data, offsets, size)
                for r in range(lo, hi):
                    p, i, j, side, x, comp = columns[r]
                    if (p, i, j) != key:
                        if key is not None:
                            yield links()
                        key, rows = (p, i, j), []
                    rows.append((side, x, comp, h[at[r - lo]:at[r - lo + 1]].copy()))
        if key is not None:
            yield links()
    return run


def _root(joined: dict[int, int], k: int) -> int:
    while k in joined:
        k = joined[k]
    return k


def compared(rows: DataFrame, held: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links between members (p, x, comp) of one group and of different
    components. Members outside a group's largest component (side 0, in blocks i)
    meet all members (side 1, in blocks j); a member travels once per block, not
    once per pair."""
    largest = rows.groupBy("p", "comp").agg(F.count("*").alias("c")).groupBy("p").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("n"),
        F.count("*").alias("comps"), F.max("c").alias("most")).where("comps > 1")
    many = (F.ceil((F.col("n") - F.col("most")) / DEALT).cast("int"), F.ceil(F.col("n") / DEALT).cast("int"))
    rows = rows.join(largest.select("p", "main", many[0].alias("bi"), many[1].alias("bj")), "p")
    place = F.xxhash64("x")
    all_i, all_j = (F.sequence(F.lit(0), F.col(k) - 1) for k in ("bi", "bj"))
    own_i, own_j = (F.pmod(place, F.col(k)).cast("int") for k in ("bi", "bj"))
    columns = F.transform(all_i, lambda k: F.struct(k.alias("i"), own_j.alias("j"), F.lit(1).alias("side")))
    lines = F.transform(all_j, lambda k: F.struct(own_i.alias("i"), k.alias("j"), F.lit(0).alias("side")))
    tasks = F.when(F.col("comp") == F.col("main"), columns).otherwise(F.concat(columns, lines))
    dealt = rows.select("p", "x", "comp", F.inline(tasks)).join(held.withColumnRenamed("doc_id", "x"), "x")
    dealt = dealt.repartition(shuffle_width(held.sparkSession), "p", "i", "j").sortWithinPartitions("p", "i", "j", "side")
    return map_arrow(dealt, _blocks(size, percent), "a long, b long")


# ------------------------------------------------------------------ the join

def near_ids(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``wanted`` (distinct). Most others go before any
    text is shuffled, by a bitmap of the wanted ids' hashes; its words are at most
    2**``WORD_BITS`` rows, whatever the size of the tables, so they are broadcast."""
    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(64 << WORD_BITS))

    bits = wanted.select(F.shiftrightunsigned(place("doc_id"), 6).alias("word"), F.pmod(place("doc_id"), F.lit(64)).cast("int").alias("bit"))
    words = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))
    maybe = docs.withColumns({"word": F.shiftrightunsigned(place("doc_id"), 6), "bit": F.pmod(place("doc_id"), F.lit(64)).cast("int")}) \
        .join(F.broadcast(words), "word").where("shiftright(set, bit) % 2 <> 0").select(*docs.columns)
    return maybe.join(wanted, "doc_id")  # not a semi-join, which would be moved below the bitmap


def set_classes(base: DataFrame) -> DataFrame:
    """``base`` with ``rep``, the smallest id of an equal set (null if the set is
    empty or the id null). Only classes of several rows take part in the join,
    each spread over ``SALTS`` tasks."""
    full = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    many = (base.where(full).groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("low"), F.count("*").alias("c")).where("c > 1")
            .select("k1", "k2", "n", "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    met = salted.join(many, ["k1", "k2", "n", "salt"], "left")
    return met.select("doc_id", "n", F.when(full, F.coalesce("low", "doc_id")).alias("rep"), "tokens", "marks")


class _Found:
    """The components that the links confirmed so far make."""

    def __init__(self, spark: SparkSession):
        self.labels = spark.createDataFrame([], "doc_id long, comp long")

    def add(self, links: DataFrame) -> None:
        """Join what ``links`` connects: they are looked up as links between the
        components known so far, so a later round is as small as what it adds."""
        new = checkpoint_table(links, "path_links")
        if new.isEmpty():
            return
        ends = self.label(self.label(new, "a").withColumnRenamed("comp", "ca"), "b").select(
            F.col("ca").alias("a"), F.col("comp").alias("b")).where("a <> b")
        if ends.isEmpty():
            return
        joined = components(ends).select(F.col("id").alias("comp"), F.col("component").alias("lower"))
        known = self.labels.union(ends.select("a", "a")).union(ends.select("b", "b")).distinct()
        self.labels = checkpoint_table(known.join(joined, "comp", "left").select(
            "doc_id", F.coalesce("lower", "comp").alias("comp")).groupBy("doc_id").agg(F.min("comp").alias("comp")), "path_labels")

    def label(self, rows: DataFrame, by: str) -> DataFrame:
        return rows.join(self.labels.withColumnRenamed("doc_id", by), by, "left").withColumn("comp", F.coalesce("comp", by))


def _open_nodes(labelled: DataFrame) -> DataFrame:
    """Nodes with members of several components: the largest one, the members
    outside it, and the blocks of all members."""
    return labelled.groupBy("node", "comp").agg(F.count("*").alias("c")).groupBy("node").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), (F.sum("c") - F.max("c")).alias("others"),
        F.ceil(F.sum("c") / SMALL).cast("int").alias("blocks")).where("others > 0") \
        .withColumn("minor_blocks", F.ceil(F.col("others") / SMALL).cast("int"))


def with_pivots(groups: DataFrame) -> DataFrame:
    return groups.union(groups.select("p", F.col("p").alias("x")).distinct())


def texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of all documents in ``pairs``, set aside for several joins."""
    wanted = pairs.select(F.col("p").alias("doc_id")).union(pairs.select("x")).distinct()
    return checkpoint_table(near_ids(docs, wanted), "path_texts")


def link_components(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT, recall: float = RECALL,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``df``; the
    smallest id of a component is kept."""
    docs = ids_and_texts(df, id_col, text)
    base = checkpoint_table(map_arrow(
        docs, _signatures(size), "doc_id long, n long, k1 long, k2 long, tokens binary, marks binary"), "path_sets")
    own = F.col("doc_id") == F.col("rep")
    classes = checkpoint_table(set_classes(base).withColumns({k: F.when(own, F.col(k)) for k in ("tokens", "marks")}),
                               "path_classes")
    sole = classes.where("tokens is not null").select("doc_id", "n", "tokens", "marks")
    marks = sole.select("doc_id", "marks")
    depth, least = first_depth(sole.count()), least_common(percent)
    found = _Found(df.sparkSession)
    entries = map_arrow(sole.select("doc_id", "tokens"), _first_levels(trees_for(percent, depth, recall), depth),
                        "node long, doc_id long")
    while True:
        entries = checkpoint_table(entries, "path_nodes")
        met = entries.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        members = entries.join(met, "node")
        bands = checkpoint_table(size_bands(members.where(F.col("size") > SMALL), sole.select("doc_id", "n"), percent),
                                 "path_bands")
        cut = bands.join(bands.groupBy("node").agg(F.count("*").alias("size"), F.bool_or("own").alias("any_own"))
                         .where("size > 1 and any_own"), "node")
        large = checkpoint_table(cut.where(F.col("size") > SMALL).select("node", "doc_id"), "path_large")
        alone = members.select("node", "doc_id", "size").union(cut.select("node", "doc_id", "size")).where(F.col("size") <= SMALL).select(
            "node", F.lit(0).alias("block"), "doc_id", F.col("doc_id").alias("comp"), F.lit(True).alias("minor"))
        stars = large.join(large.groupBy("node").agg(F.min("doc_id").alias("p")), "node") \
            .select("p", F.col("doc_id").alias("x")).where("p <> x").distinct() \
            .join(marks.withColumnRenamed("doc_id", "x"), "x") \
            .join(marks.select(F.col("doc_id").alias("p"), F.col("marks").alias("pivot_marks")), "p")
        pairs = checkpoint_table(grouped(alone, marks, least).union(map_arrow(stars, _alike(least), "p long, x long")).distinct(),
                                 "path_pairs")
        held = texts_of(docs, pairs)
        found.add(confirmed(pairs, held, size, percent))
        if large.isEmpty():
            found.add(compared(found.label(with_pivots(pairs), "x"), held, size, percent))
            break
        labelled = found.label(large, "doc_id")
        open_ = checkpoint_table(_open_nodes(labelled), "path_open")
        more = grouped(minor_blocks(labelled, open_.where(F.col("others") <= NEAR)), marks, least)
        groups = checkpoint_table(pairs.union(more).distinct(), "path_groups")
        found.add(compared(found.label(with_pivots(groups), "x"), texts_of(docs, groups), size, percent))
        far = open_.where(F.col("others") > NEAR).select("node")
        if far.isEmpty():
            break
        entries = map_arrow(large.join(far, "node").join(sole.select("doc_id", "tokens"), "doc_id"), _next_level,
                            "node long, doc_id long")
    linked = found.labels.withColumnRenamed("doc_id", "rep")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "rep", "doc_id"))
    return classes.select("doc_id", "n", "rep").join(linked, "rep", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
