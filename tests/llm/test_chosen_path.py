"""Chosen-path join against plain Python: odd rows, copies, groups larger than a
node, and the recall that the trees promise."""

import random

import brute
import numpy as np
import pytest
from cohortlab.llm import chosen_path
from cohortlab.llm import chosen_path as C
from conftest import SF01
from pyspark.sql import functions as F

import __spark_entry__ as E


def group(rng, base, k, edits, vocabulary):
    """Copies of a word list with single words changed."""
    out = []
    for _ in range(k):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \t\n", "one", "One", "one two", "ONE two", "one two three", "same " * 400, "same " * 9,
             " ".join(rng.choices(vocabulary, k=60_000))]
    for _ in range(60):
        texts.append(" ".join(rng.choices(vocabulary, k=rng.choice((4, 30, 120)))))
    for k, edits in ((40, 12), (15, 6), (8, 25), (60, 3)):
        texts += group(rng, rng.choices(vocabulary, k=100), k, edits, vocabulary)
    texts += rng.choices(texts, k=40) + [texts[30]] * 50
    rng.shuffle(texts)
    return list(enumerate(texts))


def check(found, docs):
    want = brute.ngram_components([d for d in docs if d[0] is not None], 2, 80)
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and not r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_components_equal_plain_python(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check(C.link_components(frame), docs)
    more = docs + [(None, docs[3][1]), (None, None), docs[7], docs[7], (-3, docs[8][1])]
    odd = spark.createDataFrame(more, "doc_id long, text string")
    odd = odd.withColumns({c: F.lit("x") for c in ("n", "k1", "rep", "node", "comp", "marks", "tokens", "p", "x", "salt", "size")})
    want = brute.ngram_components([d for d in more if d[0] is not None], 2, 80)
    got = C.link_components(odd.repartition(3)).collect()
    assert len(got) == len(more)
    assert all(r.component_id == (want[r.doc_id][1] if r.doc_id is not None else None) for r in got)
    assert C.link_components(frame.limit(0)).count() == 0


def test_large_nodes_are_branched(spark, monkeypatch):
    """With nodes of ten members at most, and blocks of eight, groups are taken apart over several levels and tasks."""
    monkeypatch.setattr(C, "SMALL", 10)
    monkeypatch.setattr(C, "NEAR", 20)
    monkeypatch.setattr(C, "DEALT", 8)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base = rng.choices(vocabulary, k=80)
    texts = []
    for _ in range(4):  # sides of one text that share part of it: many pairs just below or above the threshold
        side = list(base)
        for i in rng.sample(range(80), 7):
            side[i] = rng.choice(vocabulary)
        texts += group(rng, side, 12, 4, vocabulary)
    docs = list(enumerate(texts))
    check(C.link_components(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_pairs_at_the_threshold_meet_as_promised():
    """Pairs of sets with a similarity of 0.8 share a node of some tree, and have enough common marks."""
    rng = np.random.default_rng(3)
    n, depth = 400, 2
    trees = C.trees_for(80, depth, 0.9995)
    sets = []
    for _ in range(n):
        h = rng.integers(0, 1 << 63, 180, dtype=np.uint64)
        sets += [h[:160], np.concatenate([h[:142], h[162:]])]
    sizes = [len(s) for s in sets]
    tokens = C.minwise(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)]))
    jaccard = 142 / 178
    assert abs((tokens[::2] == tokens[1::2]).mean() - jaccard) < 0.01
    hashed, met = C._hashed(tokens), np.zeros(n, dtype=bool)
    for _ in range(trees):
        who, paths = np.arange(2 * n), np.full(2 * n, rng.integers(1 << 63, dtype=np.uint64))
        for _ in range(depth):
            paths, who = C.children(paths, who, hashed)
        nodes = {}
        for p, w in zip(paths.tolist(), who.tolist(), strict=True):
            nodes.setdefault(p, set()).add(w)
        for found in nodes.values():
            met |= np.array([2 * i in found and 2 * i + 1 in found for i in range(n)])
    assert met.mean() >= 0.995
    marks = tokens.astype(np.uint8)
    assert ((marks[::2] == marks[1::2]).sum(axis=1) >= C.least_common(80)).all()


def test_blocks_of_a_group(spark, monkeypatch):
    """Groups with several components and more members than a task takes."""
    monkeypatch.setattr(C, "DEALT", 7)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    base = rng.choices(vocabulary, k=60)
    texts = group(rng, base, 40, 9, vocabulary)  # some link with the first text, others only with each other
    docs = list(enumerate(texts))
    check(C.link_components(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_groups_by_smallest_place():
    good = np.eye(7, dtype=bool)
    for a, b in ((6, 4), (4, 1), (2, 5)):
        good[a, b] = good[b, a] = True
    assert C.groups_of(good).tolist() == [0, 1, 2, 3, 1, 2, 1]
    chain = np.eye(50, dtype=bool) | np.eye(50, k=1, dtype=bool) | np.eye(50, k=-1, dtype=bool)
    assert not C.groups_of(chain).any() and C.groups_of(np.empty((0, 0), bool)).tolist() == []


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_parameters(percent):
    assert 0 < C.meeting(percent, 3) < C.meeting(percent, 1) < 1
    assert C.trees_for(percent, 2, 0.999) >= C.trees_for(percent, 2, 0.9) >= 1
    assert C.first_depth(1) == 2 <= C.first_depth(10 ** 6) <= C.first_depth(10 ** 11) < 7


def test_chosen_path_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    check(E.queries()["op11_chosen_path"](spark, SF01), docs)
    assert chosen_path.RECALL > 0.999
