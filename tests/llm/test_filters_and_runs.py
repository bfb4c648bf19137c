"""Filter audit and periodic runs against plain Python, on small tables with
nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import random

import brute
import numpy as np
import pytest
from cohortlab.llm import filter_audit, period_runs
from cohortlab.llm.text_arrays import mix
from conftest import SF01
from pyspark.sql import functions as F

import __spark_entry__ as E

CLASHING = ("h", "part", "mask", "good", "toxic", "salt", "c", "low", "n", "owner", "kept", "runs", "collapsed", "best",
            "lines", "n_words", "start", "period")


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def audit_docs(seed=5):
    rng = random.Random(seed)
    texts = [None, "", " \t", "A B C", "one #", "x" * 300_000, "ABC def " * 200]
    for _ in range(60):
        w = [f"w{rng.randrange(rng.choice((30, 4000)))}" for _ in range(rng.choice((40, 99, 100, 150)))]
        if rng.random() < 0.3:
            w[rng.randrange(len(w))] = rng.choice(("a#b", "$5", "50%", "R&D", "*", "|"))
        if rng.random() < 0.3:
            w = [x.upper() if rng.random() < 0.3 else x for x in w]
        texts.append(" ".join(w))
    texts += rng.choices(texts, k=40) + [texts[9]] * 60
    docs = [(i, t, rng.choice(("en", "fr", "", None))) for i, t in enumerate(texts)]
    rng.shuffle(docs)
    return docs + [(None, texts[9], "en"), (None, None, None), docs[0], docs[0]]


def test_audit_equals_plain_filtering(spark):
    docs = audit_docs()
    rng = random.Random(1)
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, len(docs), 2)]
    labels += [(4, 1, 1), (4, 0, 0), (None, 1, 1), (10 ** 9, 1, 1)]
    marks = {}
    for i, q, t in labels:
        if i is not None:
            old = marks.get(i, (0, 0))
            marks[i] = (max(old[0], int(q == 1)), max(old[1], int(t == 1)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    label_frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute.filter_audit(docs, marks)
    for df in (frame, clashing(frame).repartition(5)):
        assert sorted(map(tuple, filter_audit.audit(df, label_frame).collect())) == want
    assert filter_audit.audit(frame.limit(0), label_frame).count() == 0


def test_audit_of_other_filters(spark):
    """Two filters of one's own and copies: six orders of three steps, also for a part that loses nothing."""
    frame = spark.createDataFrame([(1, "aa", "p"), (2, "aa", "p"), (3, "b!", "p"), (4, "b!", "p"), (5, "ok ok", "q")],
                                  "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(frame, labels, {"S": F.length("text") < 3, "X": F.col("text").contains("!")}, copies="D").collect()
    assert len(rows) == 2 * 6 * 3
    by = {(r.part, r.filter_order, r.step): r for r in rows}
    assert [by["p", "XDS", k].removed for k in (1, 2, 3)] == [2, 1, 1]
    assert by["p", "XDS", 1].good_lost == 1 and by["p", "SXD", 1].kept == 0 and by["p", "SXD", 2].redundant == 2
    assert by["p", "SXD", 1].unique_fails == 1 and by["p", "DXS", 2].unique_fails == 0
    assert all(r.kept == 1 and r.removed == r.shapley == 0 for r in rows if r.part == "q")


def test_gray_walk_states():
    rng = random.Random(2)
    cells = [(m, (rng.randrange(9), rng.randrange(9), rng.randrange(9))) for m in range(32) if rng.random() < 0.7]
    states = filter_audit.gray_walk(cells, 5)
    for subset in range(32):
        left = [c for m, c in cells if not m & subset]
        assert states[subset] == tuple(sum(c[x] for c in left) for x in range(3))


def planted(rng, n, letters):
    w = [f"w{rng.randrange(letters)}" for _ in range(n)]
    for _ in range(rng.choice((0, 1, 3))):
        if n > 10:
            a, p = rng.randrange(n), rng.randrange(1, max(2, n // 4))
            for i in range(a, min(n, a + rng.randrange(3 * p, 7 * p))):
                w[i] = w[a + (i - a) % p]
    return w


def test_runs_of_symbols_equal_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        w = planted(rng, rng.choice((0, 1, 5, 30, 100, 300)), rng.choice((1, 2, 3, 20)))
        edge = [10 ** 6, *[int(x[1:]) for x in w], 10 ** 6 + 1]
        got = period_runs.runs_of(mix(np.array(edge, dtype=np.uint64) + np.uint64(77)), len(w))
        assert sorted((s - 1, e - s, q) for s, e, q in got.tolist()) == sorted(brute.runs(w))


def test_extensions_equal_comparison():
    rng = random.Random(4)
    w = [10 ** 6, *[int(x[1:]) for x in planted(rng, 400, 2)], 10 ** 6 + 1]
    levels = period_runs.grammar(mix(np.array(w, dtype=np.uint64)))
    pairs = [(rng.randrange(1, 400), rng.randrange(1, 400)) for _ in range(500)]
    i, j = (np.array([p[k] for p in pairs if p[0] != p[1]]) for k in (0, 1))
    for ahead, step in ((True, 1), (False, -1)):
        for a, b, n in zip(i, j, period_runs.extension(levels, i, j, ahead), strict=True):
            k = 0
            while w[a + k * step] == w[b + k * step]:
                k += 1
            assert n == k


def run_docs(seed=6):
    rng = random.Random(seed)
    texts = [None, "", " \n ", "one", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "x\n a\tb " * 9, "é ü " * 12 + "é",
             "same " * 5000, ("p q r s t " * 400) + "z " * 30]
    for _ in range(250):
        texts.append(rng.choice((" ", "\n", " \t")).join(planted(rng, rng.choice((1, 8, 60, 300)), rng.choice((1, 2, 50)))))
    return [(i, t) for i, t in enumerate(texts)] + [(None, "a " * 9), (7, texts[7]), (7, texts[7]), (-5, "b " * 40)]


def test_run_report_equals_plain_python(spark):
    docs = run_docs()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted((brute.run_report(*d) for d in docs), key=repr)
    for df in (frame, clashing(frame).repartition(3)):
        text = period_runs.with_period(F.coalesce("text", F.lit("")), F.col("doc_id"))
        got = period_runs.report(period_runs.periodic_runs(df.withColumn("text", text)))
        assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                               "collapsed_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert period_runs.periodic_runs(frame.limit(0)).count() == 0


def test_runs_of_long_texts(spark):
    """A million words of one period, and a long text whose grid agrees but whose stretches do not."""
    rows = [(1, "u v w x y " * 200_000), (2, " ".join(f"a b{i}" for i in range(100_000)))]
    got = period_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got[0].runs] == [(0, 1_000_000, 5)] and got[0].collapsed == "u v w x y"
    assert got[1].runs == [] and got[1].collapsed == rows[1][1] and got[1].n_words == 200_000


def test_too_small_exponents_are_refused(spark):
    with pytest.raises(ValueError, match="exponent"):
        period_runs.runs_of(np.arange(9, dtype=np.uint64), 9, exponent=3)


def test_periodic_runs_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    got = E.queries()["op13_periodic_runs"](spark, SF01).collect()
    assert sorted(map(tuple, got)) == sorted(brute.run_report(*d) for d in docs)
