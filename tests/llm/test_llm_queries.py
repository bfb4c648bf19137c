"""The registered corpus queries: SQL where there is some, else plain Python,
held-out accuracy, or the pages' own structure."""

import html
import math
import re

import brute
import corpus_pipeline
import duckdb
import pytest
from cohortlab.llm import queries as Q
from cohortlab.llm import quality_fm, secrets
from cohortlab.sources.tables import TABLES
from conftest import SF01, SF001

import __spark_entry__ as E


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries().keys()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secret_scan", "mix"]


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_sql_agreement(spark, duck, key):
    got = E.queries()[key](spark, SF001)
    cols = sorted(got.columns)
    want = duck.sql(Q.ORACLE[key])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted(([plain(r[c]) for c in cols] for r in got.collect()), key=repr) == \
        sorted(([plain(r[i]) for i in at] for r in want.fetchall()), key=repr)


def documents(spark, sf):
    return [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_ngram_join_query(spark):
    docs = [(i, t) for i, _, t in documents(spark, SF01)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in E.queries()["op6_ngram_join"](spark, SF01).collect()}
    assert got == brute.ngram_components(docs)


def test_benchmark_query(spark):
    items = spark.read.parquet(f"{SF01}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in E.queries()["op8_benchmark_hits"](spark, SF01).collect()}
    assert got == {(i, b.item_id) for i, _, t in documents(spark, SF01) for b in items if brute.holds_item(t, b.text)}


def test_held_out_quality(spark):
    rows = E.queries()["op3_quality_fm"](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id") \
        .where("held_out and quality is not null").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_held_out_language(spark):
    rows = E.queries()["op5_language_hd"](spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet"), "doc_id") \
        .where("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)


def test_main_text_query(spark):
    """The test pages mark their article as such; the network is not told."""
    got = {r.page_id: r.text for r in E.queries()["op9_main_text"](spark, SF01).collect()}
    right = 0
    for r in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        article = re.sub(r"</?b>", "", article)
        right += got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
    assert right >= 0.97 * len(got)


def test_pipeline(spark):
    """All stages in plain Python, from the same quality scores on."""
    docs = documents(spark, SF001)
    frame = spark.read.parquet(f"{SF001}/documents.parquet")
    model = quality_fm.train(frame, spark.read.parquet(f"{SF001}/labels.parquet"))
    good = {r.doc_id for r in quality_fm.score(frame, model).where("score >= 0.5").collect()}
    rows = [d for d in docs if d[0] in good]
    same = brute.ngram_components([(i, t) for i, _, t in rows], 5, 80)
    rows = [d for d in rows if same[d[0]][1] == d[0]]
    items = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = [d for d in rows if not any(brute.holds_item(d[2], b) for b in items)]
    hidden = []
    for i, s, t in rows:
        spans, at, out = [], 0, ""
        for k, p, group, least in ((0, secrets.ASSIGN, 2, 8), (1, "AKIA[A-Z0-9]+", 0, 16), (2, "[0-9a-f]+", 0, 32)):
            spans += [(m.start(), k, m.end()) for m in re.finditer(p, t) if len(m[group]) >= least]
        for a, _, b in sorted(spans):
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        hidden.append((i, s, out + t[at:]))
    want = brute.mixed(hidden)
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got.keys() == {i for i, v in want.items() if v[3] > 0} and len(rows) < len(docs)
    for i, v in got.items():
        assert v[:2] == want[i][:2] and math.isclose(v[2], want[i][2]) and v[3] == want[i][3]


def test_pipeline_stages_keep_columns_and_take_odd_rows(spark):
    frame = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(10 ** 6, None, None, None, None), (10 ** 6 + 1, "", "en", "src0", 0),
                                 (10 ** 6 + 2, "x" * 200_000, "en", "src0", 200_000)], frame.schema)
    for docs in (frame.union(odd), frame.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF001)
            assert out.columns == frame.columns and out.schema.simpleString() == frame.schema.simpleString()
            assert out.count() <= docs.count()
        corpus_pipeline.mix(spark, docs, SF001).count()


def test_pipeline_quality_keeps_a_column_named_as_its_score(spark):
    frame = spark.read.parquet(f"{SF001}/documents.parquet").limit(60).selectExpr("*", "concat('s', doc_id) AS score")
    out = corpus_pipeline.quality(spark, frame, SF001)
    assert out.schema.simpleString() == frame.schema.simpleString()
    assert all(r.score == f"s{r.doc_id}" for r in out.collect())
