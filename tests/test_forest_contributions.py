"""Large forests: exact contributions from their tables, streams, trees in groups."""

import itertools
import math

import numpy as np
import pytest
from cohortlab.ml import forest as FO
from cohortlab.ml import models as ML
from cohortlab.ml import preprocess as PP
from cohortlab.ml import table_forest as TF
from cohortlab.plans import ml_queries as Q
from cohortlab.streaming import jobs
from conftest import SF001
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_table_forest import ring

import __spark_entry__ as E


def grown_trees():
    """Three trees, the second one of two parts below an upper split."""
    rng = np.random.default_rng(0)
    bins = rng.integers(0, 20, (1500, 4)).astype(np.uint8)
    y = ((bins[:, 0].astype(int) * 2 + bins[:, 1] - bins[:, 2] + rng.normal(0, 6, 1500)) > 20).astype(int)
    top = TF.Top([-1] * 3, [-1] * 3, [-1] * 3, [0] * 3, [0, 1, 2], [-1] * 3, [0] * 3, [1.0] * 3)
    at = top.split(1, 0, 9, [0.3, 0.6], [0.4, 0.6])
    chosen = {0: bins[:, 0] >= 0, 2: bins[:, 3] > 2, at: bins[:, 0] <= 9, at + 1: bins[:, 0] > 9}
    w = 1.0 + rng.poisson(0.5, 1500)
    return TF.joined(top, [(p, TF.grow(bins[c], y[c], w[c], 12, 1, np.random.default_rng(p))) for p, c in chosen.items()]), bins


def value(nodes, i, x, known):
    f = nodes.feature[i]
    if f < 0:
        return nodes.value[i]
    left = nodes.left[i]
    if f in known:
        return value(nodes, left + int(x[f] > nodes.cut[i]), x, known)
    return nodes.share[i] * value(nodes, left, x, known) + (1 - nodes.share[i]) * value(nodes, left + 1, x, known)


@pytest.mark.parametrize("table", [0, TF.TABLE])
@pytest.mark.parametrize("rows", [6, 1500])
def test_contributions_equal_all_sets(monkeypatch, table, rows):
    """By walks and by tables (many rows) the mean gains over all orders; a missing value goes right."""
    monkeypatch.setattr(TF, "TABLE", table)
    nodes, bins = grown_trees()
    x = bins[:rows].copy()
    x[5, 1] = TF.BINS - 1
    got = TF.shapley(nodes, [0, 1, 2], [20] * 4, x)
    for r in range(6):
        v = {s: sum(value(nodes, t, x[r], s) for t in (0, 1, 2)) for n in range(5) for s in itertools.combinations(range(4), n)}
        for f in range(4):
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (v[tuple(sorted((*s, f)))] - v[s]) for s in v if f not in s)
            assert abs(want - got[r, f]) < 1e-11


def test_sorted_rows_split_as_counts():
    rng = np.random.default_rng(6)
    for leaf in (1, 4):
        sizes = rng.integers(1, 40, 60)
        at = np.repeat(np.arange(60), sizes)
        bins = rng.integers(0, TF.BINS, (len(at), 5)).astype(np.uint8)
        w = rng.integers(1, 6, len(at)).astype(float)
        p = w * rng.integers(0, 2, len(at))
        features = np.array([rng.permutation(5)[:3] for _ in range(60)])
        for a, b in zip(TF._by_counts(bins, w, p, at, features, leaf), TF._by_order(bins, w, p, at, features, leaf), strict=True):
            good = TF._by_counts(bins, w, p, at, features, leaf)[0] > 0
            assert (a[good] == b[good]).all()


@pytest.mark.parametrize("part_rows, block_rows", [(200, 400), (100_000, 250_000)])
def test_contributions_of_a_table_forest(spark, monkeypatch, part_rows, block_rows):
    """They and the base value make the probability; ids repeat and are null, values are missing."""
    monkeypatch.setattr(TF, "PART_ROWS", part_rows)
    monkeypatch.setattr(TF, "BLOCK_ROWS", block_rows)
    df = ring(spark, 900)
    x = PP.fit_preprocessor(df, ["a", "b", "c"], []).transform(df)
    forest = TF.fit_forest(x, "label", 7, 30, 1, 3)
    rows = forest.transform(x).select("id", "b", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("prob"))
    out, base = forest.contributions(rows, "x")
    found = out.collect()
    assert len(found) == 900 and out.columns == [*rows.columns, "contributions"]
    assert all(abs(base + sum(r.contributions) - r.prob) < 1e-9 for r in found)
    assert len({tuple(r.contributions) for r in found}) > 800
    empty, _ = forest.contributions(rows.limit(0), "x")
    assert empty.count() == 0
    with pytest.raises(ValueError, match="all sets"):
        TF.TableForest(spark, forest.path, forest.top, forest.cuts * 3, 7).contributions(rows, "x")


def test_large_contributions_need_no_model_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(ML, "WHOLE_DRAWS", 0)
    monkeypatch.setattr(FO, "load_forest", None)
    rows = E.queries()["forest_contributions_add_up"](spark, SF001).collect()
    assert len(rows) > 100 and all(r.adds_up for r in rows)
    ranked = E.queries()["forest_contributions"](spark, SF001)
    assert ranked.count() == 5 * len(rows) and ranked.where("direction = 'raises' and contribution < 0").count() == 0


def test_trees_in_groups_answer_alike(spark, monkeypatch):
    """One tree a group: the same nodes and the same scores as all trees at once."""
    df = ring(spark, 500).coalesce(1)
    x = PP.fit_preprocessor(df, ["a", "b", "c"], []).transform(df).cache()
    once = TF.fit_forest(x, "label", 5, 10, 1, 3)
    whole = once.transform(x).select("b", "c", "probability").collect()
    assert TF.tree_groups(5, 500) == [range(5)] and TF.tree_groups(5, 0) == [range(5)]
    monkeypatch.setattr(TF, "DEALT", 1000)
    assert TF.tree_groups(5, 500) == [range(2), range(2, 4), range(4, 5)]
    groups = TF.fit_forest(x, "label", 5, 10, 1, 3)
    assert sorted(map(str, groups.transform(x).select("b", "c", "probability").collect())) == sorted(map(str, whole))
    nodes = [sorted((r.part, bytes(r.nodes)) for r in spark.read.parquet(f.path).collect()) for f in (once, groups)]
    assert nodes[0] == nodes[1] and len(nodes[0]) == 5


def test_saved_models_leave_no_models(spark, monkeypatch):
    monkeypatch.setattr(ML, "WHOLE_DRAWS", 0)
    left = []
    monkeypatch.setattr(Q, "drop_path", lambda s, path: left.append(path))
    out = Q.saved_models(spark, SF001)
    assert len(left) == 6 and all(r.n_rows == r.n_same > 100 for r in out.collect())


@pytest.mark.parametrize("part_rows", [150, 100_000])
def test_a_stream_scored_by_a_table_forest(spark, monkeypatch, tmp_path, part_rows):
    """Every row as in the batch, with rows read in several blocks and files."""
    monkeypatch.setattr(ML, "WHOLE_DRAWS", 0)
    monkeypatch.setattr(TF, "PART_ROWS", part_rows)
    monkeypatch.setattr(TF, "READ_FOR", 40)
    df = ring(spark, 700)
    model = ML.fit_model(ML.ModelSpec("Random Forest", rf_trees=6), df, PP.fit_preprocessor(df, ["a", "b", "c"], []))
    rows = df.select("id", "a", "b", "c")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = spark.read.parquet(jobs.run_to_parquet(jobs.stream_scores(model, stream, ["a", "b", "c"]), "scores"))
    want = ML.score_batch(model, rows, ["a", "b", "c"])
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.count() == 700 and want.select(F.countDistinct("Prob_Pos")).first()[0] > 3
