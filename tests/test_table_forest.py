"""Forests whose nodes stay a table: splits, parts, scores, saving and loading."""

import random

import numpy as np
import pytest
from cohortlab.ml import forest as FO
from cohortlab.ml import models as ML
from cohortlab.ml import preprocess as PP
from cohortlab.ml import table_forest as TF
from cohortlab.operators import metrics as M
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


def ring(spark, n=1500):
    rng = random.Random(5)
    rows = [(i if i % 9 else None, rng.uniform(-2, 2), rng.uniform(-2, 2), rng.gauss(0, 1)) for i in range(n)]
    rows = [(*r, float(r[1] ** 2 + r[2] ** 2 < 1.6)) for r in rows]
    return spark.createDataFrame([(i, None if k % 13 == 0 else a, b, c, y) for k, (i, a, b, c, y) in enumerate(rows)],
                                 "id long, a double, b double, c double, label double").repartition(3)


def test_grown_nodes_hold_the_shares_of_their_rows():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, TF.BINS, (700, 3)).astype(np.uint8)
    y = ((bins[:, 0] > 30) ^ (bins[:, 1] > 20)).astype(int)
    w = rng.integers(1, 4, 700).astype(float)
    for depth, leaf in ((30, 1), (3, 1), (30, 40), (0, 1)):
        nodes = TF.grow(bins, y, w, depth, leaf, np.random.default_rng(1))
        walk = TF.Walk(*(nodes[k].astype(np.int64) for k in ("feature", "cut", "left")))
        at = walk(bins)
        for node in np.unique(at):
            here = at == node
            assert abs(nodes["value"][node] / TF.ONE - (w * y)[here].sum() / w[here].sum()) < 1e-9
            assert w[here].sum() >= leaf
        assert ((nodes["value"][at] > TF.ONE // 2) == (y == 1)).all() or (depth, leaf) != (30, 1)
    assert len(TF.grow(bins, y, w, 0, 1, rng)) == 1


def test_best_split_equals_a_loop():
    rng = np.random.default_rng(8)
    w = rng.integers(0, 3, (4, 2, TF.BINS)).astype(float)
    w[:, 1] *= w[:, 0].sum(axis=1, keepdims=True) / w[:, 1].sum(axis=1, keepdims=True)
    p = np.floor(w * rng.random(w.shape))
    p[:, 1] *= p[:, 0].sum(axis=1, keepdims=True) / p[:, 1].sum(axis=1, keepdims=True)

    def impurity(n, k):
        return n - (k * k + (n - k) ** 2) / n if n else 0.0
    gain, which, cut = TF.best_splits(w, p, 5)
    for node in range(4):
        found = {}
        for f in range(2):
            n, k = w[node, f].sum(), p[node, f].sum()
            for c in range(TF.BINS - 1):
                ln, lk = w[node, f, :c + 1].sum(), p[node, f, :c + 1].sum()
                if ln >= 5 and n - ln >= 5:
                    found[f, c] = impurity(n, k) - impurity(ln, lk) - impurity(n - ln, k - lk)
        assert abs(gain[node] - max(found.values())) < 1e-9 and abs(found[which[node], cut[node]] - gain[node]) < 1e-9


@pytest.mark.parametrize("part_rows", [200, 100_000])
def test_a_large_forest_stays_a_table(spark, tmp_path, monkeypatch, part_rows):
    """Fitted, scored, saved and loaded without a model of all nodes; ids repeat and are null, values are missing."""
    monkeypatch.setattr(ML, "WHOLE_DRAWS", 0)
    monkeypatch.setattr(TF, "PART_ROWS", part_rows)
    df = ring(spark)
    pre = PP.fit_preprocessor(df, ["a", "b", "c"], [])
    model = ML.fit_model(ML.ModelSpec("Random Forest", rf_trees=12), df, pre)
    forest = model.stages[-1]
    assert isinstance(forest, TF.TableForest)
    assert (len(forest.top.feature) > 12) == (part_rows == 200)  # one part a tree, or several
    back = ML.load_model(ML.save_model(model, str(tmp_path / "model")))
    a, b = (ML.predict(m, df, ["a", "b", "c", "label"]).collect() for m in (model, back))
    assert len(a) == 1500 and sorted(map(str, a)) == sorted(map(str, b))
    assert all(r.prediction == (r.prob > 0.5) and 0 <= r.prob <= 1 for r in a)
    fresh = ring(spark, 2500).where("id >= 1500")
    assert M.auc(ML.predict(model, fresh, ["label"]), "label", "prob").first()["auc"] > 0.97
    assert ML.score_batch(model, df.select("id", "a", "b"), ["a", "b", "c"]).count() == 1500
    assert ML.predict(model, df.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("part_rows", [150, 100_000])
def test_cut_back_scores_of_a_table(spark, monkeypatch, part_rows):
    """The full size is the forest itself; cut to depth 0 it is the mean of the roots; fewer trees, other scores."""
    monkeypatch.setattr(TF, "PART_ROWS", part_rows)
    df = PP.fit_preprocessor(ring(spark, 600), ["a", "b", "c"], []).transform(ring(spark, 600))
    forest = TF.fit_forest(df, "label", 6, 12, 1, 3)
    p = {(r.b, r.c): r for r in forest.transform(df).select("b", "c", "label", "probability").collect()}
    x = df.select("b", "c", F.col("features").alias("v")).select("b", "c", vector_to_array("v").alias("x"))
    rows = forest.cut_back_scores(x, "x", [FO.Setting(6, 12), FO.Setting(6, 0), FO.Setting(6, 2), FO.Setting(2, 12), FO.Setting(6, 12, 60)]).collect()
    assert len(rows) == 600
    assert all(abs(r.probs[0] - p[r.b, r.c].probability[1]) < 1e-9 for r in rows)
    share = sum(r.label for r in p.values()) / 600
    assert len({r.probs[1] for r in rows}) == 1 and abs(rows[0].probs[1] - share) < 0.05
    assert len({r.probs[2] for r in rows}) <= 4 ** 6
    right = [sum((r.probs[k] > 0.5) == (p[r.b, r.c].label == 1) for r in rows) / 600 for k in range(5)]
    assert right[0] > 0.97 and right[3] > 0.9 and right[2] < right[0] and right[4] < right[0]
    with pytest.raises(ValueError, match="fewer trees"):
        forest.cut_back_scores(x, "x", [FO.Setting(7, 3)])


def test_grid_search_over_table_forests(spark, monkeypatch):
    monkeypatch.setattr(ML, "WHOLE_DRAWS", 0)
    df = ring(spark, 400).selectExpr("row_number() over (order by a, b, c) as SEQN", "a", "b", "c", "cast(label as int) as y")
    g = ML.grid_search(df, ["a", "b", "c"], trees=(2, 4), depths=(8, 2), splits=(2, 20), leaves=(1,), key="SEQN", target="y", folds=2)
    rows = g.cv.collect()
    assert len(rows) == 8 and isinstance(g.model.stages[-1], TF.TableForest) and g.test_auc > 0.8
    assert len({r["count"] for r in g.scored.groupBy("setting").count().collect()}) == 1
