"""Second-order boosting, forests cut back and explained, kernel machine, grid search."""

import itertools
import math
import random

import numpy as np
import pytest
from cohortlab import config as C
from cohortlab.ml import boosting as B
from cohortlab.ml import forest as FO
from cohortlab.ml import kernel_svm as KS
from cohortlab.ml import models as ML
from cohortlab.operators import metrics as M
from cohortlab.plans import ml_queries as Q
from conftest import SF001
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F


def ring(n=900, seed=1):
    """Label 1 inside a circle: no line separates it."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.uniform(-2, 2), rng.uniform(-2, 2)
        rows.append((i, x, y, rng.gauss(0, 1), float(x * x + y * y < 1.6)))
    return rows


@pytest.fixture(scope="module")
def ring_rows(spark):
    rows = [(i, None if i % 11 == 0 else a, b, c, y) for i, a, b, c, y in ring()]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(3).cache()


# ------------------------------------------------------------------ boosting

def plain_boosting(rows, cuts, spec):
    """The same boosting by loops over rows; returns the margins after every round."""
    bins = [[B.ABSENT if v is None else sum(c < v for c in cs) for v, cs in zip(r, cuts, strict=True)] for r, _ in rows]
    y = [label for _, label in rows]
    margin, history = [0.0] * len(rows), []

    def best(at, g, h):
        top = None
        total_g, total_h = sum(g[i] for i in at), sum(h[i] for i in at)
        for f in range(len(cuts)):
            for b in sorted({bins[i][f] for i in at} - {B.ABSENT}):
                for absent_left in (False, True):
                    left = [i for i in at if (bins[i][f] <= b if bins[i][f] != B.ABSENT else absent_left)]
                    gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                    hr = total_h - hl
                    if not left or len(left) == len(at) or hl < spec.child_weight or hr < spec.child_weight:
                        continue
                    gain = gl ** 2 / (hl + spec.reg) + (total_g - gl) ** 2 / (hr + spec.reg) - total_g ** 2 / (total_h + spec.reg)
                    if top is None or gain > top[0] + 1e-9:
                        top = (gain, left)
        return top

    for _ in range(spec.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(p, y, strict=True)], [a * (1 - a) for a in p]

        def grow(at, depth, g=g, h=h):
            found = best(at, g, h) if depth < spec.depth else None
            if found is None or found[0] <= B.LEAST_GAIN:
                for i in at:
                    margin[i] -= spec.rate * sum(g[j] for j in at) / (sum(h[j] for j in at) + spec.reg)
                return
            left = set(found[1])
            grow([i for i in at if i in left], depth + 1)
            grow([i for i in at if i not in left], depth + 1)

        before = list(margin)
        grow(list(range(len(rows))), 0)
        history.append(list(margin))
        assert before != margin
    return history


def test_boosting_equals_plain_loops(spark, ring_rows):
    spec = B.BoostSpec(rounds=3, depth=3, bins=8)
    df = ring_rows.where("id < 300")
    cuts = B.fit_cuts(df, ["a", "b", "c"], 8)
    model = B.fit_boosting(df, ["a", "b", "c"], "y", spec, cuts)
    rows = sorted(df.collect())
    want = plain_boosting([((r.a, r.b, r.c), r.y) for r in rows], cuts, spec)[-1]
    got = {r.id: r.prob for r in B.score_boosted(df, model).collect()}
    assert all(math.isclose(got[r.id], 1 / (1 + math.exp(-m)), rel_tol=1e-9) for r, m in zip(rows, want, strict=True))


def test_boosting_learns_a_ring_and_stores_its_trees(spark, ring_rows, tmp_path):
    train, test = ring_rows.where("id % 3 <> 0"), ring_rows.where("id % 3 = 0")
    model = B.fit_boosting(train, ["a", "b", "c"], "y", B.BoostSpec(rounds=22, depth=4))
    assert all(b < a for a, b in itertools.pairwise(model.losses)) and model.losses[-1] < 0.1
    scored = B.score_boosted(test, model)
    assert M.auc(scored, "y", "prob").first()["auc"] > 0.97
    path = B.save_boosted(model, str(tmp_path / "boosted"), spark)
    back = B.score_boosted(test, B.load_boosted(path, spark), "again").select("id", "again")
    assert scored.join(back, "id").where("abs(prob - again) > 1e-12").count() == 0


def test_missing_values_follow_their_learned_side(spark):
    """Missing is its own signal: the label is 1 exactly where the value is missing."""
    df = spark.createDataFrame([(float(i % 10) if i % 3 else None, float(i % 3 == 0)) for i in range(120)], "a double, y double")
    model = B.fit_boosting(df, ["a"], "y", B.BoostSpec(rounds=15, depth=2, child_weight=0.1))
    probs = {(r.a is None): r.prob for r in B.score_boosted(df, model).collect()}
    nan = B.score_boosted(spark.createDataFrame([(math.nan,)], "a double"), model).first().prob
    assert probs[True] > 0.85 and probs[False] < 0.15 and nan == probs[True]


def test_boosting_of_odd_tables(spark):
    empty = spark.createDataFrame([], "a double, y double")
    assert B.score_boosted(empty, B.fit_boosting(empty, ["a"], "y", B.BoostSpec(rounds=2))).count() == 0
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (None, None), (1.0, 0.0)] * 5, "a double, y double")
    model = B.fit_boosting(flat, ["a"], "y", B.BoostSpec(rounds=30))
    assert all((t.feature < 0).all() for t in model.trees)
    assert abs(B.score_boosted(flat, model).first().prob - 2 / 3) < 0.05


# ------------------------------------------------------------------ forests

@pytest.fixture(scope="module")
def small_forest(spark, ring_rows):
    data = ring_rows.where("a is not null").withColumn("features", array_to_vector(F.array("a", "b", "c"))).coalesce(1).cache()

    def fit(**more):
        rf = RandomForestClassifier(featuresCol="features", labelCol="y", seed=7, **({"numTrees": 8, "maxDepth": 14} | more))
        return rf.fit(data)
    return data, fit


def test_forest_arrays_score_as_the_model(spark, small_forest):
    data, fit = small_forest
    model = fit()
    forest = FO.load_forest(model, spark)
    x = model.transform(data).select("id", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"))
    rows = FO.cut_back_scores(x, "x", forest, [FO.Setting(8, 30), FO.Setting(8, 3), FO.Setting(3, 30), FO.Setting(8, 30, 40)]).collect()
    assert all(abs(r.probs[0] - r.p) < 1e-12 for r in rows) and any(abs(r.probs[1] - r.p) > 0.01 for r in rows)
    assert FO.cut_back_scores(x.limit(0), "x", forest, [FO.Setting(8, 3)]).count() == 0
    with pytest.raises(Exception, match="fewer trees"):
        FO.cut_back_scores(x, "x", forest, [FO.Setting(9, 3)]).collect()


def test_reused_and_refitted_settings_are_equal(spark, small_forest):
    """A limit that no tree reaches changes nothing: the refitted forest gives the reused one's scores."""
    data, fit = small_forest
    deep = fit(maxDepth=25)
    forest = FO.load_forest(deep, spark)
    reached = int(forest.depth.max())
    assert reached < 25
    x = data.select("id", vector_to_array("features").alias("x"))
    reused = FO.cut_back_scores(x, "x", forest, [FO.Setting(8, reached)])
    refit = fit(maxDepth=reached).transform(data).select("id", vector_to_array("probability")[1].alias("p"))
    assert refit.join(reused, "id").where("abs(p - probs[0]) > 1e-12").count() == 0


def test_a_single_tree_cut_back_is_the_tree_grown_to_that_depth(spark, small_forest):
    """With all features at every node and all rows, growth has no chance in it, so refits show the cut exactly."""
    data, fit = small_forest
    plain = {"numTrees": 1, "featureSubsetStrategy": "all", "bootstrap": False}
    forest = FO.load_forest(fit(**plain), spark)
    x = data.select("id", vector_to_array("features").alias("x"))
    for depth in (1, 3, 5):
        p = fit(**plain, maxDepth=depth).transform(data).select("id", vector_to_array("probability")[1].alias("p"))
        cut = FO.cut_back_scores(x, "x", forest, [FO.Setting(1, depth)])
        assert p.join(cut, "id").where("abs(p - probs[0]) > 1e-12").count() == 0


def expected(forest, root, x, known):
    """A tree's value where only the features ``known`` are."""
    f = int(forest.feature[root])
    if f < 0:
        return forest.value[root]
    left, right = int(forest.left[root]), int(forest.right[root])
    if f in known:
        return expected(forest, left if x[f] <= forest.threshold[root] else right, x, known)
    w = forest.weight
    return (w[left] * expected(forest, left, x, known) + w[right] * expected(forest, right, x, known)) / w[root]


def test_contributions_equal_all_orders(spark, small_forest):
    data, fit = small_forest
    model = fit(numTrees=3, maxDepth=6)
    forest = FO.load_forest(model, spark)
    x = model.transform(data).select("id", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"))
    out, base = FO.contributions(x, "x", forest, 3)
    rows = out.collect()
    assert len(rows) == data.count() and all(abs(base + sum(r.contributions) - r.p) < 1e-9 for r in rows)
    for r in rows[:25]:
        def value(known, x=r.x):
            return sum(expected(forest, int(t), x, known) for t in forest.roots) / len(forest.roots)
        want = [0.0] * 3
        for order in itertools.permutations(range(3)):
            for k, f in enumerate(order):
                want[f] += (value(set(order[:k + 1])) - value(set(order[:k]))) / 6
        assert np.allclose(r.contributions, want, atol=1e-10) and abs(base - value(set())) < 1e-10
    top = FO.ranked(out, "id", ["a", "b", "c"], 2).where("id = 5").orderBy("rank").collect()
    assert len(top) == 2 and abs(top[0].contribution) >= abs(top[1].contribution)
    assert all((t.contribution >= 0) == (t.direction == "raises") for t in top)


# ------------------------------------------------------------------ kernel machine

def test_kernel_machine_separates_a_ring(spark, tmp_path):
    df = spark.createDataFrame([(i, [a, b], y) for i, a, b, _, y in ring()], "id long, x array<double>, y double").repartition(3).cache()
    train, test = df.where("id % 3 <> 0"), df.where("id % 3 = 0")
    model = KS.fit_kernel_svm(train, "x", "y", "id", landmarks=80)
    s = KS.score_kernel_svm(test, model, "x").cache()
    right = s.where("(margin > 0) = (y = 1)").count() / s.count()
    assert right > 0.95 and M.auc(s, "y", "prob").first()["auc"] > 0.99
    assert s.where("(prob > 0.5) <> (margin > 0) and abs(margin) > 0.3").count() == 0
    linear = KS.fit_kernel_svm(train, "x", "y", "id", landmarks=80, gamma=1e-6)  # so wide that the kernel is linear
    flat = KS.score_kernel_svm(test, linear, "x")
    assert flat.where("(margin > 0) = (y = 1)").count() / s.count() < 0.8
    back = KS.load_kernel_svm(KS.save_kernel_svm(model, str(tmp_path / "svm"), spark), spark)
    again = KS.score_kernel_svm(test, back, "x", "m2", "p2").select("id", "m2", "p2")
    assert s.join(again, "id").where("abs(margin - m2) > 1e-9 or abs(prob - p2) > 1e-9").count() == 0


def test_the_map_equals_the_kernel_on_the_landmarks():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(60, 4))
    points[7] = points[3]
    kernel = KS.rbf(points, points, 0.4)
    model = KS.KernelSvm(0.4, points, KS.inverse_root(kernel), np.zeros(1))
    z = model.mapped(points)[:, :-1]
    assert z.shape[1] == 59 and np.allclose(z @ z.T, kernel, atol=1e-7)


def test_newton_reaches_the_minimum(spark):
    """The objective does not fall in any direction from the weights found."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=150) > 0).astype(float)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(150)], "id long, x array<double>, y double")
    model = KS.fit_kernel_svm(df, "x", "y", "id", landmarks=20, folds=2)
    z, sign = model.mapped(x), np.where(y > 0.5, 1, -1)

    def objective(w):
        return 0.5 * (w[:-1] ** 2).sum() + (np.maximum(0, 1 - sign * (z @ w)) ** 2).sum()

    here = objective(model.weights)
    for _ in range(200):
        assert objective(model.weights + rng.normal(scale=0.01, size=len(model.weights))) > here - 1e-4


def test_sums_over_a_tree_of_tasks(spark):
    parts = spark.range(0, 70, 1, 70).mapInArrow(
        lambda batches: iter([__import__("pyarrow").RecordBatch.from_pydict(
            {"objective": [np.ones(3).tobytes()], "n": [b.num_rows]}) for b in batches]), KS._ROW)
    assert KS._summed(parts, 70).tolist() == [70.0] * 3


# ------------------------------------------------------------------ grid search and comparison

def test_grid_search_of_a_small_grid(spark):
    df = Q.clinical(spark, SF001)
    g = ML.grid_search(df, C.CLINICAL_FEATURES, trees=(5, 10), depths=(8, 2), splits=(2, 20), leaves=(1, 4), folds=3)
    rows = g.cv.collect()
    assert len(rows) == 16 and all(0.4 <= r.mean_cv_auc <= 1 for r in rows) and 0.4 <= g.test_auc <= 1
    assert max(r.mean_cv_auc for r in rows) == rows[g.best].mean_cv_auc
    trained = df.count() - sum(math.ceil(C.TEST_FRACTION * r["count"]) for r in df.groupBy(C.TARGET_COL).count().collect())
    counts = {r["setting"]: r["count"] for r in g.scored.groupBy("setting").count().collect()}
    assert counts == dict.fromkeys(range(16), trained)
    # recomputed plainly from the scores of one setting and fold
    one = [(r.prob, r[C.TARGET_COL]) for r in g.scored.where("setting = 0 and fold = 1").collect()]
    up, down = [p for p, y in one if y == 1], [p for p, y in one if y == 0]
    auc = sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down))
    assert abs(M.auc(g.scored.where("setting = 0 and fold = 1"), C.TARGET_COL, "prob").first()["auc"] - auc) < 1e-9
    names = [type(s).__name__ for s in g.model.stages]
    assert names[-1] == "RandomForestClassificationModel"
