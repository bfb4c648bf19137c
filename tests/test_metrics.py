"""Metric goldens and properties."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlab.operators import metrics as M

# Confusion cells (TP, FP, FN, TN) that reproduce the published comparison
# table (test rows 2,387, positives 150), and that table's rounded values.
CELLS = {
    ("Logistic Regression", "Clinical"): (7, 12, 143, 2225, 0.9351, 0.3684, 0.0467, 0.0828),
    ("Random Forest", "Clinical"): (23, 21, 127, 2216, 0.9380, 0.5227, 0.1533, 0.2371),
    ("XGBoost", "Clinical"): (31, 50, 119, 2187, 0.9292, 0.3827, 0.2067, 0.2684),
    ("Support Vector Machine", "Clinical"): (1, 0, 149, 2237, 0.9376, 1.0000, 0.0067, 0.0132),
    ("Logistic Regression", "General"): (4, 8, 146, 2229, 0.9355, 0.3333, 0.0267, 0.0494),
    ("Random Forest", "General"): (27, 29, 123, 2208, 0.9363, 0.4821, 0.1800, 0.2621),
    ("XGBoost", "General"): (32, 40, 118, 2197, 0.9338, 0.4444, 0.2133, 0.2883),
    ("Support Vector Machine", "General"): (0, 0, 150, 2237, 0.9372, 0.0000, 0.0000, 0.0000),
    ("Logistic Regression", "Combined"): (16, 16, 134, 2221, 0.9372, 0.5000, 0.1067, 0.1758),
    ("Random Forest", "Combined"): (94, 6, 56, 2231, 0.9740, 0.9400, 0.6267, 0.7520),
    ("XGBoost", "Combined"): (112, 10, 38, 2227, 0.9799, 0.9180, 0.7467, 0.8235),
    ("Support Vector Machine", "Combined"): (13, 8, 137, 2229, 0.9393, 0.6190, 0.0867, 0.1520),
}


def _expand(spark):
    rows = []
    for (model, ds), (tp, fp, fn, tn, *_rest) in CELLS.items():
        for y, yh, n in [(1, 1, tp), (0, 1, fp), (1, 0, fn), (0, 0, tn)]:
            rows += [(model, ds, y, yh)] * n
    return spark.createDataFrame(rows, "model string, dataset string, y int, yhat int")


def test_published_metrics_reproduce(spark):
    df = _expand(spark)
    m = M.binary_metrics(df, "y", "yhat", ["model", "dataset"])
    long = M.metrics_long(m, ["model", "dataset"], ["accuracy", "precision", "recall", "f1"])
    got = {(r["model"], r["dataset"], r["metric"]): r["value"] for r in long.collect()}
    for (model, ds), (_tp, _fp, _fn, _tn, acc, prec, rec, f1) in CELLS.items():
        assert got[(model, ds, "accuracy")] == acc
        assert got[(model, ds, "precision")] == prec
        assert got[(model, ds, "recall")] == rec
        assert got[(model, ds, "f1")] == f1


def test_confusion_keeps_zero_cells(spark):
    df = _expand(spark).where("model = 'Support Vector Machine' AND dataset = 'General'")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion(df, "y", "yhat").collect()}
    assert cells == {(0, 0): 2237, (0, 1): 0, (1, 0): 150, (1, 1): 0}


def test_class_report_accuracy_row(spark):
    df = _expand(spark).where("model = 'Random Forest' AND dataset = 'Combined'")
    rows = {r["row"]: r for r in M.class_report(df, "y", "yhat").collect()}
    assert round(rows["accuracy"]["f1"], 4) == 0.9740 and rows["accuracy"]["support"] == 2387
    assert rows["1"]["support"] == 150 and rows["0"]["support"] == 2237


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = 0.0
    for p in pos:
        for n in neg:
            tot += 1.0 if p > n else 0.5 if p == n else 0.0
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_exact_vs_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(400)]
    pairs += [(0.5, 1)] * 50 + [(0.5, 0)] * 50  # heavy tie block
    df = spark.createDataFrame(pairs, "s double, y int")
    got = M.auc(df, "y", "s").first()["auc"]
    assert abs(got - _brute_auc(pairs)) < 1e-12
    flipped = M.auc(df.withColumn("s", 1 - F.col("s")), "y", "s").first()["auc"]
    assert abs(flipped - (1 - got)) < 1e-12


def test_roc_points_end_at_one(spark):
    rng = random.Random(3)
    pairs = [(rng.random(), int(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "s double, y int")
    pts = M.roc_points(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert pts[-1]["tpr"] == 1.0 and pts[-1]["fpr"] == 1.0
    tprs = [p["tpr"] for p in pts]
    assert tprs == sorted(tprs)


def test_best_by_ties_first(spark):
    df = spark.createDataFrame([("a", "m2", 0.9), ("a", "m1", 0.9), ("a", "m3", 0.8), ("b", "m1", 0.5)],
                               "g string, name string, auc double")
    got = {r["g"]: r["name"] for r in M.best_by(df, ["g"], "auc", "name").collect()}
    assert got == {"a": "m1", "b": "m1"}


def test_stratified_split_exact_share(spark):
    rows = [(i, int(i % 7 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = M.stratified_split(df, "y", "id", 0.2, 42)
    got = {(r["y"]): r["n"] for r in s.where("is_test = 1").groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1 = sum(1 for _, y in rows if y == 1)
    import math
    assert got == {1: math.ceil(0.2 * n1), 0: math.ceil(0.2 * (1000 - n1))}
    folds = M.stratified_folds(df, "y", "id", 5, 42).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1  # balanced within each class
