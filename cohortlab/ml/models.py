"""Models, training, evaluation, persistence and scoring.

Four families, each a Spark ML estimator:

* Logistic Regression   L2 with the summed-loss scale: regParam = 1/(C*n)
* Random Forest         100 trees, sqrt feature subsets; Spark caps depth at 30.
                         Past ``WHOLE_DRAWS`` rows times trees its nodes stay a
                         distributed table (``table_forest``)
* Gradient-boosted trees depth 6, step 0.3 (first-order boosting; no
                         second-order regularised loss, so scores differ)
* Linear SVM            LinearSVC on the standardised inputs, probabilities by
                         Platt scaling (a one-input logistic regression on the
                         margin). ``svm_features > 0`` adds random Fourier
                         features (Rahimi & Recht) to approximate the RBF kernel;
                         off by default: at these sizes it scored no better
                         than linear and cost 25x the time.

Each fitted model is one ``PipelineModel`` (preprocessor stages + model
stages), saved and loaded with Spark's ML writer; with a table forest it is one
``ForestPipeline``, whose nodes are saved as a table beside the other stages.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import rules
from ..operators import metrics as M
from ..session import drop_path
from ..sources.tables import checkpoint_table, written_table
from .forest import Setting, cut_back_scores, load_forest
from .preprocess import Preprocessor, fit_preprocessor, split_types
from .table_forest import ForestPipeline, TableForest, fit_forest, load_forest_pipeline

LABEL = "label"


@dataclass
class ModelSpec:
    name: str
    gbt_rounds: int = 100
    rf_trees: int = 100
    rf_depth: int = 30
    rf_leaf: int = 1
    svm_features: int = 0   # > 0: random Fourier features (RBF approximation)
    seed: int = C.SEED


def _lr(n_train: int, c: float = 1.0) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=1000, tol=1e-6,
                              regParam=1.0 / (c * max(n_train, 1)), elasticNetParam=0.0, standardization=False)


def _rff_stages(inputs: list[str], d_out: int, gamma: float, seed: int) -> list:
    """Random Fourier features z_i(x) = sqrt(2/D) cos(w_i . x + b_i) with
    w ~ N(0, 2 gamma), b ~ U(0, 2 pi): one SQL expression per output over the
    scalar model inputs, then a VectorAssembler. Fixed seed, so the feature
    map is part of the saved model."""
    rng = random.Random(seed)
    sd = math.sqrt(2.0 * gamma)
    scale = math.sqrt(2.0 / d_out)
    exprs = []
    for i in range(d_out):
        w = [rng.gauss(0.0, sd) for _ in inputs]
        b = rng.uniform(0.0, 2 * math.pi)
        dot = " + ".join(f"{wi!r}D * {c}" for wi, c in zip(w, inputs))
        exprs.append(f"{scale!r}D * cos({dot} + {b!r}D) AS __rff{i}")
    sql = SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__")
    asm = VectorAssembler(inputCols=[f"__rff{i}" for i in range(d_out)], outputCol="rff")
    return [sql, asm]


ROWS_PER_TASK = 20_000
WHOLE_DRAWS = 4_000_000  # rows times trees up to which the driver holds a forest's nodes
FOREST_MB = 256  # split statistics that every task of a forest's pass holds, once more when they are dealt out


def held_for_fits(data: DataFrame) -> DataFrame:
    """A training set kept in memory over many passes, in as many partitions as
    its rows are worth: the iterations over a small one are all overhead."""
    kept = data.persist()
    n = max(1, -(-kept.count() // ROWS_PER_TASK))
    if n >= kept.rdd.getNumPartitions():
        return kept
    fewer = data.coalesce(n).persist()
    fewer.count()
    kept.unpersist()
    return fewer


def fit_model(spec: ModelSpec, train: DataFrame, pre: Preprocessor, data: DataFrame | None = None,
              whole: bool = False) -> PipelineModel | ForestPipeline:
    """Fit preprocessor stages + one model family; returns one PipelineModel
    whose output has ``prediction`` and ``probability``. ``data`` is the
    training set after ``pre``, if the caller holds it for several models;
    ``whole`` asks for Spark's own forest whatever its size."""
    prem = pre.model()
    own = data is None
    if own:
        data = held_for_fits(prem.transform(train))
    try:
        n = data.count()
        if spec.name == "Logistic Regression":
            stages = [_lr(n).fit(data)]
        elif spec.name == "Random Forest" and not whole and n * spec.rf_trees > WHOLE_DRAWS:
            return ForestPipeline(prem, fit_forest(data, LABEL, spec.rf_trees, spec.rf_depth, spec.rf_leaf, spec.seed))
        elif spec.name == "Random Forest":
            # Deep trees: node ids are cached, so a pass does not walk the trees again.
            rf = RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=spec.rf_trees,
                                        maxDepth=spec.rf_depth, featureSubsetStrategy="sqrt", seed=spec.seed,
                                        minInstancesPerNode=spec.rf_leaf, maxBins=64, cacheNodeIds=True,
                                        maxMemoryInMB=FOREST_MB)
            stages = [rf.fit(data)]
        elif spec.name == "Boosted Trees":
            gbt = GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=spec.gbt_rounds, maxDepth=6,
                                stepSize=0.3, seed=spec.seed, maxBins=64)
            stages = [gbt.fit(data)]
        elif spec.name == "Linear SVM":
            if spec.svm_features > 0:
                inputs = [n for n, _ in pre.expressions()]
                # gamma='scale': 1 / (n_features * variance of all feature values)
                var = data.select(F.explode(vector_to_array("features")).alias("v")).agg(F.var_pop("v")).first()[0]
                gamma = 1.0 / (len(inputs) * (var or 1.0))
                rff = _rff_stages(inputs, spec.svm_features, gamma, spec.seed)
                feats = "rff"
            else:
                rff, feats = [], "features"
            z = PipelineModel(stages=rff).transform(data).persist() if rff else data
            svc = LinearSVC(featuresCol=feats, labelCol=LABEL, regParam=1.0 / max(n, 1), maxIter=100, tol=1e-4,
                            predictionCol="svm_prediction", rawPredictionCol="svm_raw").fit(z)
            margin = VectorSlicer(inputCol="svm_raw", outputCol="svm_margin", indices=[1])
            zm = margin.transform(svc.transform(z))
            platt = LogisticRegression(featuresCol="svm_margin", labelCol=LABEL, regParam=0.0, maxIter=100).fit(zm)
            if rff:
                z.unpersist()
            stages = rff + [svc, margin, platt]
        else:
            raise ValueError(spec.name)
    finally:
        if own:
            data.unpersist()
    return PipelineModel(stages=list(prem.stages) + stages)


def positive_probability(scored: DataFrame) -> F.Column:
    """P(class 1) from ``probability``; else the sigmoid of the
    margin; else the prediction as a number."""
    cols = scored.columns
    if "probability" in cols:
        return vector_to_array("probability")[1]
    if "rawPrediction" in cols:
        from ..functions.scalars import sigmoid
        return sigmoid(vector_to_array("rawPrediction")[1])
    return F.col("prediction").cast("double")


def predict(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    s = model.transform(df)
    return s.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                    positive_probability(s).alias("prob"))


def prepare(df: DataFrame, features: list[str], target: str = C.TARGET_COL) -> DataFrame:
    """Label column as double for Spark ML."""
    return df.withColumn(LABEL, F.col(target).cast("double"))


def train_and_evaluate(df: DataFrame, feature_sets: dict[str, list[str]], specs: list[ModelSpec],
                       key: str = C.ID_COL, target: str = C.TARGET_COL, workers: int = 4) -> DataFrame:
    """One stratified split; per feature set a preprocessor fitted on the
    training rows and one prepared training set for all its models, which are
    fitted side by side. The test predictions of all models are written as one
    table, so that one job gives all metrics and one all AUCs. Returns the
    results table (U1/M15), metrics half-even to 4 places."""
    d = prepare(M.stratified_split(df, target, key, C.TEST_FRACTION, C.SEED), [], target).persist()
    held = [d]
    try:
        train, test = d.where("is_test = 0"), d.where("is_test = 1")
        jobs, sizes = [], []
        for dataset, features in feature_sets.items():
            num, cat = split_types(d, features, key)
            pre = fit_preprocessor(train, num, cat)
            data = held_for_fits(pre.model().transform(train.select(key, target, LABEL, *num, *cat)))
            held.append(data)
            sizes.append((dataset, len(num) + len(cat)))
            jobs += [(dataset, spec, pre, data) for spec in specs]
        with ThreadPoolExecutor(workers) as pool:
            models = list(pool.map(lambda j: fit_model(j[1], train, j[2], j[3]), jobs))
        by = ["Model", "Dataset"]
        scored = [predict(m, test, [key, target]).select(F.lit(spec.name).alias("Model"), F.lit(dataset).alias("Dataset"),
                                                         target, "prediction", "prob")
                  for m, (dataset, spec, _, _) in zip(models, jobs, strict=True)]
        p = checkpoint_table(reduce(DataFrame.unionByName, scored), "test_predictions")
    finally:
        for x in held:
            x.unpersist()
    counts = df.sparkSession.createDataFrame(sizes, "Dataset string, Features_Count int")
    rows = M.binary_metrics(p, target, "prediction", by).join(M.auc(p, target, "prob", by), by).join(F.broadcast(counts), "Dataset")
    values = {"Accuracy": "accuracy", "Precision": "precision", "Recall": "recall", "F1-Score": "f1", "AUC-ROC": "auc"}
    return rows.select("Model", "Dataset", "Features_Count", *[F.bround(F.col(v), 4).alias(k) for k, v in values.items()])


@dataclass
class GridSearch:
    """Mean held-out AUC of every setting over the folds, the rows scored, and
    the best setting refit on all training rows."""

    cv: DataFrame          # num_trees, max_depth, min_split, min_leaf, mean_cv_auc
    scored: DataFrame      # setting, fold, target, prob: one row a setting and held-out row
    settings: list[tuple[Setting, int]]
    best: int
    model: PipelineModel
    test_auc: float


def grid_settings(trees, depths, splits, leaves) -> list[tuple[Setting, int]]:
    """(size, least rows of a leaf) of all combinations, in the grid's order."""
    return [(Setting(n, d, s), leaf) for n, d, s, leaf in product(trees, depths, splits, leaves)]


def grid_search(df: DataFrame, features: list[str], trees=(100, 200), depths=(30, 10, 20), splits=(2, 5), leaves=(1, 2),
                key: str = C.ID_COL, target: str = C.TARGET_COL, folds: int = C.CV_FOLDS) -> GridSearch:
    """Random-forest grid over trees x depth x split size x leaf size
    with stratified folds (M8) on the training rows. In each fold the
    preprocessor is fitted on the fold's own training rows, and one forest per
    leaf size, with the most trees and the greatest depth; all other settings
    are that forest cut back (see ``forest``). Fold scores are exact AUCs."""
    spark = df.sparkSession
    d = prepare(M.stratified_split(df, target, key, C.TEST_FRACTION, C.SEED), features, target)
    d, path = written_table(d, "grid_rows")
    train, test = d.where("is_test = 0"), d.where("is_test = 1")
    dealt = M.stratified_folds(train, target, key, folds, C.SEED).persist()
    num, cat = split_types(d, features, key)
    settings = grid_settings(trees, depths, splits, leaves)

    def fitted(rows: DataFrame, leaf: int, pre: Preprocessor, data: DataFrame | None = None) -> PipelineModel:
        return fit_model(ModelSpec("Random Forest", rf_trees=max(trees), rf_depth=max(depths), rf_leaf=leaf), rows, pre, data)

    def scores(rows: DataFrame, pre: Preprocessor, model: PipelineModel, use: list[int], keep: list[str]) -> DataFrame:
        x = pre.model().transform(rows).select(*keep, vector_to_array("features").alias("x"))
        forest, sizes = model.stages[-1], [settings[i][0] for i in use]
        probs = forest.cut_back_scores(x, "x", sizes) if isinstance(forest, TableForest) else \
            cut_back_scores(x, "x", load_forest(forest, spark), sizes)
        return probs.select(*keep, F.posexplode("probs").alias("at", "prob")).select(
            F.get(F.array(*map(F.lit, use)), F.col("at")).alias("setting"), *keep, "prob")

    parts = []
    try:
        for k in range(folds):
            own, other = dealt.where(F.col("fold") != k), dealt.where(F.col("fold") == k)
            pre = fit_preprocessor(own, num, cat)
            data = held_for_fits(pre.model().transform(own))
            for leaf in leaves:
                use = [i for i, s in enumerate(settings) if s[1] == leaf]
                parts.append(checkpoint_table(scores(other, pre, fitted(own, leaf, pre, data), use, ["fold", target]), "grid_scores"))
            data.unpersist()
        scored = reduce(DataFrame.unionByName, parts)
        by = M.auc(scored, target, "prob", ["setting", "fold"])
        means = {r["setting"]: r["auc"] for r in by.groupBy("setting").agg(F.avg("auc").alias("auc")).collect()}
        best = max(range(len(settings)), key=lambda i: (means[i], -i))
        pre = fit_preprocessor(train, num, cat)
        model = fitted(train, settings[best][1], pre)
        test_auc = M.auc(scores(test, pre, model, [best], [target]), target, "prob").first()["auc"]
    finally:
        dealt.unpersist()
        drop_path(spark, path)
    rows = [(s.trees, s.depth, s.split, leaf, float(means[i])) for i, (s, leaf) in enumerate(settings)]
    cv = spark.createDataFrame(rows, "num_trees int, max_depth int, min_split int, min_leaf int, mean_cv_auc double")
    return GridSearch(cv, scored, settings, best, model, test_auc)


# ---------------------------------------------------------------- scoring

def score_batch(model: PipelineModel, raw: DataFrame, features: list[str], fill=0) -> DataFrame:
    """Positional header for headerless input (P3), reindex to the
    model's feature list with 0 for absent columns (P4), transform, then
    Prediction, Prob_Pos (half-even, 4 places) and Risk_Level (X6) added to
    the input columns."""
    from ..operators.cohort import assign_positional
    df = raw
    if all(c.startswith("_c") and c[2:].isdigit() for c in df.columns):
        df = assign_positional(df, features)
    inputs = df.columns
    x = df.select(*inputs, *[F.lit(fill).cast("double").alias(c) for c in features if c not in inputs])
    s = model.transform(x)
    prob = rules.round_prob(positive_probability(s))
    out = s.select(*inputs, F.col("prediction").cast("int").alias("Prediction"), prob.alias("Prob_Pos"))
    return out.withColumn("Risk_Level", rules.risk_band("Prob_Pos"))


def records_from_scores(scored: DataFrame, user_col: str, model_type: str) -> DataFrame:
    """Every scored row becomes a ``records`` row (the source
    stores row 0 only)."""
    from ..functions.scalars import type_tag
    return scored.select(F.col(user_col).alias("user_id"),
                         type_tag(F.lit(model_type)).alias("consultation_type"),
                         F.col("Prob_Pos").alias("health_score"),
                         F.lit("See results page for details.").alias("recommendation"))


def top_contributions(model: PipelineModel, df: DataFrame, pre: Preprocessor, key: str, n: int = 10) -> DataFrame:
    """Per row, the ``n`` features with the largest |coef * x| of a
    linear model (x = the standardised model input), with the direction.
    Sorting is inside each row's array (no shuffle, no window)."""
    lr = model.stages[-1]
    coefs = lr.coefficients.toArray().tolist()
    names = pre.feature_names
    s = model.transform(df)
    x = vector_to_array("features")
    items = F.array(*[F.struct(F.lit(nm).alias("feature"), (x[i] * F.lit(float(coefs[i]))).alias("contribution"))
                      for i, nm in enumerate(names)])
    ranked = F.slice(F.array_sort(items, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1)
                                  .when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1)
                                  .otherwise(F.when(a["feature"] < b["feature"], -1)
                                             .when(a["feature"] > b["feature"], 1).otherwise(0))), 1, n)
    out = s.select(key, F.posexplode(ranked).alias("rank0", "c"))
    return out.select(key, (F.col("rank0") + 1).alias("rank"), F.col("c.feature").alias("feature"),
                      F.col("c.contribution").alias("contribution"),
                      F.when(F.col("c.contribution") >= 0, "raises").otherwise("lowers").alias("direction"))


def save_model(model: PipelineModel | ForestPipeline, path: str) -> str:
    """Spark ML writer (overwrite)."""
    if isinstance(model, ForestPipeline):
        model.save(path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | ForestPipeline:
    return load_forest_pipeline(SparkSession.active(), path) or PipelineModel.load(path)

