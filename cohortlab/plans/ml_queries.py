"""Machine-learning queries. Preprocessing keys are SQL-checked; model fits
are rows-only (different solvers than the source's, so only shapes and
floors are asserted in tests)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import rules, scalars
from ..ml import boosting as B
from ..ml import forest as FO
from ..ml import kernel_svm as KS
from ..ml import models as ML
from ..ml import preprocess as PP
from ..ml import table_forest as TF
from ..operators import cohort as co
from ..session import drop_path, scratch_path
from ..sources.tables import checkpoint_table
from . import oracle as O
from .cohort_queries import cohort, labelled
from .metric_queries import SPLIT_CTE
from .registry import query

Y = C.TARGET_COL
IMPUTE_COLS = C.CLINICAL_FEATURES + ["BMXBMI", "BMXWAIST"]


def _median_sql(c):
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM cohort)"


@query("impute_median", O.with_cohort("SELECT SEQN, " + ", ".join(
    f"round_even(coalesce(CAST({c} AS DOUBLE), {_median_sql(c)}), 6) AS {c}" for c in IMPUTE_COLS) + " FROM cohort"))
def impute_median(spark, sf):
    """M2: missing values replaced by the exact column median."""
    d = PP.impute_median(checkpoint_table(cohort(spark, sf).select(C.ID_COL, *IMPUTE_COLS), "impute_in"),
                         IMPUTE_COLS)
    return d.select(C.ID_COL, *[F.bround(c, 6).alias(c) for c in IMPUTE_COLS])


DIQ_CASE = "CASE CAST(DIQ010 AS INTEGER) " + " ".join(
    "WHEN {} THEN '{}'".format(code, label.replace("'", "''")) for code, label in C.DIABETES_CODES) + " END"


@query("impute_constant", O.with_cohort(
    f"SELECT SEQN, coalesce({DIQ_CASE}, 'missing') AS DIQ010_label FROM cohort"))
def impute_constant(spark, sf):
    """Decoded diabetes answer with 'missing' for absent answers."""
    d = scalars.decode_answers(cohort(spark, sf).select(C.ID_COL, "DIQ010"), ["DIQ010"])
    return PP.impute_constant(d, ["DIQ010_label"]).select(C.ID_COL, "DIQ010_label")


def _std_sql(c):
    v = f"coalesce(CAST({c} AS DOUBLE), {_median_sql(c)})"
    return (f"round_even(({v} - avg({v}) OVER ()) / CASE WHEN coalesce(stddev_pop({v}) OVER (), 0) = 0 THEN 1 "
            f"ELSE stddev_pop({v}) OVER () END, 6) AS {c}")


@query("standardise", O.with_cohort("SELECT SEQN, " + ", ".join(_std_sql(c) for c in IMPUTE_COLS) + " FROM cohort"))
def standardise(spark, sf):
    """M4: median-imputed values scaled to mean 0, population deviation 1."""
    d = PP.standardise(checkpoint_table(cohort(spark, sf).select(C.ID_COL, *IMPUTE_COLS), "standardise_in"),
                       IMPUTE_COLS)
    return d.select(C.ID_COL, *[F.bround(c, 6).alias(c) for c in IMPUTE_COLS])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # market segment domain


@query("one_hot", O.with_cohort("SELECT SEQN, " + ", ".join(
    f"CASE WHEN coalesce(SEGMENT, 'missing') = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS SEGMENT_{s}" for s in SEGMENTS[1:])
    + " FROM cohort"))
def one_hot(spark, sf):
    """M5: drop-first one-hot of the segment category (sorted categories)."""
    d = PP.one_hot(cohort(spark, sf).select(C.ID_COL, "SEGMENT"), "SEGMENT")
    return d.drop("SEGMENT")


def combined(spark, sf):
    """Combined feature set, written once to the shared folder: every model
    fit reads it several times (medians, moments, categories, iterations)."""
    lab = labelled(spark, sf)
    clin = co.feature_set(lab, C.CLINICAL_FEATURES)
    gen = co.feature_set(lab, C.GENERAL_FEATURES + ["SEGMENT"])
    return checkpoint_table(co.combine_features(clin, gen), "combined_features")


def clinical(spark, sf):
    return checkpoint_table(co.feature_set(labelled(spark, sf), C.CLINICAL_FEATURES), "clinical_features")


COMBINED = C.CLINICAL_FEATURES + C.GENERAL_FEATURES + ["SEGMENT"]


@query("assemble")
def assemble(spark, sf):
    """M1/M6: fitted preprocessor applied; the assembled vector as an array."""
    df = combined(spark, sf)
    num, cat = PP.split_types(df, COMBINED, C.ID_COL)
    pre = PP.fit_preprocessor(df, num, cat)
    return pre.transform(df).select(C.ID_COL, vector_to_array("features").alias("features"))


def _assembled_sql() -> str:
    numeric = [c for c in COMBINED if c != "SEGMENT"]
    parts = []
    for i, c in enumerate(numeric):
        v = f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM labelled))"
        parts.append(f"SELECT SEQN, {i} AS place, '{c}' AS feature, round_even(({v} - avg({v}) OVER ()) / CASE WHEN coalesce("
                     f"stddev_pop({v}) OVER (), 0) = 0 THEN 1 ELSE stddev_pop({v}) OVER () END, 6) AS value FROM labelled")
    for k, x in enumerate(SEGMENTS[1:], len(numeric)):
        parts.append(f"SELECT SEQN, {k}, 'SEGMENT={x}', CASE WHEN coalesce(SEGMENT, 'missing') = '{x}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
                     "FROM labelled")
    return O.with_cohort("\nUNION ALL ".join(parts))


@query("assembled_values", _assembled_sql())
def assembled_values(spark, sf):
    """M1-M6: every value of the assembled vector, by place and feature name."""
    df = combined(spark, sf)
    num, cat = PP.split_types(df, COMBINED, C.ID_COL)
    pre = PP.fit_preprocessor(df, num, cat)
    x = pre.transform(df).select(C.ID_COL, F.posexplode(vector_to_array("features")).alias("place", "value"))
    names = F.array(*map(F.lit, pre.feature_names))
    return x.select(C.ID_COL, "place", F.get(names, F.col("place")).alias("feature"), F.bround("value", 6).alias("value"))


MODEL_SETS = {"clinical": C.CLINICAL_FEATURES, "general": C.GENERAL_FEATURES, "combined": C.CLINICAL_FEATURES + C.GENERAL_FEATURES}


@query("saved_models", O.with_cohort("\nUNION ALL ".join(
    f"SELECT '{k}' AS dataset, count(*) AS n_rows, count(*) AS n_same FROM labelled" for k in MODEL_SETS)))
def saved_models(spark, sf):
    """For each of the three feature sets, preprocessor and random forest
    fitted on all rows, saved as one model and loaded; rows that both answer alike."""
    lab = ML.prepare(checkpoint_table(labelled(spark, sf), "labelled_cohort"), [])
    out = None
    for name, features in MODEL_SETS.items():
        df = lab.select(C.ID_COL, Y, ML.LABEL, *features)
        num, cat = PP.split_types(df, features, C.ID_COL)
        model = ML.fit_model(ML.ModelSpec("Random Forest"), df, PP.fit_preprocessor(df, num, cat))
        path = ML.save_model(model, scratch_path(spark, f"model_{name}"))
        back = ML.load_model(path)
        both = ML.predict(model, df, [C.ID_COL]).join(ML.predict(back, df, [C.ID_COL]).select(
            C.ID_COL, F.col("prediction").alias("p2"), F.col("prob").alias("q2")), C.ID_COL)
        one = both.agg(F.count("*").alias("n_rows"), F.count_if((F.col("prediction") == F.col("p2")) & (F.col("prob") == F.col("q2")))
                       .alias("n_same")).select(F.lit(name).alias("dataset"), "n_rows", "n_same")
        one = checkpoint_table(one, "saved_model_rows")  # a model's files go before the next one is fitted
        drop_path(spark, path)
        if isinstance(model, ML.ForestPipeline):
            drop_path(spark, model.forest.path)
        out = one if out is None else out.union(one)
    return out


def _train(spark, sf, name):
    from ..operators import metrics as M
    df = ML.prepare(M.stratified_split(combined(spark, sf), Y, C.ID_COL), COMBINED)
    train, test = df.where("is_test = 0"), df.where("is_test = 1")
    num, cat = PP.split_types(df, COMBINED, C.ID_COL)
    pre = PP.fit_preprocessor(train, num, cat)
    model = ML.fit_model(ML.ModelSpec(name), train, pre)
    return ML.predict(model, test, [C.ID_COL, Y])


@query("train_lr")
def train_lr(spark, sf):
    """Logistic regression on the combined set; test predictions."""
    return _train(spark, sf, "Logistic Regression")


@query("train_rf")
def train_rf(spark, sf):
    """Random forest (100 trees) on the combined set; test predictions."""
    return _train(spark, sf, "Random Forest")


@query("train_gbt")
def train_gbt(spark, sf):
    """Boosted trees (100 rounds) on the combined set; test predictions."""
    return _train(spark, sf, "Boosted Trees")


@query("train_svm")
def train_svm(spark, sf):
    """Linear SVM with Platt probabilities; test predictions."""
    return _train(spark, sf, "Linear SVM")


@query("model_comparison")
def model_comparison(spark, sf):
    """4 models x 3 feature sets, one metrics row each."""
    lab = checkpoint_table(labelled(spark, sf), "labelled_cohort")
    sets = {"Clinical": C.CLINICAL_FEATURES, "General": C.GENERAL_FEATURES,
            "Combined": C.CLINICAL_FEATURES + C.GENERAL_FEATURES}
    return ML.train_and_evaluate(lab, sets, [ML.ModelSpec(n) for n in C.MODEL_NAMES])


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """Best-family model refit on all clinical rows, saved, loaded;
    predictions of both side by side."""
    df = ML.prepare(clinical(spark, sf), C.CLINICAL_FEATURES)
    num, cat = PP.split_types(df, C.CLINICAL_FEATURES, C.ID_COL)
    pre = PP.fit_preprocessor(df, num, cat)
    model = ML.fit_model(ML.ModelSpec("Random Forest"), df, pre)
    path = ML.save_model(model, scratch_path(spark, "model_clinical"))
    back = ML.load_model(path)
    a = ML.predict(model, df, [C.ID_COL]).withColumnRenamed("prob", "prob_fitted") \
        .withColumnRenamed("prediction", "pred_fitted")
    b = ML.predict(back, df, [C.ID_COL]).withColumnRenamed("prob", "prob_loaded") \
        .withColumnRenamed("prediction", "pred_loaded")
    return a.join(b, C.ID_COL)


@query("model_roundtrip_same", O.with_cohort(f"SELECT {C.ID_COL}, true AS same FROM labelled"))
def model_roundtrip_same(spark, sf):
    """For every row, that the loaded model answers as the fitted one."""
    r = model_roundtrip(spark, sf)
    return r.select(C.ID_COL, ((F.col("pred_fitted") == F.col("pred_loaded"))
                               & (F.col("prob_fitted") == F.col("prob_loaded"))).alias("same"))


@query("grid_search")
def grid_search(spark, sf):
    """The 24 random-forest settings on the clinical set, stratified
    5-fold CV, best setting's exact held-out AUC."""
    g = ML.grid_search(clinical(spark, sf), C.CLINICAL_FEATURES)
    return g.cv.withColumn("best_test_auc", F.lit(g.test_auc))


@query("grid_search_scored", O.with_cohort(SPLIT_CTE + f""",
dealt AS (SELECT {Y}, CAST((rnk - 1) % {C.CV_FOLDS} AS INTEGER) AS fold FROM (
  SELECT {Y}, row_number() OVER (PARTITION BY {Y} ORDER BY md5(CAST(SEQN AS VARCHAR) || ':{C.SEED}'), SEQN) AS rnk FROM split WHERE is_test = 0))
SELECT num_trees, max_depth, min_split, min_leaf, fold, count(*) AS n_rows, CAST(sum({Y}) AS BIGINT) AS n_positive, true AS probabilities
FROM dealt, unnest([100, 200]) a(num_trees), unnest([30, 10, 20]) b(max_depth), unnest([2, 5]) c(min_split), unnest([1, 2]) d(min_leaf)
GROUP BY ALL"""))
def grid_search_scored(spark, sf):
    """For every setting and fold, the held-out rows and positives that it
    scored, and whether every score is a probability."""
    g = ML.grid_search(clinical(spark, sf), C.CLINICAL_FEATURES)
    each = g.scored.groupBy("setting", "fold").agg(
        F.count("*").alias("n_rows"), F.sum(Y).cast("long").alias("n_positive"),
        F.min((F.col("prob") >= 0) & (F.col("prob") <= 1)).alias("probabilities"))
    names = spark.createDataFrame([(i, s.trees, s.depth, s.split, leaf) for i, (s, leaf) in enumerate(g.settings)],
                                  "setting int, num_trees int, max_depth int, min_split int, min_leaf int")
    return each.join(names, "setting").drop("setting")


def _serving_model(spark, sf, whole=False):
    df = ML.prepare(clinical(spark, sf), C.CLINICAL_FEATURES)
    num, cat = PP.split_types(df, C.CLINICAL_FEATURES, C.ID_COL)
    pre = PP.fit_preprocessor(df, num, cat)
    return ML.fit_model(ML.ModelSpec("Random Forest"), df, pre, whole=whole), pre


@query("score_batch")
def score_batch(spark, sf):
    """Batch scoring of every cohort row with the clinical model:
    inputs kept, Prediction, Prob_Pos (4 places) and Risk_Level added."""
    model, _ = _serving_model(spark, sf)
    rows = cohort(spark, sf).select(C.ID_COL, *C.CLINICAL_FEATURES)
    return ML.score_batch(model, rows, C.CLINICAL_FEATURES)


@query("records_from_scores")
def records_from_scores(spark, sf):
    """Every scored row turned into a records row."""
    model, _ = _serving_model(spark, sf)
    s = ML.score_batch(model, cohort(spark, sf).select(C.ID_COL, *C.CLINICAL_FEATURES), C.CLINICAL_FEATURES)
    return ML.records_from_scores(s, C.ID_COL, "clinical")


@query("top_contributions")
def top_contributions(spark, sf):
    """Ten largest |coefficient x standardised input| per row for the
    logistic model on the combined set."""
    df = ML.prepare(combined(spark, sf), COMBINED)
    num, cat = PP.split_types(df, COMBINED, C.ID_COL)
    pre = PP.fit_preprocessor(df, num, cat)
    model = ML.fit_model(ML.ModelSpec("Logistic Regression"), df, pre)
    return ML.top_contributions(model, df, pre, C.ID_COL, 10)


@query("score_batch_consistent", O.with_cohort(
    f"SELECT {C.ID_COL}, true AS places_ok, true AS band_ok FROM cohort"))
def score_batch_consistent(spark, sf):
    """Every row scored, four places, and the band that its
    probability calls for."""
    s = score_batch(spark, sf)
    p = F.col("Prob_Pos")
    band = F.when(p > C.RISK_HIGH, "High").when(p > C.RISK_MEDIUM, "Medium").otherwise("Low")
    return s.select(C.ID_COL, ((p >= 0) & (p <= 1) & (F.bround(p, 4) == p)).alias("places_ok"),
                    (F.col("Risk_Level") == band).alias("band_ok"))


@query("top_contributions_consistent", O.with_cohort(
    f"SELECT {C.ID_COL}, unnest(range(1, 11))::INTEGER AS rank, true AS sign_ok, true AS order_ok FROM labelled"))
def top_contributions_consistent(spark, sf):
    """Ten ranked rows for each key, sizes never growing with the rank,
    directions as the signs say."""
    t = top_contributions(spark, sf)
    size = F.abs("contribution")
    before = F.lag(size).over(Window.partitionBy(C.ID_COL).orderBy("rank"))  # ten rows each
    return t.select(C.ID_COL, F.col("rank").cast("int").alias("rank"),
                    ((F.col("contribution") >= 0) == (F.col("direction") == "raises")).alias("sign_ok"),
                    F.coalesce(before >= size, F.lit(True)).alias("order_ok"))


@query("records_of_scored_rows", O.with_ops("""SELECT id AS user_id, 'liver_clinical' AS consultation_type,
  round_even(health_score, 4) AS health_score, 'See results page for details.' AS recommendation FROM records"""))
def records_of_scored_rows(spark, sf):
    """A scored table (the records' scores as its probabilities) as records rows."""
    from ..sources import standins as S
    scored = S.records(spark, sf).select("id", rules.round_prob("health_score").alias("Prob_Pos"))
    return ML.records_from_scores(scored, "id", "clinical")


# ---------------------------------------------------------------- boosting

FIRST_SPLITS = B.BoostSpec(bins=16, child_weight=1.0)


def _boost_sql() -> str:
    """Every cut of the first tree's root: at probability 1/2 a row's gradient is
    1/2 - y and its Hessian 1/4; missing rows go to the better side."""
    probs = [k / FIRST_SPLITS.bins for k in range(1, FIRST_SPLITS.bins)]
    cuts = "\nUNION ALL ".join(
        f"SELECT {i} AS feature, list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), {probs}))) AS cuts FROM labelled"
        for i, c in enumerate(C.CLINICAL_FEATURES))
    rows = "\nUNION ALL ".join(f"SELECT {i} AS feature, CAST({c} AS DOUBLE) AS x, {Y} AS y FROM labelled"
                               for i, c in enumerate(C.CLINICAL_FEATURES))
    names = "[" + ", ".join(f"'{c}'" for c in C.CLINICAL_FEATURES) + "]"
    score = "({g}) * ({g}) / (({h}) + 1.0)"
    left, right = (score.format(g=f"gl + {m} * gm", h=f"hl + {m} * hm") + " + "
                   + score.format(g=f"g - gl - {m} * gm", h=f"h - hl - {m} * hm") for m in (1, 0))
    ok = "(hl + {m} * hm >= 1 AND h - hl - {m} * hm >= 1)"
    return O.with_cohort(f""",
cut AS ({cuts}),
val AS ({rows}),
binned AS (SELECT v.feature, y, CASE WHEN x IS NOT NULL THEN len(list_filter(cuts, lambda c: c < x)) END AS bin
  FROM val v JOIN cut USING (feature)),
hist AS (SELECT feature, bin, sum(0.5 - y) AS g, 0.25 * count(*) AS h FROM binned GROUP BY feature, bin),
tot AS (SELECT feature, sum(g) AS g, sum(h) AS h, coalesce(sum(g) FILTER (WHERE bin IS NULL), 0) AS gm,
  coalesce(sum(h) FILTER (WHERE bin IS NULL), 0) AS hm FROM hist GROUP BY feature),
run AS (SELECT feature, bin, sum(g) OVER o AS gl, sum(h) OVER o AS hl FROM hist WHERE bin IS NOT NULL
  WINDOW o AS (PARTITION BY feature ORDER BY bin)),
both_sides AS (SELECT feature, bin, CASE WHEN {ok.format(m=1)} THEN {left} - {score.format(g='g', h='h')} END AS a,
  CASE WHEN {ok.format(m=0)} THEN {right} - {score.format(g='g', h='h')} END AS b, hm FROM run JOIN tot USING (feature))
SELECT {names}[feature + 1] AS feature, CAST(bin AS INTEGER) AS bin,
  round_even(CASE WHEN hm > 0 AND coalesce(a, -1) > coalesce(b, -1) THEN a ELSE b END, 6) AS gain FROM both_sides""")


@query("boost_first_splits", _boost_sql())
def boost_first_splits(spark, sf):
    """The gain of every cut of the first tree's root, on raw clinical
    features with their missing values, 16 quantile bins."""
    df = ML.prepare(clinical(spark, sf), C.CLINICAL_FEATURES)
    cuts = B.fit_cuts(df, C.CLINICAL_FEATURES, FIRST_SPLITS.bins, exact=True)
    data = checkpoint_table(B.binned(df, C.CLINICAL_FEATURES, ML.LABEL, cuts), "boost_rows")
    sums = B.histogram(data, [], B.Tree.empty(1), 0, len(C.CLINICAL_FEATURES), data.rdd.getNumPartitions()).where("node >= 0")
    name = F.get(F.array(*map(F.lit, C.CLINICAL_FEATURES)), F.col("feature"))
    return B.gains(sums, FIRST_SPLITS).select(name.alias("feature"), "bin", F.bround("gain", 6).alias("gain"))


def _prepared(spark, sf):
    """Train and test rows of the combined set with the model inputs as columns f0, f1, ... and as an array x."""
    from ..operators import metrics as M
    df = ML.prepare(M.stratified_split(combined(spark, sf), Y, C.ID_COL), COMBINED)
    num, cat = PP.split_types(df, COMBINED, C.ID_COL)
    pre = PP.fit_preprocessor(df.where("is_test = 0"), num, cat)
    x = vector_to_array("features")
    names = [f"f{i}" for i in range(len(pre.feature_names))]
    rows = pre.transform(df).select(C.ID_COL, Y, ML.LABEL, "is_test", x.alias("x"), *[x[i].alias(c) for i, c in enumerate(names)])
    rows = checkpoint_table(rows, "model_inputs")
    return rows.where("is_test = 0"), rows.where("is_test = 1"), names


@query("train_boosted")
def train_boosted(spark, sf):
    """Second-order boosting (100 rounds of depth 6) on the combined set; test predictions."""
    train, test, names = _prepared(spark, sf)
    model = B.fit_boosting(train, names, ML.LABEL)
    s = B.score_boosted(test.select(C.ID_COL, Y, *names), model)
    return s.select(C.ID_COL, Y, (F.col("prob") > 0.5).cast("int").alias("prediction"), "prob")


BOOST_ROUNDS = 12


@query("boosted_losses", O.with_cohort(
    f"SELECT CAST(r AS INTEGER) AS round, count(*) AS n_rows, true AS lower FROM labelled, unnest(range(1, {BOOST_ROUNDS + 1})) t(r) GROUP BY r"))
def boosted_losses(spark, sf):
    """That every round lowers the log loss of the rows it learns from."""
    df = ML.prepare(clinical(spark, sf), C.CLINICAL_FEATURES)
    model = B.fit_boosting(df, C.CLINICAL_FEATURES, ML.LABEL, B.BoostSpec(rounds=BOOST_ROUNDS))
    rounds = spark.createDataFrame([(k, model.losses[k] < model.losses[k - 1]) for k in range(1, BOOST_ROUNDS + 1)],
                                   "round int, lower boolean")
    n = df.agg(F.count("*").alias("n_rows")).scalar()
    return rounds.select("round", n.alias("n_rows"), "lower")


# ---------------------------------------------------------------- kernel machine

@query("train_kernel_svm")
def train_kernel_svm(spark, sf):
    """Kernel machine with out-of-fold probabilities on the combined set; test predictions."""
    train, test, _ = _prepared(spark, sf)
    model = KS.fit_kernel_svm(train, "x", ML.LABEL, C.ID_COL)
    s = KS.score_kernel_svm(test.select(C.ID_COL, Y, "x"), model, "x")
    return s.select(C.ID_COL, Y, (F.col("margin") > 0).cast("int").alias("prediction"), "prob")


# ---------------------------------------------------------------- contributions of forests

def _forest_contributions(spark, sf):
    """Clinical rows with the served forest's contributions, probability and base value."""
    model, pre = _serving_model(spark, sf, whole=len(C.CLINICAL_FEATURES) > TF.KNOWN)
    x = model.transform(ML.prepare(clinical(spark, sf), C.CLINICAL_FEATURES)).select(
        C.ID_COL, vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("prob"))
    forest = model.stages[-1]
    if isinstance(forest, TF.TableForest):
        out, base = forest.contributions(x, "x")
    else:
        out, base = FO.contributions(x, "x", FO.load_forest(forest, spark), len(pre.feature_names))
    return out, base, pre.feature_names


@query("forest_contributions")
def forest_contributions(spark, sf):
    """Per row the five largest contributions to the served forest's probability."""
    out, _, names = _forest_contributions(spark, sf)
    return FO.ranked(out, C.ID_COL, names, 5)


@query("forest_contributions_add_up", O.with_cohort(f"SELECT {C.ID_COL}, true AS adds_up FROM labelled"))
def forest_contributions_add_up(spark, sf):
    """For every row, that base value and contributions make the probability."""
    out, base, _ = _forest_contributions(spark, sf)
    total = F.aggregate("contributions", F.lit(base), lambda a, v: a + v)
    return out.select(C.ID_COL, (F.abs(total - F.col("prob")) < 1e-9).alias("adds_up"))
