"""Unit-test-only operators of SURVEY §2 (no query key): P2, M1, M20, S4, S7."""

import logging

import pytest
from pyspark.sql import functions as F

from cohortlab.ml import models as ML
from cohortlab.ml import preprocess as PP
from cohortlab.operators import cohort as co
from cohortlab.session import scratch_path
from cohortlab.sources import tables as T


def test_present_features_and_require_target(spark, caplog):
    df = spark.createDataFrame([(1, 0, 2.0)], "SEQN long, LIVER_HIGH_RISK_PROFILE int, LBXGLU double")
    with caplog.at_level(logging.WARNING):
        assert co.present_features(df, ["LBXGLU", "LBXALT"]) == ["LBXGLU"]
    assert "LBXALT" in caplog.text
    with pytest.raises(ValueError):
        co.require_target(df.drop("LIVER_HIGH_RISK_PROFILE"))


def test_split_types_drops_id(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 3)], "SEQN long, x double, s string, k int")
    assert PP.split_types(df, ["SEQN", "x", "s", "k"], "SEQN") == (["x", "k"], ["s"])


def test_positive_probability_fallbacks(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T2

    def schema(name):
        return T2.StructType([T2.StructField(name, VectorUDT()), T2.StructField("prediction", T2.DoubleType())])
    a = spark.createDataFrame([(Vectors.dense([0.3, 0.7]), 1.0)], schema("probability"))
    b = spark.createDataFrame([(Vectors.dense([-2.0, 2.0]), 1.0)], schema("rawPrediction"))
    c = spark.createDataFrame([(1.0,)], "prediction double")
    assert a.select(ML.positive_probability(a)).first()[0] == 0.7
    assert abs(b.select(ML.positive_probability(b)).first()[0] - 0.8807970779778823) < 1e-12
    assert c.select(ML.positive_probability(c)).first()[0] == 1.0


def test_write_table_run_folders_and_guarded_update(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    base = scratch_path(spark, "wt")
    p1 = T.write_table(df, base, "csv", run_id="r1")
    p2 = T.write_table(df, base, "csv", run_id="r2")
    assert p1 != p2 and T.read_csv(spark, p1, schema=df.schema).count() == 2
    subs = spark.createDataFrame([(10, 1, "active"), (11, 2, "active")], "id long, user_id long, status string")
    upd = spark.createDataFrame([(10, 1), (10, 1), (11, 9)], "id long, user_id long")  # dup + wrong owner
    got = {r["id"]: r["status"] for r in T.apply_updates(subs, upd, "id", {"status": "cancelled"},
                                                          guard=["user_id"]).collect()}
    assert got == {10: "cancelled", 11: "active"}
