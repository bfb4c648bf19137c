"""Hand rows for the label rule, the condition ladder, risk bands and scalars."""

import math

from pyspark.sql import functions as F

from cohortlab import config as C
from cohortlab.functions import rules, scalars

NINE = dict(BMXBMI=22.0, LBXGLU=90.0, LBXGH=5.0, DIQ010=2, LBDHDD=60.0, LBXTLG=100.0,
            SMQ020=2, ALQ130=2, LBXPLTSI=250.0, RIAGENDR=1)
SCHEMA = ("BMXBMI double, LBXGLU double, LBXGH double, DIQ010 bigint, LBDHDD double, LBXTLG double, "
          "SMQ020 bigint, ALQ130 bigint, LBXPLTSI double, RIAGENDR bigint")


def _label(spark, rows):
    cols = SCHEMA.split(", ")
    names = [c.split()[0] for c in cols]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)
    return [r[C.TARGET_COL] for r in rules.label(df).collect()]


def test_label_hand_rows(spark):
    base = dict(NINE)
    r1 = dict(base, BMXBMI=31.0, SMQ020=1)            # metabolic + other
    r2 = dict(r1, LBXGH=None)                          # a required input missing
    r3 = dict(base, LBXPLTSI=149.0)                    # low platelets alone
    r4 = dict(base, LBXPLTSI=150.0)                    # boundary: not low
    r5 = dict(base, BMXBMI=31.0)                       # metabolic without lipid/other
    r6 = dict(r1, LBXGH=float("nan"))                  # NaN read as missing
    assert _label(spark, [r1, r2, r3, r4, r5]) == [1, 0, 1, 0, 0]
    # NaN and null give the same label once NaN is normalised at load
    from cohortlab.sources.tables import nan_to_null
    df = spark.createDataFrame([tuple(r6[c.split()[0]] for c in SCHEMA.split(", "))], SCHEMA)
    assert rules.label(nan_to_null(df)).first()[C.TARGET_COL] == 0


def test_label_components_null_is_false(spark):
    df = spark.createDataFrame([(None, None, None, None, None, None, None, None, None, None)], SCHEMA)
    parts = rules.label_components(df.columns)
    row = df.select(*[v.alias(k) for k, v in parts.items()]).first()
    assert row.asDict() == {"metabolic": False, "lipid": False, "other": False, "structural": False}


LADDER_SCHEMA = ("LBXALT string, LBXAST string, LBXPLTSI string, LBXGGT string, LBXBILI string, "
                 "BMXBMI string, LBXGLU string, LBXGH string, LBXTR string, ALQ130 string, DIQ010 string, "
                 "MCQ160E string")


def _ladder(spark, rows):
    names = [c.split()[0] for c in LADDER_SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], LADDER_SCHEMA)
    return [r["likely_condition"] for r in rules.likely_condition(df).orderBy(F.monotonically_increasing_id())
            .collect()]


def test_condition_ladder_one_row_per_rule(spark):
    normal = dict(LBXPLTSI="250")
    rows = [
        dict(normal, LBXALT="101", LBXAST="101"),
        dict(normal, BMXBMI="31", LBXALT="36", LBXAST="31"),
        dict(normal, ALQ130=" Yes ", LBXGGT="101"),
        dict(LBXPLTSI="149", BMXBMI="26"),
        dict(normal, LBXBILI="3.1"),
        dict(normal, BMXBMI="36"),
        dict(normal, BMXBMI="24", LBXGLU="99", LBXGH="5.6"),
        dict(),
    ]
    got = _ladder(spark, rows)
    assert got == [t for _, t in C.CONDITIONS]


def test_suggestions_lists(spark):
    df = spark.createDataFrame([("Generalized Liver Risk",), ("nope",)], "c string")
    got = df.select(rules.suggestions_for(F.col("c")).alias("s")).collect()
    assert got[0]["s"] == C.SUGGESTIONS["Generalized Liver Risk"]
    assert got[1]["s"] is None


def test_risk_bands_boundaries(spark):
    df = spark.createDataFrame([(0.66,), (0.6601,), (0.33,), (0.3301,), (float("nan"),), (None,)], "p double")
    got = [r["r"] for r in df.select(rules.risk_band(rules.round_prob("p")).alias("r")).collect()]
    assert got == ["Medium", "High", "Low", "Medium", "Low", "Low"]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.12345,), (0.12355,)], "p double")
    got = [r["r"] for r in df.select(rules.round_prob("p").alias("r")).collect()]
    import numpy as np
    assert got == [float(np.round(0.12345, 4)), float(np.round(0.12355, 4))]  # numpy's half-even


def test_scalars(spark):
    df = spark.createDataFrame([("19.99", " Yes ", "liver_general"), ("x", None, "GENERAL"),
                                ("nan", "1", "kidney_lifestyle")], "price string, flag string, kind string")
    got = df.select(scalars.minor_units("price").alias("m"), scalars.to_float("price").alias("f"),
                    scalars.text_flag("flag").alias("t"), scalars.alias_map("kind").alias("a")).collect()
    assert [r["m"] for r in got] == [1998, None, None]
    assert got[0]["f"] == 19.99 and got[1]["f"] is None and got[2]["f"] is None
    assert [r["t"] for r in got] == ["yes", "", "1"]
    assert [r["a"] for r in got] == ["lifestyle", "lifestyle", "clinical"]


def test_text_flag_integral_double(spark):
    df = spark.createDataFrame([(1.0,), (2.5,)], "v double")
    got = [r["t"] for r in df.select(scalars.text_flag("v").alias("t")).collect()]
    strict = [r["t"] for r in df.select(scalars.text_flag("v", strict_text=True).alias("t")).collect()]
    assert got == ["1", "2.5"] and strict == ["1.0", "2.5"]


def test_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    got = [r["s"] for r in df.select(scalars.sigmoid("x").alias("s")).collect()]
    assert got[0] == 0.5 and math.isclose(got[1], 1 / (1 + math.exp(-2)))
