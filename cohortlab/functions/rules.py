"""Rule expressions: cohort label (P6), condition ladder (X4/X5), risk bands
(X6-X8) and record-type buckets (X9).

Null semantics. The survey data marks missing values as NaN and the source
rules compare with NaN -> False. We normalise NaN to null at load, and:

* the label and its components are built from AND/OR only (no NOT), so
  ``coalesce(rule, false)`` equals evaluating every null atom as False;
* the ladder uses explicit ``isNull``/``isNotNull`` where the source tests
  missingness, and wraps every other test with ``coalesce(.., false)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .scalars import text_flag, to_float


def _f(c) -> Column:
    return F.coalesce(c, F.lit(False))


def _any(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _all(cols) -> Column:
    return reduce(lambda a, b: a & b, cols)


def _col_or(df_cols, name: str, default):
    """Column if present, else a literal default (P5)."""
    if name in df_cols:
        return F.col(name)
    return F.lit(default)


# ------------------------------------------------------------------ P6 label

def label_components(df_cols: list[str], t: C.LabelThresholds = C.LabelThresholds()) -> dict:
    """The four boolean parts of the label rule, nulls read as False.

    Absent columns take the source's neutral defaults (0 for "greater than"
    tests, 999/1000 for "less than" tests), which make their atom False.
    """
    g = lambda n, d: _col_or(df_cols, n, d)
    metabolic = _any([g(t.bmi, 0) > t.high_bmi, g(t.glucose, 0) > t.high_glucose,
                      g(t.hba1c, 0) > t.high_hba1c, g(t.diabetes, 0) == t.is_diabetic])
    sex = g(t.sex, None)
    lipid = _any([(sex == t.male) & (g(t.hdl, 999) < t.low_hdl_male),
                  (sex == t.female) & (g(t.hdl, 999) < t.low_hdl_female),
                  g(t.trigs, 0) > t.high_trigs])
    other = _any([g(t.smoker, 0) == t.is_smoker, g(t.alcohol, 0) == t.heavy_alcohol])
    structural = g(t.platelets, 1000) < t.low_platelets
    return {"metabolic": _f(metabolic), "lipid": _f(lipid), "other": _f(other),
            "structural": _f(structural)}


def all_present(cols: list[str], df_cols: list[str] | None = None) -> Column:
    """Every listed column non-null (an absent column counts as missing)."""
    parts = [F.col(c).isNotNull() if (df_cols is None or c in df_cols) else F.lit(False) for c in cols]
    return _all(parts)


def label_rule(df_cols: list[str], t: C.LabelThresholds = C.LabelThresholds()) -> Column:
    """(metabolic AND (lipid OR other)) OR structural, AND all inputs present."""
    p = label_components(df_cols, t)
    rule = (p["metabolic"] & (p["lipid"] | p["other"])) | p["structural"]
    return rule & all_present(list(t.required), df_cols)


def label(df: DataFrame, target: str = C.TARGET_COL,
          t: C.LabelThresholds = C.LabelThresholds()) -> DataFrame:
    """Add the 0/1 target column (default 0)."""
    return df.withColumn(target, F.when(label_rule(df.columns, t), F.lit(1)).otherwise(F.lit(0)))


# --------------------------------------------------------- X4 condition ladder

def ladder_inputs(df: DataFrame, strict_text: bool = False) -> dict:
    """Ladder arguments as columns; absent columns get the caller's defaults.

    Numbers go through the tolerant to-float (X1), flags through X2.
    """
    out = {}
    for arg, col, default in C.LADDER_INPUTS:
        src = _col_or(df.columns, col, default)
        if arg in ("diabetes", "hypertension", "smoking", "alcohol", "family_history"):
            out[arg] = text_flag(src if col in df.columns else F.lit(None).cast("string"),
                                 strict_text=strict_text)
        else:
            out[arg] = to_float(src)
    return out


def condition_rule_number(v: dict) -> Column:
    """First matching rule number (1-8) over normalised ladder inputs."""
    bmi, alt, ast, plt = v["bmi"], v["alt"], v["ast"], v["platelets"]
    ggt, bili, glu, hba1c, trig = v["ggt"], v["bilirubin"], v["glucose"], v["hba1c"], v["triglycerides"]
    r1 = _f(alt > 100) & _f(ast > 100)
    r2 = _f((bmi > 30) | (glu > 140) | (hba1c > 6.5) | (trig > 200)) & _f(alt > 35) & _f(ast > 30)
    r3 = v["alcohol"].isin(C.ALCOHOL_YES) & _f(ggt > 100)
    r4 = _f(plt < 150) & (_f(bmi > 25) | v["diabetes"].isin(C.HISTORY_YES)
                          | v["family_history"].isin(C.HISTORY_YES))
    r5 = _f(bili > 3.0) & alt.isNull()
    r6 = _f((bmi > 35) | (glu > 200) | (hba1c > 8.0))
    r7 = ((alt.isNull() | _f(alt <= 40)) & (ast.isNull() | _f(ast <= 35))
          & (ggt.isNull() | _f(ggt <= 60)) & (bili.isNull() | _f(bili <= 1.2))
          & _f(bmi < 25) & _f(glu < 100) & _f(hba1c < 5.7))
    return (F.when(r1, 1).when(r2, 2).when(r3, 3).when(r4, 4).when(r5, 5)
             .when(r6, 6).when(r7, 7).otherwise(8))


def condition_text(rule_no: Column) -> Column:
    m = F.create_map(*[F.lit(x) for n, text in C.CONDITIONS for x in (n, text)])
    return F.element_at(m, rule_no)


def suggestions_for(condition: Column) -> Column:
    """The suggestion list for a condition (literal map of 8 entries)."""
    kv = []
    for text, items in C.SUGGESTIONS.items():
        kv += [F.lit(text), F.array(*[F.lit(s) for s in items])]
    return F.try_element_at(F.create_map(*kv), condition)


def likely_condition(df: DataFrame, strict_text: bool = False, with_suggestions: bool = True) -> DataFrame:
    """Add ``condition_rule``, ``likely_condition`` (+ ``suggestions``)."""
    v = ladder_inputs(df, strict_text)
    out = df.withColumn("condition_rule", condition_rule_number(v))
    out = out.withColumn("likely_condition", condition_text(F.col("condition_rule")))
    if with_suggestions:
        out = out.withColumn("suggestions", suggestions_for(F.col("likely_condition")))
    return out


# ---------------------------------------------------------------- X6-X8 bands

def round_prob(p) -> Column:
    """Half-even to 4 places (NaN -> null first)."""
    p = F.col(p) if isinstance(p, str) else p
    p = F.when(F.isnan(p), F.lit(None).cast("double")).otherwise(p)
    return F.bround(p, C.PROB_DECIMALS)


def risk_band(p) -> Column:
    """X6 on the rounded probability: >0.66 High, >0.33 Medium, else Low.

    Null (and NaN, normalised to null) gives Low, like NaN > x is False.
    """
    p = F.col(p) if isinstance(p, str) else p
    return F.when(_f(p > C.RISK_HIGH), "High").when(_f(p > C.RISK_MEDIUM), "Medium").otherwise("Low")


def result_text(pred) -> Column:
    pred = F.col(pred) if isinstance(pred, str) else pred
    return F.when(_f(pred == 1), C.RESULT_POSITIVE).otherwise(C.RESULT_NEGATIVE)


# --------------------------------------------------------------- X9 buckets

def type_bucket(c) -> Column:
    """Record type to Liver Clinical / Liver Lifestyle / Liver Other / Other."""
    lc = F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(C.UNKNOWN)))
    return (F.when(lc.contains(C.BUCKET_LIVER) & lc.contains(C.BUCKET_CLINICAL), C.BUCKET_NAMES["clinical"])
             .when(lc.contains(C.BUCKET_LIVER) & lc.contains(C.BUCKET_LIFESTYLE), C.BUCKET_NAMES["lifestyle"])
             .when(lc.contains(C.BUCKET_LIVER), C.BUCKET_NAMES["liver_other"])
             .otherwise(C.BUCKET_NAMES["other"]))
