"""Queries over the assembled cohort: sources, J1/J2, P*, labels, profiling,
scalar rules on cohort rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import rules, scalars
from ..operators import cohort as co
from ..operators import profile as pr
from ..session import scratch_path
from ..sources import standins, xport
from ..sources.tables import file_listing, load_module, read_csv, table_path, write_table
from . import oracle as O
from .registry import query

MODULE_ORDER = list(C.MODULE_COLUMNS)
MODULE_CTE = {"DEMO": "demo", "BMX": "bmx", "SMQ": "smq", "ALQ": "alq", "DIQ": "diq", "BPQ": "bpq",
              "MCQ": "mcq", "CBC": "cbc", "GLU": "glu", "GHB": "ghb", "HDL": "hdl", "TCHOL": "tch",
              "TRIGLY": "tri"}


BUCKET_BYTES = 128 << 20


def module_buckets(spark, sf_dir) -> int:
    """Bucket count for the module tables: about ``BUCKET_BYTES`` of the tables
    that the modules come from in each, the shuffle width at least."""
    size = sum(int(f.rsplit(":", 2)[1]) for t in ("customer", "orders", "lineitem")
               for f in file_listing(spark, table_path(sf_dir, t)))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def cohort(spark, sf_dir, strategy: str | None = None, bucketed: bool = True):
    """The cohort as the queries use it: the left-join chain over module
    tables bucketed by SEQN (co-partitioned: no exchange; 3x faster than
    the plain files at sf0.1), or with ``bucketed=False`` over the plain
    module files. (``strategy="union"`` gives the single-shuffle form;
    measured 2x slower at sf0.01-0.1.)"""
    mods = standins.survey_modules(spark, sf_dir, buckets=module_buckets(spark, sf_dir) if bucketed else None)
    return co.build_cohort(mods, validate=strategy)


def labelled(spark, sf_dir):
    return rules.label(cohort(spark, sf_dir))


# ---------------------------------------------------------------- sources

@query("load_modules", O.with_cohort(" UNION ALL ".join(
    f"SELECT '{m}' AS module, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for m, t in MODULE_CTE.items())))
def load_modules(spark, sf_dir):
    """Row count of every loaded survey module."""
    mods = standins.survey_modules(spark, sf_dir)
    out = None
    for name, df in mods.items():
        if df is None:
            continue
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("module"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("xport_modules", O.with_cohort("SELECT * FROM cohort"))
def xport_modules(spark, sf_dir):
    """Every module written as SAS transport files, loaded from them and
    joined; numbers come back as doubles and are cast to the modules' types."""
    folder, mods, types = scratch_path(spark, "xport"), {}, {}
    xport.register(spark)
    for name, df in standins.survey_modules(spark, sf_dir).items():
        df.write.format("xport").mode("append").option("textWidth", 16).option("member", name).save(f"{folder}/{name}")
        mods[name] = load_module(spark, f"{folder}/{name}", "xport")
        types |= {f.name: f.dataType for f in df.schema.fields}
    out = co.build_cohort(mods)
    return out.select(*[F.col(c).cast(types[c]).alias(c) for c in out.columns])


CLIN_COLS = [C.ID_COL, C.TARGET_COL, *C.CLINICAL_FEATURES]


@query("csv_roundtrip", O.with_cohort(f"SELECT {', '.join(CLIN_COLS)} FROM labelled"))
def csv_roundtrip(spark, sf_dir):
    """Write the clinical set as CSV (header, unique run folder) under
    the shared folder and read it back with an explicit schema."""
    df = co.feature_set(labelled(spark, sf_dir), C.CLINICAL_FEATURES)
    schema = df.schema
    out = write_table(df, scratch_path(spark, "clinical_csv"), "csv", run_id=uuid.uuid4().hex[:8])
    return read_csv(spark, out, schema=schema)


POSITIONAL = list(zip(C.CLINICAL_FEATURES, C.SERVING_CLINICAL_FEATURES))


@query("positional_header", O.with_cohort(
    "SELECT " + ", ".join(f"{a} AS {b}" for a, b in POSITIONAL) + " FROM labelled"))
def positional_header(spark, sf_dir):
    """Headerless CSV; the first k columns take the serving names."""
    df = labelled(spark, sf_dir).select(*C.CLINICAL_FEATURES)
    path = scratch_path(spark, "headerless_csv")
    df.write.option("header", False).csv(path)
    schema = T.StructType([T.StructField(f"_c{i}", f.dataType, True) for i, f in enumerate(df.schema.fields)])
    raw = spark.read.option("header", False).schema(schema).csv(path)
    return co.assign_positional(raw, C.SERVING_CLINICAL_FEATURES)


# ------------------------------------------------------------ joins/labels

COHORT_COLS = ["SEQN", *C.SPINE_COLUMNS, "SEGMENT", *[c for m in MODULE_ORDER for c in C.MODULE_COLUMNS[m]]]


@query("cohort_build", O.with_cohort("SELECT * FROM cohort"))
def cohort_build(spark, sf_dir):
    """Spine left-joined with the 12 modules on SEQN (join chain over
    the plain module files)."""
    return cohort(spark, sf_dir, strategy=None, bucketed=False)


@query("cohort_build_bucketed", O.with_cohort("SELECT * FROM cohort"))
def cohort_build_bucketed(spark, sf_dir):
    """J1 over module tables bucketed by SEQN (same bucket count): the
    sort-merge chain reads co-partitioned buckets, no exchange at all."""
    return co.build_cohort(standins.survey_modules(spark, sf_dir, buckets=module_buckets(spark, sf_dir)))


@query("label_cohort", O.with_cohort("SELECT SEQN, LIVER_HIGH_RISK_PROFILE FROM labelled"))
def label_cohort(spark, sf_dir):
    """The rule-based 0/1 label per participant."""
    return labelled(spark, sf_dir).select(C.ID_COL, C.TARGET_COL)


@query("label_components", O.with_cohort(
    f"SELECT SEQN, CAST({O.METABOLIC} AS INTEGER) AS metabolic, CAST({O.LIPID} AS INTEGER) AS lipid, "
    f"CAST({O.OTHER} AS INTEGER) AS other, CAST({O.STRUCTURAL} AS INTEGER) AS structural FROM cohort"))
def label_components(spark, sf_dir):
    """P6a-d: the four rule parts, missing read as False, as 0/1."""
    df = cohort(spark, sf_dir)
    parts = rules.label_components(df.columns)
    return df.select(C.ID_COL, *[v.cast("int").alias(k) for k, v in parts.items()])


@query("complete_cases", O.with_cohort(
    f"SELECT SEQN, CASE WHEN {O.ALL_NINE} THEN 1 ELSE 0 END AS all_present FROM cohort"))
def complete_cases(spark, sf_dir):
    """All nine rule inputs present."""
    return co.complete_cases(cohort(spark, sf_dir), C.LABEL_REQUIRED).select(C.ID_COL, "all_present")


@query("feature_sets", O.with_cohort(f"SELECT {', '.join(CLIN_COLS)} FROM labelled"))
def feature_sets(spark, sf_dir):
    """The clinical training layout (key, target, 6 features)."""
    return co.feature_set(labelled(spark, sf_dir), C.CLINICAL_FEATURES)


@query("combined_features", O.with_cohort(
    "SELECT c.SEQN, c.LIVER_HIGH_RISK_PROFILE, " + ", ".join(f"c.{x}" for x in C.CLINICAL_FEATURES) + ", "
    + ", ".join(f"g.{x}" for x in C.GENERAL_FEATURES)
    + " FROM labelled c JOIN labelled g ON c.SEQN = g.SEQN"))
def combined_features(spark, sf_dir):
    """Clinical x general inner join on SEQN, label from the clinical side."""
    lab = labelled(spark, sf_dir)
    clin = co.feature_set(lab, C.CLINICAL_FEATURES)
    gen = co.feature_set(lab, C.GENERAL_FEATURES)
    return co.combine_features(clin, gen)


# ----------------------------------------------------------- distributions

@query("label_distribution", O.with_cohort(
    "SELECT LIVER_HIGH_RISK_PROFILE AS value, CAST(count(*) AS BIGINT) AS n FROM labelled "
    "WHERE LIVER_HIGH_RISK_PROFILE IS NOT NULL GROUP BY 1"))
def label_distribution(spark, sf_dir):
    """A2: label value counts (the flagship slice: modules -> J1 -> P6 -> A2)."""
    return pr.value_counts(labelled(spark, sf_dir), C.TARGET_COL)


@query("label_share", O.with_cohort(
    "SELECT value, n, round_even(n * 100.0 / sum(n) OVER (), 2) AS pct FROM ("
    "SELECT LIVER_HIGH_RISK_PROFILE AS value, CAST(count(*) AS BIGINT) AS n FROM labelled "
    "WHERE LIVER_HIGH_RISK_PROFILE IS NOT NULL GROUP BY 1)"))
def label_share(spark, sf_dir):
    """Label shares in percent, half-even to 2 places."""
    return pr.value_share(labelled(spark, sf_dir), C.TARGET_COL)


PROFILE_COLS = [c for c in COHORT_COLS if c != "SEGMENT"] + [C.TARGET_COL]


@query("null_counts", O.with_cohort(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM labelled"
    for c in [*COHORT_COLS, C.TARGET_COL])))
def null_counts(spark, sf_dir):
    """Nulls per column of the labelled cohort."""
    return pr.null_counts(labelled(spark, sf_dir), [*COHORT_COLS, C.TARGET_COL])


@query("missing_patterns", O.with_cohort(
    "SELECT " + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in C.LABEL_REQUIRED)
    + " AS pattern, CAST(count(*) AS BIGINT) AS n FROM cohort GROUP BY 1"))
def missing_patterns(spark, sf_dir):
    """Missingness pattern counts over the nine rule inputs."""
    return pr.missing_patterns(cohort(spark, sf_dir), C.LABEL_REQUIRED)


def _hist_sql(cols, bins=30):
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM cohort "
                              f"WHERE {c} IS NOT NULL" for c in cols)
    return O.with_cohort(f""", long AS ({long}),
st AS (SELECT "column", CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo0,
              CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi0
       FROM long GROUP BY 1),
b AS (SELECT l."column", CAST(least(floor((value - lo0) / (hi0 - lo0) * {bins}), {bins - 1}) AS INTEGER) AS bin, lo0, hi0
      FROM long l JOIN st USING ("column"))
SELECT "column", bin, round_even(lo0 + bin * ((hi0 - lo0) / {bins}), 6) AS lo,
       round_even(lo0 + (bin + 1) * ((hi0 - lo0) / {bins}), 6) AS hi, CAST(count(*) AS BIGINT) AS n
FROM b GROUP BY "column", bin, lo0, hi0""")


HIST_COLS = C.CLINICAL_FEATURES + ["BMXBMI", "BMXWAIST", "RIDAGEYR"]


@query("histograms", _hist_sql(HIST_COLS))
def histograms(spark, sf_dir):
    """30 equal-width bins per numeric column."""
    h = pr.histogram(cohort(spark, sf_dir), HIST_COLS, 30)
    return h.withColumns({"lo": F.bround("lo", 6), "hi": F.bround("hi", 6)})


def _box_sql(cols):
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM cohort "
                              f"WHERE {c} IS NOT NULL" for c in cols)
    return O.with_cohort(f""", long AS ({long}),
q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1),
j AS (SELECT l."column", value, q1, median, q3, q3 - q1 AS iqr FROM long l JOIN q USING ("column"))
SELECT "column", round_even(q1, 6) AS q1, round_even(median, 6) AS median, round_even(q3, 6) AS q3,
       round_even(iqr, 6) AS iqr,
       round_even(min(value) FILTER (WHERE value >= q1 - 1.5 * iqr AND value <= q3 + 1.5 * iqr), 6) AS whisker_lo,
       round_even(max(value) FILTER (WHERE value >= q1 - 1.5 * iqr AND value <= q3 + 1.5 * iqr), 6) AS whisker_hi,
       CAST(count(*) FILTER (WHERE NOT (value >= q1 - 1.5 * iqr AND value <= q3 + 1.5 * iqr)) AS BIGINT) AS outliers,
       CAST(count(*) AS BIGINT) AS n
FROM j GROUP BY "column", q1, median, q3, iqr""")


@query("box_summary", _box_sql(HIST_COLS))
def box_summary(spark, sf_dir):
    """A10: exact quartiles, 1.5 IQR whiskers and outlier counts."""
    b = pr.box_summary(cohort(spark, sf_dir), HIST_COLS)
    return b.select("column", *[F.bround(c, 6).alias(c) for c in
                                ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]], "outliers", "n")


CORR_COLS = C.CLINICAL_FEATURES + ["BMXBMI", "BMXWAIST", "RIDAGEYR", C.TARGET_COL]


def _corr_sql(cols):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            r = f"round_even(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {r} AS r FROM labelled")
            parts.append(f"SELECT '{b}' AS a, '{a}' AS b, {r} AS r FROM labelled")
        parts.append(f"SELECT '{a}' AS a, '{a}' AS b, 1.0::DOUBLE AS r")
    return O.with_cohort(" UNION ALL ".join(parts))


@query("corr_matrix", _corr_sql(CORR_COLS))
def corr_matrix(spark, sf_dir):
    """Pairwise-complete Pearson correlations (long form, mirrored)."""
    m = pr.corr_matrix(labelled(spark, sf_dir), CORR_COLS)
    return m.withColumn("r", F.bround("r", 6))


SQL_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


@query("profile", O.with_cohort(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {i} AS position, (SELECT typeof({c}) FROM labelled LIMIT 1) AS type, "
    f"(SELECT CAST(count(*) AS BIGINT) FROM labelled) AS n_rows" for i, c in
    enumerate([*COHORT_COLS, C.TARGET_COL]))))
def profile(spark, sf_dir):
    """Rows, columns and SQL type names of the labelled cohort."""
    p = pr.profile(labelled(spark, sf_dir))
    m = F.create_map(*[F.lit(x) for kv in SQL_TYPE.items() for x in kv])
    return p.select("column", "position", F.coalesce(F.try_element_at(m, F.col("type")),
                                                     F.upper("type")).alias("type"),
                    F.col("rows").alias("n_rows"))


# ----------------------------------------------------- serving-side rules

@query("reindex_fill", O.with_cohort(
    "SELECT SEQN, " + ", ".join(f"{c}" if c in C.CLINICAL_FEATURES else f"0 AS {c}"
                                for c in C.SERVING_CLINICAL_FEATURES) + " FROM cohort"))
def reindex_fill(spark, sf_dir):
    """The serving feature order; absent columns filled with 0."""
    return co.reindex(cohort(spark, sf_dir), C.SERVING_CLINICAL_FEATURES, fill=0, keep=[C.ID_COL])


def _flag_sql(c):
    return f"coalesce(lower(trim(CAST({c} AS VARCHAR))), '')"


def _ladder_inputs_sql():
    cols = set(COHORT_COLS)
    out = []
    for arg, col, default in C.LADDER_INPUTS:
        if arg in ("diabetes", "hypertension", "smoking", "alcohol", "family_history"):
            out.append(f"{_flag_sql(col) if col in cols else chr(39) * 2} AS {arg}")
        elif col in cols:
            out.append(f"CAST({col} AS DOUBLE) AS {arg}")
        else:
            out.append(f"CAST({'NULL' if default is None else default} AS DOUBLE) AS {arg}")
    return ", ".join(out)


@query("condition_defaults", O.with_cohort(f"SELECT SEQN, {_ladder_inputs_sql()} FROM cohort"))
def condition_defaults(spark, sf_dir):
    """Ladder arguments with defaults for absent columns."""
    df = cohort(spark, sf_dir)
    v = rules.ladder_inputs(df)
    return df.select(C.ID_COL, *[col.alias(k) for k, col in v.items()])


LADDER_SQL = """CASE
 WHEN coalesce(alt > 100, false) AND coalesce(ast > 100, false) THEN 1
 WHEN coalesce(bmi > 30 OR glucose > 140 OR hba1c > 6.5 OR triglycerides > 200, false)
      AND coalesce(alt > 35, false) AND coalesce(ast > 30, false) THEN 2
 WHEN alcohol IN ('1', 'yes', 'true', 'y') AND coalesce(ggt > 100, false) THEN 3
 WHEN coalesce(platelets < 150, false) AND (coalesce(bmi > 25, false) OR diabetes IN ('1', 'yes')
      OR family_history IN ('1', 'yes')) THEN 4
 WHEN coalesce(bilirubin > 3.0, false) AND alt IS NULL THEN 5
 WHEN coalesce(bmi > 35 OR glucose > 200 OR hba1c > 8.0, false) THEN 6
 WHEN (alt IS NULL OR alt <= 40) AND (ast IS NULL OR ast <= 35) AND (ggt IS NULL OR ggt <= 60)
      AND (bilirubin IS NULL OR bilirubin <= 1.2) AND coalesce(bmi < 25, false)
      AND coalesce(glucose < 100, false) AND coalesce(hba1c < 5.7, false) THEN 7
 ELSE 8 END"""

CONDITION_CASE = "CASE condition_rule " + " ".join(
    "WHEN {} THEN '{}'".format(n, t.replace("'", "''")) for n, t in C.CONDITIONS) + " END"


@query("condition_ladder", O.with_cohort(
    f", inp AS (SELECT SEQN, {_ladder_inputs_sql()} FROM cohort), "
    f"r AS (SELECT SEQN, {LADDER_SQL} AS condition_rule FROM inp) "
    f"SELECT SEQN, condition_rule, {CONDITION_CASE} AS likely_condition FROM r"))
def condition_ladder(spark, sf_dir):
    """First matching rule of the 8-step condition ladder, every row."""
    return rules.likely_condition(cohort(spark, sf_dir), with_suggestions=False) \
        .select(C.ID_COL, "condition_rule", "likely_condition")


SUGGESTION_VALUES = ", ".join(
    "('{}', {}, '{}')".format(cond.replace("'", "''"), i, s.replace("'", "''"))
    for cond, items in C.SUGGESTIONS.items() for i, s in enumerate(items))


@query("condition_suggestions", O.with_cohort(
    f", inp AS (SELECT SEQN, {_ladder_inputs_sql()} FROM cohort), "
    f"r AS (SELECT SEQN, {LADDER_SQL} AS condition_rule FROM inp), "
    f"c AS (SELECT SEQN, {CONDITION_CASE} AS likely_condition FROM r), "
    f"s(likely_condition, pos, suggestion) AS (VALUES {SUGGESTION_VALUES}) "
    "SELECT SEQN, likely_condition, CAST(pos AS INTEGER) AS pos, suggestion FROM c JOIN s USING (likely_condition)"))
def condition_suggestions(spark, sf_dir):
    """Suggestions of each row's condition, one row per suggestion."""
    d = rules.likely_condition(cohort(spark, sf_dir))
    return scalars.explode_list(d.select(C.ID_COL, "likely_condition", "suggestions"), "suggestions",
                                "suggestion", keep=[C.ID_COL, "likely_condition"])


def _decode_sql():
    parts = []
    for f, codes in C.CODED_FIELDS.items():
        whens = " ".join("WHEN {} THEN '{}'".format(code, label.replace("'", "''")) for code, label in codes)
        parts.append(f"CASE CAST({f} AS INTEGER) {whens} END AS {f}_label")
    return O.with_cohort(f"SELECT SEQN, {', '.join(C.CODED_FIELDS)}, {', '.join(parts)} FROM cohort")


@query("decode_answers", _decode_sql())
def decode_answers(spark, sf_dir):
    """Coded answers with their labels (codes kept as numbers)."""
    df = cohort(spark, sf_dir).select(C.ID_COL, *C.CODED_FIELDS)
    return scalars.decode_answers(df)
