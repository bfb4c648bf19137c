"""Rows that the test tables lack: null keys, slices and labels, ties, tabs,
overflow, constant columns, visitors without an account."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortlab import session
from cohortlab.functions import scalars
from cohortlab.operators import access as X
from cohortlab.operators import activity as A
from cohortlab.operators import metrics as M
from cohortlab.operators import ordered as od
from cohortlab.operators import profile as pr
from cohortlab.sources import tables

T0 = datetime(2024, 1, 1)


def requests(spark):
    rows = [(1, None, "chat", T0), (2, None, "chat", T0 + timedelta(seconds=1)), (3, 5, "chat", None), (4, 5, "chat", T0),
            (5, None, None, None)]
    return spark.createDataFrame(rows, "id long, user_id long, endpoint string, ts timestamp")


def test_rate_limit_and_quota_keep_null_keys(spark):
    df = requests(spark)
    limited = {r.id: r.allowed for r in X.rate_limit(df, limits={"chat": 1}, default=10).collect()}
    assert limited == {1: 1, 2: 0, 3: 1, 4: 1, 5: 1}
    quota = {r.id: r.allowed for r in X.monthly_quota(df).collect()}
    assert quota == {1: 1, 2: 0, 3: 1, 4: 1, 5: 1}


def test_ordered_operators_keep_null_keys(spark):
    rows = [(None, 1, "user", "a"), (None, 2, "assistant", "b"), (None, None, "user", "c"), (7, 1, "user", "d"), (7, 2, "user", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, message string")
    assert sorted((r.message, r.pos) for r in A.last_n(df, "conv_id", "turn", 2).collect()) == \
        [("a", 1), ("b", 2), ("d", 1), ("e", 2)]
    assert [(r.conv_id, r.user_message, r.bot_reply) for r in A.pair_exchanges(df).collect()] == [(None, "a", "b")]
    up = A.ordered_within(df, "conv_id", [F.col("turn")], F.floor(F.col("turn") / 64))
    assert {r.message: r.pos for r in up.collect()} == {"c": 1, "a": 2, "b": 3, "d": 1, "e": 2}
    down = A.ordered_within(df, "conv_id", [F.col("turn").desc()], -F.floor(F.col("turn") / 64), nulls_last=True)
    assert {r.message: r.pos for r in down.collect()} == {"b": 1, "a": 2, "c": 3, "e": 1, "d": 2}


def test_split_and_folds_keep_null_labels(spark):
    rows = [(i, None if i % 5 == 0 else i % 2) for i in range(100)] + [(None, 1)]
    df = spark.createDataFrame(rows, "id long, y long")
    split = M.stratified_split(df, "y", "id", 0.2).collect()
    assert len(split) == 101
    for label, n in ((None, 20), (0, 40), (1, 41)):
        assert sum(r.is_test for r in split if r.y == label) == -(-n // 5)
    folds = M.stratified_folds(df, "y", "id", 4).collect()
    assert sorted(sum(r.fold == k for r in folds if r.y is None) for k in range(4)) == [5] * 4
    by_hash = M.hash_split(df, "id", 0.3)
    assert by_hash.count() == 101 and 15 <= by_hash.where("is_test = 1").count() <= 45


def test_prefix_sums_and_best_keep_null_groups(spark):
    rows = [(g, v, 1) for g in (None, "a", "b") for v in range(50)]
    df = spark.createDataFrame(rows, "g string, v long, n long")
    got = {(r.g, r.v): r.cum_n for r in od.prefix_sums(df, ["g"], "v", ["n"]).collect()}
    assert got == {(g, v): v + 1 for g, v, _ in rows}
    down = {(r.g, r.v): r.cum_n for r in od.prefix_sums(df, ["g"], "v", ["n"], descending=True).collect()}
    assert down == {(g, v): 50 - v for g, v, _ in rows}
    auc = spark.createDataFrame([(None, "x", 0.5), (None, "w", 0.5), ("a", "y", None), ("a", "z", 0.1)], "g string, name string, auc double")
    assert {r.g: r.name for r in M.best_by(auc, ["g"], "auc", "name").collect()} == {None: "w", "a": "z"}


def test_approximate_quantiles(spark):
    df = spark.range(1001).select(F.lit("c").alias("column"), F.col("id").cast("double").alias("value"))
    got = {r.p: r.q for r in od.exact_quantiles(df, "column", "value", [0.25, 0.5], accuracy=10000).collect()}
    assert got[0.25] == pytest.approx(250, abs=1) and got[0.5] == pytest.approx(500, abs=1)


def test_correlation_of_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 7.0), (None, 6.0, None)],
                               "`a|b` double, c double, d double")
    got = {(r.a, r.b): r.r for r in pr.corr_matrix(df, ["a|b", "c", "d"]).collect()}
    assert got["a|b", "c"] is None and got["c", "d"] is None and got["a|b", "a|b"] == 1.0 and got["c", "c"] == 1.0
    assert got["a|b", "d"] == got["d", "a|b"] == pytest.approx(0.99339927)
    flat = pr.corr_matrix(spark.createDataFrame([(1.0, 1.0)] * 3, "x double, y double"), ["x", "y"]).collect()
    assert len(flat) == 4 and all(r.r is None for r in flat)


def test_scalar_text_cases(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("v")).first()["v"]

    assert value(scalars.text_flag(F.lit("\tYes\n"))) == "yes"
    assert value(scalars.normalise_key(F.lit("A@B.c\n"))) == "a@b.c"
    for x in (0.125, 0.375, 2.675, 1.005, 0.005, 0.015, -0.125, -2.675, 1234567.895, 0.0, 3.999999, 1e15, 98765432.125, 0.285):
        assert value(scalars.money_text(F.lit(x))) == "%.2f" % x, x
    assert value(scalars.money_text(F.lit(None).cast("double"))) is None
    assert value(scalars.minor_units(F.lit("123456789.01"))) == int(float("123456789.01") * 100)
    assert value(scalars.minor_units(F.lit("1e300"))) is None
    for text, ok in (("2024", False), ("20240101", True), ("2024-01-01", True), ("2024-01-01T10:00:00Z", True),
                     ("2024-01-01 10:00:00.5+02:00", True), ("2024-13-01", False), ("x", False)):
        assert (value(scalars.parse_iso_ts(F.lit(text))) is not None) == ok, text
    assert value(scalars.title(F.lit("pending-review (LATE) now"))) == "Pending-Review (Late) Now"


def test_each_visitor_session_has_its_own_clock(spark):
    rows = [(1, None, "s1", "predict", T0), (2, None, "s2", "predict", T0 + timedelta(days=1)),
            (3, None, "s1", "predict", T0 + timedelta(days=2)), (4, None, None, "predict", T0),
            (5, None, None, "predict", T0), (6, None, "s1", "chat", T0), (7, 9, None, "predict", T0),
            (8, None, "s1", "predict", T0 + timedelta(days=31))]
    df = spark.createDataFrame(rows, "id long, user_id long, session_id string, endpoint string, ts timestamp")
    status = spark.createDataFrame([(9, "admin", "active", False)], "id long, role string, status string, is_free boolean")
    got = {r.id: (r.decision, r.reason) for r in X.access_decision(df, status).collect()}
    assert got == {1: ("allow", "anonymous"), 2: ("allow", "anonymous"), 3: ("deny", "cool-down"), 4: ("allow", "anonymous"),
                   5: ("allow", "anonymous"), 6: ("deny", "login required"), 7: ("allow", "paid or admin"), 8: ("allow", "anonymous")}


def test_cooldown_30_days_hot_key_and_levels_are_dropped(spark):
    rows = [(i, 1 if i % 3 == 0 else i, T0 + timedelta(hours=7 * i)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, user_id long, ts timestamp")
    last, want = {}, {}
    for i, u, ts in rows:
        want[i] = int(u not in last or ts - last[u] >= timedelta(days=30))
        if want[i]:
            last[u] = ts
    got = {r.id: r.accepted for r in X.cooldown(df, days=30).collect()}
    assert got == want
    left = tables.file_listing(spark, session.shared_dir(spark))
    assert not [f for f in left if "cooldown_jump" in f or "cooldown_succ" in f]


def test_chart_series_has_every_record(spark):
    rows = [(i, 1, "liver", 0.125, T0 + timedelta(hours=i)) for i in range(2500)] + [(9000, 2, "other", 0.5, T0), (9001, 2, "Liver", None, None)]
    df = spark.createDataFrame(rows, "id long, user_id long, consultation_type string, health_score double, created_at timestamp")
    got = {(r.user_id, r.chunk): r for r in A.series_json(df).collect()}
    assert {k: r.n_points for k, r in got.items()} == {(1, 0): 1000, (1, 1): 1000, (1, 2): 500, (2, 0): 1}
    assert got[1, 0].labels_json.startswith('["2024-04-14"') and got[1, 2].scores_json.startswith("[0.1250,")


def test_only_absent_or_corrupt_modules_are_skipped(spark, tmp_path):
    assert tables.load_module(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad.parquet").write_bytes(b"no parquet at all")
    assert tables.load_module(spark, str(tmp_path / "bad.parquet")) is None
    with pytest.raises(Exception):
        tables.load_module(spark, "nosuchscheme://x/y")
