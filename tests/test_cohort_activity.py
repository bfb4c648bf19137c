"""Cohort assembly, sources and activity operators."""

import pytest
from pyspark.sql import functions as F

from cohortlab import config as C
from cohortlab.operators import activity as A
from cohortlab.operators import cohort as co
from cohortlab.sources import standins as S
from cohortlab.sources import tables as T
from conftest import SF001


def test_chain_keeps_spine_rows_and_union_agrees(spark):
    mods = S.survey_modules(spark, SF001)
    chain = co.build_cohort(mods)
    union = co.build_cohort(mods, validate="union")
    assert chain.count() == mods["DEMO"].count() == 150
    cols = chain.columns
    assert sorted(map(tuple, chain.select(*cols).collect())) == sorted(map(tuple, union.select(*cols).collect()))


def test_label_counts_sf0001(spark):
    import __spark_entry__ as E
    got = {r["value"]: r["n"] for r in E.entry(spark).collect()}
    assert got == {0: 93, 1: 57}


def test_absent_module_skipped_and_guards(spark):
    mods = S.survey_modules(spark, SF001, absent=("GHB",))
    df = co.build_cohort(mods)
    assert "LBXGH" not in df.columns and df.count() == 150
    with pytest.raises(ValueError):
        co.build_cohort(dict(mods, DEMO=None))
    with pytest.raises(ValueError):
        co.build_cohort(dict(mods, CBC=None, GLU=None, GHB=None))


def test_union_strategy_rejects_duplicate_keys(spark):
    spine = spark.createDataFrame([(1, 10.0), (2, 20.0)], "SEQN long, A double")
    dup = spark.createDataFrame([(1, 1.0), (1, 2.0)], "SEQN long, B double")
    with pytest.raises(Exception):
        co.build_cohort({"DEMO": spine, "X": dup}, validate="union", critical=[]).collect()
    # the join chain multiplies rows like a pandas left merge
    assert co.build_cohort({"DEMO": spine, "X": dup}, critical=[]).count() == 3


def test_label_independent_of_row_order(spark):
    mods = S.survey_modules(spark, SF001)
    a = co.labelled_cohort(mods).select(C.ID_COL, C.TARGET_COL)
    b = co.labelled_cohort({k: v.orderBy(F.rand(1)) for k, v in mods.items()}).select(C.ID_COL, C.TARGET_COL)
    assert sorted(a.collect()) == sorted(b.collect())


def test_load_module_missing_and_present(spark, tmp_path):
    assert T.load_module(spark, str(tmp_path / "nope.parquet")) is None
    p = str(tmp_path / "m.parquet")
    spark.createDataFrame([(1, float("nan"))], "SEQN long, X double").write.parquet(p)
    df = T.load_module(spark, p)
    assert df.first()["X"] is None  # NaN normalised to null


def test_reindex_and_positional(spark):
    df = spark.createDataFrame([(1.0, None)], "LBXPLTSI double, EXTRA double")
    r = co.reindex(df, ["LBXALT", "LBXPLTSI"], fill=0)
    assert r.columns == ["LBXALT", "LBXPLTSI"] and r.first().asDict() == {"LBXALT": 0, "LBXPLTSI": 1.0}
    raw = spark.createDataFrame([(1.0, 2.0, 3.0)], "_c0 double, _c1 double, _c2 double")
    assert co.assign_positional(raw, ["a", "b"]).columns == ["a", "b"]


def test_rows_from_dicts(spark):
    df = T.rows_from_dicts(spark, [{"a": "1.5", "b": "x"}, {"a": None}], ["a", "b", "c"])
    assert [tuple(r) for r in df.collect()] == [(1.5, None, None), (None, None, None)]


def test_last_n_keeps_short_groups(spark):
    df = spark.createDataFrame([(1, t, "user", f"m{t}") for t in range(3)] +
                               [(2, t, "user", f"m{t}") for t in range(300)], "conv_id long, turn long, role string, message string")
    got = A.last_n(df, "conv_id", "turn", 10)
    c1 = sorted((r["turn"], r["pos"]) for r in got.where("conv_id = 1").collect())
    c2 = sorted((r["turn"], r["pos"]) for r in got.where("conv_id = 2").collect())
    assert c1 == [(0, 1), (1, 2), (2, 3)]
    assert c2 == [(290 + i, i + 1) for i in range(10)]


def test_pair_exchanges(spark):
    df = spark.createDataFrame([(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"),
                                (1, 4, "assistant", "a2"), (1, 5, "user", "q3")],
                               "conv_id long, turn long, role string, message string")
    got = sorted((r["user_message"], r["bot_reply"]) for r in A.pair_exchanges(df).collect())
    assert got == [("q1", "a1"), ("q2", "a2")]


def test_resolve_role_orders(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    users = spark.createDataFrame([(1, "user"), (2, None)], "id long, role string")
    doctors = spark.createDataFrame([(1,), (3,)], "id long")
    admins = spark.createDataFrame([(4,), (3,)], "id long")
    a = {r["id"]: r["role"] for r in A.resolve_role(ids, users, doctors, admins).collect()}
    b = {r["id"]: r["role"] for r in A.resolve_role(ids, users, doctors, admins, ("doctors", "admins", "users")).collect()}
    assert a == {1: "user", 2: "user", 3: "doctor", 4: "admin"}
    assert b == {1: "doctor", 2: "user", 3: "doctor", 4: "admin"}


def test_subscription_status_rules(spark):
    from datetime import datetime
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    roles = spark.createDataFrame([(1, "user"), (2, "user"), (3, "admin")], "id long, role string")
    subs = spark.createDataFrame([(10, 1, 2, "active", datetime(2024, 1, 1)), (11, 1, 1, "cancelled", datetime(2024, 2, 1))],
                                 "id long, user_id long, plan_id int, status string, start_date timestamp")
    plans = spark.createDataFrame([(1, True), (2, False)], "id int, is_free boolean")
    got = {r["id"]: (r["status"], r["is_free"]) for r in A.subscription_status(ids, subs, plans, roles).collect()}
    assert got == {1: ("active", False), 2: ("inactive", True), 3: ("active", False)}


def test_count_by_sums_to_rows(spark):
    u = S.users(spark, SF001)
    assert sum(r["n"] for r in A.count_by(u, "role", "user").collect()) == u.count()


def test_bucketed_modules_join_without_exchange(spark):
    import contextlib
    import io
    mods = S.survey_modules(spark, SF001, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = co.build_cohort(mods)
        rows = sorted(map(tuple, df.collect()))
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue().split("== Initial Plan ==")[0]
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        if old_aqe:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
        else:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    plain = co.build_cohort(S.survey_modules(spark, SF001)).select(*df.columns)
    assert rows == sorted(map(tuple, plain.collect()))


def test_modules_are_cut_from_files_worth_their_rows(spark, tmp_path):
    """Few rows make few files whatever the shuffle width, with the rows of the lazy plans; nothing else is left behind."""
    import shutil
    from pathlib import Path

    from cohortlab.session import shared_dir
    for t in ("customer", "orders", "lineitem"):
        shutil.copy(f"{SF001}/{t}.parquet", tmp_path)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        paths = S.module_files(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    lazy = S.survey_modules(spark, str(tmp_path), materialize=False)
    assert list(paths) == list(lazy)
    for m, path in paths.items():
        assert len(list(Path(path.removeprefix("file:")).glob("part-*"))) <= 8
        assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == sorted(map(tuple, lazy[m].collect()), key=repr)
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("*_measures-*"))
