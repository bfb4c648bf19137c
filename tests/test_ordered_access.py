"""Scale-safe helpers and access rules against brute force, with a hot key."""

import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlab.operators import access as X
from cohortlab.operators import ordered as od


def _events(n=600, seed=7):
    rng = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < 0.34 else rng.randint(1, 20)  # user 0 holds a third of the rows
        ts = t0 + timedelta(seconds=rng.randint(0, 60 * 86400))
        rows.append((i, user, ts))
    return rows


def test_salted_row_number_equals_window(spark):
    rows = _events()
    df = spark.createDataFrame(rows, "id long, user_id long, ts timestamp")
    got = od.salted_row_number(df, ["user_id"], [F.col("ts"), F.col("id")], F.to_date("ts"), "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "id")))
    a = sorted((r["id"], r["rn"]) for r in got.collect())
    b = sorted((r["id"], r["rn"]) for r in want.collect())
    assert a == b


def test_prefix_sums_equal_cumsum(spark):
    rng = random.Random(5)
    rows = [("g", float(v), rng.randint(1, 5)) for v in range(500)] + [("h", float(v), 1) for v in range(10)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    got = {(r["g"], r["v"]): r["cum_n"] for r in od.prefix_sums(df, ["g"], "v", ["n"]).collect()}
    for g in ("g", "h"):
        acc = 0
        for (gg, v, n) in sorted(r for r in rows if r[0] == g):
            acc += n
            assert got[(g, v)] == acc


def test_exact_quantiles_equal_numpy(spark):
    rng = random.Random(9)
    vals = [rng.choice([1.0, 2.0, 4.0, 10.0, rng.random() * 100]) for _ in range(333)]
    df = spark.createDataFrame([("c", v) for v in vals] + [("d", v) for v in [1.0, 2.0, 4.0, 10.0]],
                               "column string, value double")
    got = {(r["column"], r["p"]): r["q"] for r in od.exact_quantiles(df, "column", "value", [0.25, 0.5, 0.75]).collect()}
    for p in (0.25, 0.5, 0.75):
        assert abs(got[("c", p)] - float(np.percentile(vals, p * 100))) < 1e-9
    assert got[("d", 0.5)] == 3.0  # mean of the two middle values


def _brute_cooldown(rows, days):
    acc = {}
    last = {}
    for i, user, ts in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        if user not in last or ts - last[user] >= timedelta(days=days):
            last[user] = ts
            acc[i] = 1
        else:
            acc[i] = 0
    return acc


def test_cooldown_hand_rows(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(k, 1, t0 + timedelta(days=d)) for k, d in enumerate([0, 20, 31, 45, 61])]
    df = spark.createDataFrame(rows, "id long, user_id long, ts timestamp")
    got = {r["id"]: r["accepted"] for r in X.cooldown(df, days=30).collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}


def test_cooldown_vs_brute_force_hot_key(spark):
    rows = _events(800, seed=11)
    df = spark.createDataFrame(rows, "id long, user_id long, ts timestamp")
    for days in (3, 10):
        got = {r["id"]: r["accepted"] for r in X.cooldown(df, days=days).collect()}
        assert got == _brute_cooldown(rows, days)
        # property: accepted requests of a user are at least `days` apart
        acc = sorted((u, ts) for i, u, ts in rows if got[i])
        for (u1, t1), (u2, t2) in zip(acc, acc[1:]):
            if u1 == u2:
                assert t2 - t1 >= timedelta(days=days)


def test_monthly_quota_and_rate_limit(spark):
    t0 = datetime(2024, 1, 31, 23, 0)
    rows = [(0, 1, "predict", t0), (1, 1, "predict", t0 + timedelta(minutes=30)),
            (2, 1, "predict", t0 + timedelta(hours=2)), (3, 2, "chat", t0), (4, 2, "chat", t0 + timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "id long, user_id long, endpoint string, ts timestamp")
    q = {r["id"]: r["allowed"] for r in X.monthly_quota(df.where("endpoint = 'predict'")).collect()}
    assert q == {0: 1, 1: 0, 2: 1}  # id 2 falls in February
    r = {x["id"]: x["allowed"] for x in X.rate_limit(df, limits={"chat": 1}, default=10).collect()}
    assert r == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0}


def test_apply_bookings(spark):
    t0 = datetime(2024, 1, 1)
    slots = spark.createDataFrame([(10, False), (11, True)], "id long, is_booked boolean")
    req = spark.createDataFrame([(1, 5, 10, t0 + timedelta(minutes=1)), (2, 6, 10, t0), (3, 7, 11, t0),
                                 (4, 8, 99, t0)], "id long, user_id long, slot_id long, ts timestamp")
    got = {r["id"]: r["outcome"] for r in X.apply_bookings(req, slots).collect()}
    assert got == {1: "slot_taken", 2: "booked", 3: "already_booked", 4: "unknown_slot"}
