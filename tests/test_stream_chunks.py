"""The cool-down stream with state by time chunk."""

import random

from cohortlab.session import scratch_path
from cohortlab.streaming import cooldown, jobs
from pyspark.sql import functions as F

DAY = 86_400_000_000


def plain(rows, gap):
    out, last = {}, {}
    for i, u, t in sorted(rows, key=lambda r: (r[2], r[0])):
        ok = u not in last or t >= last[u] + gap
        last[u] = t if ok else last.get(u)
        out[i] = int(ok)
    return out


def test_a_long_log_in_mixed_files_loses_nothing(spark):
    """400 days, one client with a third of all requests, files that each mix all dates."""
    rng = random.Random(1)
    rows = [(i, 0 if i % 3 == 0 else rng.randrange(1, 9), rng.randrange(400 * DAY)) for i in range(1500)]
    rows += [(9000 + k, 3, rows[5][2]) for k in range(3)]  # ties
    df = spark.createDataFrame(rows, "id long, user_id long, t long").select(
        "id", "user_id", F.timestamp_micros("t").alias("ts"))
    path = scratch_path(spark, "long_log")
    df.repartition(4, "id").write.parquet(path)
    for k in (1, 2):
        spark.createDataFrame([(-k, None, (2000 + k) * DAY)], "id long, user_id long, t long").select(
            "id", "user_id", F.timestamp_micros("t").alias("ts")).coalesce(1).write.mode("append").parquet(path)
    cooldown.use_rocksdb(spark)
    delay = cooldown.delay_of(df)
    st = cooldown.stream_cooldown_chunks(jobs.request_stream(spark, path, df.schema, 2), 3 * DAY, delay, 5 * DAY)
    got = {r.id: r.accepted for r in spark.read.parquet(jobs.run_to_parquet(st, "long")).where("user_id is not null").collect()}
    assert got == plain(rows, 3 * DAY)


def test_delay_of_the_log(spark):
    df = spark.createDataFrame([(0,), (90_500_000,)], "t long").select(F.timestamp_micros("t").alias("ts"))
    assert cooldown.delay_of(df) == "92 seconds" and cooldown.delay_of(df.limit(0)) == "2 seconds"


def test_access_stream_equals_the_batch_rules(spark):
    """Quotas over month ends, visitors with and without sessions, accounts unknown to the status table."""
    from cohortlab.operators import access as X
    from cohortlab.streaming import access
    rng = random.Random(2)
    rows = []
    for i in range(600):
        user = rng.choice((None, None, 1, 2, 3, 4, 99))
        rows.append((i, user, rng.choice(("s1", "s2", None)), rng.choice(("predict", "predict", "chat", "book_appointment", "home")),
                     rng.randrange(100 * DAY)))
    rows += [(700, 2, None, "predict", 31 * DAY), (701, 2, None, "predict", 31 * DAY - 1), (702, 2, None, "predict", 31 * DAY - 1)]
    df = spark.createDataFrame(rows, "id long, user_id long, session_id string, endpoint string, t long").select(
        "id", "user_id", "session_id", "endpoint", F.timestamp_micros("t").alias("ts"))
    status = spark.createDataFrame([(1, "admin", "active", False), (2, "user", "inactive", True), (3, "user", "active", False),
                                    (4, "doctor", "active", None)], "id long, role string, status string, is_free boolean")
    path = scratch_path(spark, "visit_log")
    df.repartition(4, "id").write.parquet(path)
    for k in (1, 2):
        spark.createDataFrame([(-k, None, None, None, (900 * k) * DAY)], "id long, user_id long, session_id string, endpoint string, t long") \
            .select("id", "user_id", "session_id", "endpoint", F.timestamp_micros("t").alias("ts")).coalesce(1).write.mode("append").parquet(path)
    cooldown.use_rocksdb(spark)
    st = access.stream_access(jobs.request_stream(spark, path, df.schema, 2), status, cooldown.delay_of(df), quota=2, days=10)
    got = spark.read.parquet(jobs.run_to_parquet(st, "access")).where("id >= 0")
    want = X.access_decision(df, status, quota=2, days=10).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.reason for r in got.collect()} == {"login required", "anonymous", "cool-down", "paid or admin", "paid only",
                                                 "within quota", "monthly limit", "unrestricted"}


def test_month_ends():
    from cohortlab.streaming.access import _month_end
    assert _month_end(12 * 1970) == 31 * 86_400_000 and _month_end(12 * 1970 + 11) == 365 * 86_400_000
