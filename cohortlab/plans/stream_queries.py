"""Streaming forms checked against the same SQL as their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..session import scratch_path
from ..sources import standins as S
from ..sources.tables import checkpoint_table
from ..streaming import access, cooldown, jobs
from .access_queries import COOLDOWN_TEST_DAYS, RATE_DEFAULT, RATE_LIMITS, RATE_WIDTH, W, account_status
from .registry import ORACLE, query

US_PER_DAY = 86_400_000_000
FILES = 6


def _request_files(spark, sf, r=None):
    """The request log as files that each mix early and late requests, then two
    heartbeats far ahead, which move the watermark past the last request."""
    path = scratch_path(spark, "requests_in")
    r = S.requests(spark, sf) if r is None else r
    r.repartition(FILES, "id").write.parquet(path)
    ahead = int(cooldown.delay_of(r).split()[0]) + 86_400
    for k in (1, 2):
        beat = r.agg((F.max("ts") + F.expr(f"INTERVAL {ahead * k} SECONDS")).alias("ts"))
        beat.select(*[F.col("ts") if c == "ts" else F.lit(-1 if c == "id" else None).cast(t).alias(c) for c, t in r.dtypes]) \
            .coalesce(1).write.mode("append").parquet(path)
    return path, r.schema


@query("stream_rate_limit", W(f"""SELECT user_id, endpoint, time_bucket(INTERVAL '{RATE_WIDTH}', ts) AS window_start,
  CAST(count(*) AS BIGINT) AS requests,
  CAST(least(count(*), CASE WHEN endpoint = 'chat' THEN {RATE_LIMITS['chat']} ELSE {RATE_DEFAULT} END) AS BIGINT) AS allowed
FROM requests GROUP BY 1, 2, 3"""))
def stream_rate_limit(spark, sf):
    """W7 as a stream: requests and allowed requests of each hourly window."""
    path, schema = _request_files(spark, sf)
    delay = cooldown.delay_of(S.requests(spark, sf))  # the files mix requests of the whole log
    st = jobs.stream_rate_limit(jobs.request_stream(spark, path, schema, 2), RATE_WIDTH, RATE_LIMITS, RATE_DEFAULT, delay)
    out = spark.read.parquet(jobs.run_to_parquet(st, "rate_limit"))
    return out.where("user_id is not null").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_cooldown")
def stream_cooldown(spark, sf):
    """W5 as a stateful stream: decisions in event-time order."""
    path, schema = _request_files(spark, sf)
    log = S.requests(spark, sf)
    st = jobs.stream_cooldown(jobs.request_stream(spark, path, schema, 2), COOLDOWN_TEST_DAYS * US_PER_DAY,
                              cooldown.delay_of(log), cooldown.slots_of(log))
    return spark.read.parquet(jobs.run_to_parquet(st, "cooldown")).where("user_id is not null")


@query("stream_cooldown_chunks")
def stream_cooldown_chunks(spark, sf):
    """W5 as a stream with a state row per client and time chunk, and a delay taken from the log."""
    path, schema = _request_files(spark, sf)
    cooldown.use_rocksdb(spark)
    log = S.requests(spark, sf)
    st = cooldown.stream_cooldown_chunks(jobs.request_stream(spark, path, schema, 2), COOLDOWN_TEST_DAYS * US_PER_DAY,
                                         cooldown.delay_of(log), US_PER_DAY, cooldown.slots_of(log))
    return spark.read.parquet(jobs.run_to_parquet(st, "cooldown")).where("user_id is not null")


@query("stream_access")
def stream_access(spark, sf):
    """P12 as a stream: status joined, quota and cool-down in keyed state."""
    visits = S.visits(spark, sf)
    path, schema = _request_files(spark, sf, visits)
    status = checkpoint_table(account_status(spark, sf, visits), "account_status")
    cooldown.use_rocksdb(spark)
    st = access.stream_access(jobs.request_stream(spark, path, schema, 2), status, cooldown.delay_of(visits),
                              slots=cooldown.slots_of(visits))
    return spark.read.parquet(jobs.run_to_parquet(st, "access")).where("id >= 0")


@query("stream_scores")
def stream_scores(spark, sf):
    """M19 on a stream: rows arriving as files scored by the fitted model."""
    from .ml_queries import _serving_model, clinical
    model, _ = _serving_model(spark, sf)
    rows = clinical(spark, sf).select(C.ID_COL, *C.CLINICAL_FEATURES)
    path = scratch_path(spark, "score_in")
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = jobs.run_to_parquet(jobs.stream_scores(model, stream, C.CLINICAL_FEATURES), "scores")
    return spark.read.parquet(out)


# The stream must decide exactly as the batch operator does.
ORACLE["stream_cooldown"] = ORACLE["cooldown_accepts"]
ORACLE["stream_access"] = ORACLE["access_decision"]
ORACLE["stream_cooldown_chunks"] = ORACLE["cooldown_accepts"]

