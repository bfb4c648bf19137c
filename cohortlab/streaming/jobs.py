"""Structured Streaming forms of three rules.

* ``stream_rate_limit``  W7: requests, and allowed requests, of each (client,
                         endpoint, window): a watermark and Spark's own
                         tumbling-window count
* ``stream_cooldown``    W5: one decision per request, in event-time order
* ``stream_scores``      M19 stateless scoring of a stream with a fitted
                         PipelineModel

Files may arrive in any order: a request may be up to the watermark delay
older than the newest one seen. Windows are emitted, and requests decided, when
the watermark has passed them; state goes when it can no longer matter. Sinks
are parquet folders in the shared folder with their checkpoints next to them,
so a restarted query resumes from its committed offsets and state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import drop_path, scratch_path
from .cooldown import DEFAULT_SLOTS, by_client, client, cooldown_flags, decisions, slot


def run_to_parquet(stream: DataFrame, name: str) -> str:
    """Run a streaming DataFrame over all available input into a parquet
    sink (append) and return the sink path. The checkpoint of a finished run
    is dropped."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}_out")
    ckpt = scratch_path(spark, f"{name}_ckpt")
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    drop_path(spark, ckpt)
    return out


def request_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """File stream of requests; ``max_files`` bounds a micro-batch."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(path)


# ------------------------------------------------------------------- W7

def stream_rate_limit(requests: DataFrame, width: str, limits: dict, default: int, delay: str) -> DataFrame:
    """(user_id, endpoint, window_start, requests, allowed): of each window of
    ``width``, how many requests came and how many the limit lets pass. State
    is one count per open window."""
    limit = F.lit(default)
    for endpoint, n in limits.items():
        limit = F.when(F.col("endpoint") == endpoint, F.lit(n)).otherwise(limit)
    g = (requests.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
         .groupBy("user_id", "endpoint", F.window("ts", width).alias("w")).agg(F.count("*").alias("requests")))
    return g.select("user_id", "endpoint", F.col("w.start").alias("window_start"), "requests",
                    F.least(F.col("requests"), limit).cast("long").alias("allowed"))


# ------------------------------------------------------------------- W5

def _cooldown_fn(gap_us: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clients, lasts, names, times, ids = state.get if state.exists else ([], [], [], [], [])
        last = dict(zip(clients, lasts, strict=True))
        w, t, i = [np.array(names, dtype=object)], [np.asarray(times, dtype=np.int64)], [np.asarray(ids, dtype=np.int64)]
        if not state.hasTimedOut:
            for pdf in pdfs:
                w.append(pdf["who"].to_numpy(object))
                t.append(pdf["t"].to_numpy(np.int64))
                i.append(pdf["id"].to_numpy(np.int64))
        w, t, i = np.concatenate(w), np.concatenate(t), np.concatenate(i)
        passed = state.getCurrentWatermarkMs() * 1000
        due, later = t <= passed, t > passed  # no older request can come
        if due.any():
            who, ids = w[due], i[due]
            order, places = by_client(who, t[due], ids)
            ordered, accepted = t[due][order], np.zeros(len(order), dtype=np.int32)
            for name, lo, hi in places:
                accepted[lo:hi], last[name] = cooldown_flags(ordered[lo:hi], last.get(name), gap_us)
            yield decisions(who[order], ids[order], accepted)
        # a last accepted time matters until its cool-down is over, and to requests at hand that are not decided yet
        waiting = set(w[later].tolist())
        last = {k: v for k, v in last.items() if v + gap_us > passed or k in waiting}
        if not later.any() and not last:
            if state.exists:
                state.remove()
            return
        state.update((list(last), list(last.values()), w[later].tolist(), t[later].tolist(), i[later].tolist()))
        until = int(t[later].min()) // 1000 if later.any() else (max(last.values()) + gap_us) // 1000
        state.setTimeoutTimestamp(max(until + 1, state.getCurrentWatermarkMs() + 1))
    return fn


def stream_cooldown(requests: DataFrame, gap_us: int, delay: str, slots: int = DEFAULT_SLOTS) -> DataFrame:
    """Per-request accept flag. Clients are dealt into ``slots`` by hash; the state
    of a slot holds its clients' last accepted times and the requests that the
    watermark has not passed yet (no more than came within ``delay``); a last time
    goes once the cool-down is over. ``slots`` is fixed for the life of a checkpoint."""
    s = (requests.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
         .select("id", client("user_id").alias("who"), "ts", F.unix_micros("ts").alias("t")))
    return s.withColumn("slot", slot(F.col("who"), slots)).groupBy("slot").applyInPandasWithState(
        _cooldown_fn(gap_us), outputStructType="id long, user_id long, accepted int",
        stateStructType="clients array<string>, lasts array<long>, names array<string>, times array<long>, ids array<long>",
        outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)


# ------------------------------------------------------------------- M19

def stream_scores(model, rows: DataFrame, features: list[str]) -> DataFrame:
    """Stateless: the batch scoring expression applied to a stream."""
    from ..ml.models import score_batch
    return score_batch(model, rows, features)
