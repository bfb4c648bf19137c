"""W5 cool-down as a stream whose state rows stay small.

Clients are dealt into slots by hash, as many as the log is worth
(``slots_of``), so that a call into the state serves many clients. A slot's
undecided requests are kept by time chunk, one state row each; when the
watermark passes a chunk's end, its timer decides the chunk's requests in
event-time order and only the time of each client's last accepted request goes
on to the next one. So a state row holds the requests of one slot and chunk,
however long the log and the delay are, and a micro-batch rewrites only the
chunks that it brings requests for. A last accepted time goes when its cool-down
is over.

Needs the RocksDB state store (``use_rocksdb``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

US_PER_HOUR = 3_600_000_000
ROWS_PER_SLOT = 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs, for streams started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def delay_of(requests: DataFrame, ts: str = "ts") -> str:
    """A watermark delay that loses nothing whatever order the log's files come
    in: the span of its times, and a second."""
    t = F.unix_seconds(F.col(ts).cast("timestamp"))
    span = requests.agg((F.max(t) - F.min(t)).alias("s")).first()["s"]
    return f"{(span or 0) + 2} seconds"


def slots_of(requests: DataFrame) -> int:
    """Slots for a log: about ``ROWS_PER_SLOT`` requests in each, a few for every state partition at least."""
    width = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * width, -(-requests.count() // ROWS_PER_SLOT))


def slot(who: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(who), F.lit(slots)).cast("int")


def by_client(who: np.ndarray, times: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[str, int, int]]]:
    """Event-time order within each client (ties by id), and every client's place in that order (who, from, to)."""
    codes, names = pd.factorize(who)
    order = np.lexsort((ids, times, codes))
    ends = np.cumsum(np.bincount(codes, minlength=len(names))).tolist()
    return order, list(zip(names.tolist(), [0, *ends[:-1]], ends, strict=True))


class InOrder(StatefulProcessor):
    """Decides each client's requests in event-time order, a time chunk at a time.

    The key is a slot, which has many clients. Subclasses say what is carried
    from one request of a client to the next (two whole numbers), and until when
    it matters. Rows have who (the client), t (microseconds) and id; ``shape``
    makes the rows to return from clients, ids and flags."""

    def __init__(self, chunk_us: int):
        self.chunk = chunk_us

    def decide(self, who: str, times: np.ndarray, carried: tuple[int, int] | None) -> tuple[np.ndarray, tuple[int, int] | None]:
        raise NotImplementedError

    def matters_until(self, who: str, carried: tuple[int, int]) -> int:
        """The first millisecond at which nothing depends on ``carried`` any more."""
        raise NotImplementedError

    def shape(self, who: np.ndarray, ids: np.ndarray, accepted: np.ndarray) -> pd.DataFrame:
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carried = handle.getValueState("carried", "who array<string>, a array<long>, b array<long>")
        self.waiting = handle.getMapState("waiting", "chunk long", "who array<string>, times array<long>, ids array<long>")

    def _end(self, chunk: int) -> int:
        """The first millisecond after a chunk."""
        return -(-(chunk + 1) * self.chunk // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            t, ids, who = pdf["t"].to_numpy(np.int64), pdf["id"].to_numpy(np.int64), pdf["who"].to_numpy(object)
            chunks = t // self.chunk
            order = np.argsort(chunks, kind="stable")
            found, starts = np.unique(chunks[order], return_index=True)
            for c, at in zip(found.tolist(), np.split(order, starts[1:]), strict=True):
                new = who[at].tolist(), t[at].tolist(), ids[at].tolist()
                if self.waiting.containsKey((c,)):
                    new = tuple(list(old) + more for old, more in zip(self.waiting.getValue((c,)), new, strict=True))
                else:
                    self.handle.registerTimer(max(self._end(c), timerValues.getCurrentWatermarkInMs() + 1))
                self.waiting.updateValue((c,), new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        due = sorted(c for (c,) in self.waiting.keys() if self._end(c) <= passed)
        held = self.carried.get() if self.carried.exists() else None
        if not due and held is None:
            return
        carried = {w: (a, b) for w, a, b in zip(*held, strict=True)} if held else {}
        for c in due:
            who, times, ids = self.waiting.getValue((c,))
            who, times, ids = np.array(who, dtype=object), np.array(times, dtype=np.int64), np.array(ids, dtype=np.int64)
            order, clients = by_client(who, times, ids)
            times, accepted = times[order], np.zeros(len(order), dtype=np.int32)
            for w, lo, hi in clients:
                accepted[lo:hi], carried[w] = self.decide(w, times[lo:hi], carried.get(w))
            self.waiting.removeKey((c,))
            yield self.shape(who[order], ids[order], accepted)
        until = {w: self.matters_until(w, v) for w, v in carried.items()}
        left = [w for w in carried if until[w] > passed]
        if left:
            if due or len(left) < len(carried):
                self.carried.update((left, [carried[w][0] for w in left], [carried[w][1] for w in left]))
            if due:
                self.handle.registerTimer(max(until[w] for w in left))
        elif held is not None:
            self.carried.clear()

    def close(self) -> None:
        pass


def cooldown_flags(times: np.ndarray, last: int | None, gap: int) -> tuple[np.ndarray, int | None]:
    """Accepted requests among sorted times, and the last accepted one."""
    accepted = np.zeros(len(times), dtype=np.int32)
    at = 0 if last is None else int(np.searchsorted(times, last + gap))
    while at < len(times):  # from one accepted request to the next
        accepted[at] = 1
        last = int(times[at])
        at = max(at + 1, int(np.searchsorted(times, last + gap)))
    return accepted, last


class _Cooldown(InOrder):
    def __init__(self, gap_us: int, chunk_us: int):
        super().__init__(chunk_us)
        self.gap = gap_us

    def decide(self, who, times, carried):
        accepted, last = cooldown_flags(times, carried and carried[0], self.gap)
        return accepted, (last, 0)

    def matters_until(self, who, carried):
        return -(-(carried[0] + self.gap) // 1000)

    def shape(self, who, ids, accepted):
        return decisions(who, ids, accepted)


def client(user: str) -> Column:
    """A user's name in the state; requests without a user are those of one nameless client."""
    return F.coalesce(F.col(user).cast("string"), F.lit(""))


def decisions(who: np.ndarray, ids: np.ndarray, accepted: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"id": ids, "user_id": pd.array([int(w) if w else None for w in who], dtype="Int64"), "accepted": accepted})


DEFAULT_SLOTS = 64


def stream_cooldown_chunks(requests: DataFrame, gap_us: int, delay: str, chunk_us: int = US_PER_HOUR,
                           slots: int = DEFAULT_SLOTS) -> DataFrame:
    """Per-request accept flag (id, user_id, accepted), in event-time order. ``slots``
    is fixed for the life of a checkpoint; ``slots_of`` gives it from a log."""
    s = (requests.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
         .select("id", client("user_id").alias("who"), "ts", F.unix_micros("ts").alias("t")))
    return s.withColumn("slot", slot(F.col("who"), slots)).groupBy("slot").transformWithStateInPandas(
        statefulProcessor=_Cooldown(gap_us, chunk_us), outputStructType="id long, user_id long, accepted int",
        outputMode="append", timeMode="EventTime")
