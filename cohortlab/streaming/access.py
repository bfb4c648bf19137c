"""P12 as a stream: every request allowed or denied, with the reason.

The request stream is joined with the (static) table of account status. Most
requests are decided by that alone and leave at once. Scoring requests that
depend on earlier ones, of free accounts (a number a calendar month) and of
visitors (cool-down of their session), go through state keyed by slots of clients:
they are decided in event-time order when the watermark has passed them (see
``cooldown``), and a month's count goes when the month is over.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .cooldown import DEFAULT_SLOTS, US_PER_HOUR, InOrder, cooldown_flags, slot

QUOTA, COOLDOWN = "quota", "cool-down"
US_PER_DAY = 24 * US_PER_HOUR


def _month_end(month: int) -> int:
    """The first millisecond after a month counted from year 0 (12 * year + month - 1)."""
    year, place = divmod(month + 1, 12)
    return int((dt.datetime(year, place + 1, 1) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def _parts(who: str) -> tuple[str, int, str]:
    """(rule, month, client) of a name in the state."""
    rule, month, name = who.split("|", 2)
    return rule, int(month), name


class _Access(InOrder):
    """Names are rule|month|client; months count for the quota only."""

    def __init__(self, quota: int, gap_us: int, chunk_us: int):
        super().__init__(chunk_us)
        self.quota, self.gap = quota, gap_us

    def decide(self, who, times, carried):
        if _parts(who)[0] == COOLDOWN:
            accepted, last = cooldown_flags(times, carried and carried[0], self.gap)
            return accepted, (last, 0)
        used = carried[1] if carried else 0
        return (np.arange(len(times)) < self.quota - used).astype(np.int32), (0, min(used + len(times), self.quota))

    def matters_until(self, who, carried):
        rule, month, _ = _parts(who)
        return -(-(carried[0] + self.gap) // 1000) if rule == COOLDOWN else _month_end(month)

    def shape(self, who, ids, accepted):
        rules = [_parts(w) for w in who]
        users = [int(name) if rule == QUOTA else None for rule, _, name in rules]
        return pd.DataFrame({"id": ids, "user_id": pd.array(users, dtype="Int64"), "rule": [r[0] for r in rules], "accepted": accepted})


def stream_access(requests: DataFrame, status: DataFrame, delay: str, quota: int = C.MONTHLY_FREE_SCORINGS,
                  days: float = C.COOLDOWN_DAYS, chunk_us: int = US_PER_DAY, slots: int = DEFAULT_SLOTS) -> DataFrame:
    """(id, user_id, endpoint, decision, reason) of a stream of requests (id,
    user_id, session_id, endpoint, ts); ``status`` is (id, role, status, is_free).
    ``slots`` is fixed for the life of a checkpoint."""
    c = F.col
    st = status.select(c("id").alias("__uid"), F.coalesce(
        (c("role") == "admin") | ((c("status") == "active") & ~F.coalesce(c("is_free"), F.lit(True))), F.lit(False)).alias("paid"))
    j = (requests.withColumn("ts", c("ts").cast("timestamp")).withWatermark("ts", delay)
         .join(st, c("user_id") == c("__uid"), "left").withColumn("paid", F.coalesce("paid", F.lit(False))))
    anon, restricted, scoring = c("user_id").isNull(), c("endpoint").isin(*C.PAID_ONLY_ENDPOINTS), c("endpoint") == C.SCORING_ENDPOINT
    ordered = scoring & (anon | ~c("paid"))
    allowed = (anon & ~restricted) | (~anon & (c("paid") | ~restricted))
    reason = (F.when(anon & restricted, "login required").when(anon, "anonymous").when(c("paid"), "paid or admin")
              .when(restricted, "paid only").otherwise("unrestricted"))
    at_once = j.where(~F.coalesce(ordered, F.lit(False))).select(
        "id", "user_id", "endpoint", F.when(allowed, "allow").otherwise("deny").alias("decision"), reason.alias("reason"))

    visitor = F.coalesce(c("session_id").cast("string"), F.concat(F.lit("request "), c("id").cast("string")))
    month = F.when(anon, 0).otherwise(12 * F.year("ts") + F.month("ts") - 1)
    later = j.where(ordered).select(
        "id", "ts", F.unix_micros("ts").alias("t"), F.concat_ws(
            "|", F.when(anon, COOLDOWN).otherwise(QUOTA), month.cast("string"),
            F.coalesce(c("user_id").cast("string"), visitor)).alias("who"))
    flags = later.withColumn("slot", slot(c("who"), slots)).groupBy("slot").transformWithStateInPandas(
        statefulProcessor=_Access(quota, round(days * US_PER_DAY), chunk_us),
        outputStructType="id long, user_id long, rule string, accepted int", outputMode="append", timeMode="EventTime")
    ok, counted = c("accepted") == 1, c("rule") == QUOTA
    decided = flags.select(
        "id", "user_id", F.lit(C.SCORING_ENDPOINT).alias("endpoint"), F.when(ok, "allow").otherwise("deny").alias("decision"),
        F.when(counted & ok, "within quota").when(counted, "monthly limit").when(ok, "anonymous").otherwise("cool-down").alias("reason"))
    return at_once.union(decided)
