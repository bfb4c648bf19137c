"""Access control over request logs (P12, W5-W8, S7 use).

The source decides one request at a time against a remote database; here
each rule runs over a whole request table:

* ``cooldown``       W5 accepted-only cool-down (denials never reset it)
* ``monthly_quota``  W6 first n requests per key and calendar month
* ``rate_limit``     W7 fixed-window limit per (client, endpoint)
* ``apply_bookings`` W8 first request per slot wins
* ``access_decision`` P12 the full ladder (role, subscription, quota)

None collects a key's requests into one task: ranks use
``salted_row_number``; the cool-down uses successor pointers found by
time-chunked running windows plus pointer doubling.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import drop_path
from ..sources.tables import apply_updates, checkpoint_table, written_table
from ..sources.versions import VersionedTable
from .ordered import join_null_safe, salted_row_number

US_PER_HOUR = 3_600_000_000
US_PER_DAY = 24 * US_PER_HOUR


# --------------------------------------------------------------------- W5

def successors(req: DataFrame, key: str, ts: str, id_col: str, gap_us: int,
               chunk_us: int = US_PER_HOUR) -> DataFrame:
    """For every request r: the first request of the same key (by (ts, id))
    with ts >= r.ts + gap. Returns (key, id, t, nid, nt).

    Time is cut into chunks of an hour (or ``gap``, if that is shorter), and
    r's probe t + gap falls in a later one. Inside a (key, chunk) a running window (incremental frame)
    finds the nearest request at or after each probe; probes with none there
    take the first request of the next non-empty chunk (a per-key window over
    chunk summaries, bounded by the key's time span / chunk). A hot key is
    therefore spread over as many tasks as it has chunks.
    """
    t = F.unix_micros(F.col(ts).cast("timestamp"))  # NTZ or LTZ; the session is UTC
    base = req.where(F.col(ts).isNotNull()).select(F.col(key).alias("k"), F.col(id_col).alias("id"), t.alias("t"))
    width = min(gap_us, chunk_us)
    chunk = F.floor(F.col("t") / F.lit(width))
    rows = base.select("k", chunk.alias("c"), "t", "id", F.lit(0).alias("kind"))
    probes = base.select("k", F.floor((F.col("t") + F.lit(gap_us)) / F.lit(width)).alias("c"), (F.col("t") + F.lit(gap_us)).alias("t"),
                         F.col("id"), F.lit(1).alias("kind"))
    u = rows.unionByName(probes)
    # Descending time, requests before probes at equal time, ids descending:
    # the running "last request seen" at a probe is the smallest (t, id) >= probe.
    w = (Window.partitionBy("k", "c").orderBy(F.col("t").desc(), F.col("kind").asc(), F.col("id").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = F.last(F.when(F.col("kind") == 0, F.struct(F.col("t").alias("t"), F.col("id").alias("id"))),
                  ignorenulls=True).over(w)
    inchunk = u.withColumn("__near", near).where(F.col("kind") == 1) \
        .select("k", "c", F.col("id").alias("src"), "__near")
    # Fallback: first request of the first non-empty chunk after c.
    firsts = rows.groupBy("k", "c").agg(F.min(F.struct("t", "id")).alias("__first"))
    qs = inchunk.select("k", "c").distinct()
    cu = firsts.select("k", "c", F.lit(1).alias("kind"), "__first") \
        .unionByName(qs.select("k", "c", F.lit(0).alias("kind"), F.lit(None).cast(firsts.schema["__first"].dataType)
                               .alias("__first")))
    wc = (Window.partitionBy("k").orderBy(F.col("c").desc(), F.col("kind").asc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt_chunk = cu.withColumn("__after", F.last("__first", ignorenulls=True).over(wc)).where("kind = 0") \
        .select("k", "c", "__after")
    # __after at a query row covers chunks > c only: CS rows of chunk c sort
    # after the query row (kind 1 > 0) in this descending order.
    j = join_null_safe(inchunk, nxt_chunk, ["k", "c"], "left")
    succ = j.select("k", F.col("src").alias("id"), F.coalesce("__near", "__after").alias("__n"))
    out = join_null_safe(base, succ, ["k", "id"], "left")
    return out.select(F.col("k").alias(key), "id", "t", F.col("__n.id").alias("nid"), F.col("__n.t").alias("nt"))


def cooldown(req: DataFrame, key: str = "user_id", ts: str = "ts", id_col: str = "id",
             days: float = C.COOLDOWN_DAYS, name: str = "accepted") -> DataFrame:
    """A request is accepted when the last *accepted* request of its key
    is at least ``days`` old (the first request is always accepted).

    Accepted requests form the successor chain from each key's first
    request. The chain is enumerated by pointer doubling: jump tables
    J_k(v) = succ^(2^k)(v) are built by self-joins (each level written to the
    shared folder to cut lineage), then the set {first} is widened with J_k
    for k = K-1..0, which reaches every succ^t(first), t < 2^K. K comes from
    the longest possible chain (one accept per ``days`` of a key's span), so
    the work is O(rows * log(span / days)) with no per-key collection. The
    tables of the levels are dropped at the end. Null is a key like others; a
    request without a time is not accepted.
    Returns ``req`` plus a 0/1 ``name`` column.
    """
    gap = int(round(days * US_PER_DAY))
    s = successors(req, key, ts, id_col, gap)
    s, *paths = written_table(s, "cooldown_succ")
    span = s.groupBy(key).agg(((F.max("t") - F.min("t")) / F.lit(gap)).alias("__s")).agg(F.max("__s")).first()[0]
    max_len = int(math.floor(span or 0)) + 2
    levels = max(1, math.ceil(math.log2(max_len)))
    jumps = [s.select(key, "id", F.col("nid").alias("j"))]
    for _ in range(1, levels):
        a = jumps[-1]
        b = a.select(F.col("id").alias("__bid"), F.col("j").alias("__bj"))
        nxt = a.join(b, F.col("j") == F.col("__bid"), "left").select(key, "id", F.col("__bj").alias("j"))
        level, path = written_table(nxt, "cooldown_jump")
        jumps.append(level)
        paths.append(path)
    heads = s.groupBy(key).agg(F.min(F.struct("t", "id")).alias("__h")).select(key, F.col("__h.id").alias("id"))
    acc = heads
    for jk in reversed(jumps):
        step = acc.join(jk.select(F.col("id").alias("__sid"), "j"), F.col("id") == F.col("__sid"), "inner") \
            .where(F.col("j").isNotNull()).select(key, F.col("j").alias("id"))
        acc, path = written_table(acc.unionByName(step).distinct(), "cooldown_acc")
        paths.append(path)
    for path in paths[:-1]:
        drop_path(req.sparkSession, path)
    flags = acc.select(F.col("id").alias("__aid"), F.lit(1).alias("__a"))
    out = req.join(flags, F.col(id_col) == F.col("__aid"), "left")
    return out.select(*req.columns, F.coalesce("__a", F.lit(0)).alias(name))


# --------------------------------------------------------------------- W6/W7

def monthly_quota(req: DataFrame, key: str = "user_id", ts: str = "ts", id_col: str = "id",
                  n: int = C.MONTHLY_FREE_SCORINGS, name: str = "allowed") -> DataFrame:
    """The first ``n`` requests per key and calendar month are allowed
    (rank by (ts, id), salted by day)."""
    d = req.withColumn("__month", F.date_trunc("month", F.col(ts)))
    r = salted_row_number(d, [key, "__month"], [F.col(ts), F.col(id_col)], F.to_date(F.col(ts)), name="__rank")
    return r.withColumn(name, (F.col("__rank") <= n).cast("int")).drop("__month", "__rank")


def rate_limit(req: DataFrame, client: str = "user_id", endpoint: str = "endpoint", ts: str = "ts",
               id_col: str = "id", limits: dict | None = None, default: int = C.RATE_LIMIT_DEFAULT,
               width: str = "1 minute", slice_unit: str = "second", name: str = "allowed") -> DataFrame:
    """Fixed-window limit per (client, endpoint): within each window of
    ``width`` the first ``limit(endpoint)`` requests pass. Requests without a
    time share a window of their own."""
    limits = limits if limits is not None else {"chat": C.RATE_LIMIT_CHAT}
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    d = req.withColumn("__win", F.floor(t / F.lit(pd.Timedelta(width).value // 1000)))
    r = salted_row_number(d, [client, endpoint, "__win"], [F.col(ts), F.col(id_col)],
                          F.date_trunc(slice_unit, F.col(ts)), name="__rank")
    lim = F.lit(default)
    for ep, n in limits.items():
        lim = F.when(F.col(endpoint) == ep, F.lit(n)).otherwise(lim)
    return r.withColumn(name, (F.col("__rank") <= lim).cast("int")).drop("__win", "__rank")


# --------------------------------------------------------------------- W8

def apply_bookings(requests: DataFrame, slots: DataFrame, slot_col: str = "slot_id",
                   ts: str = "ts", id_col: str = "id") -> DataFrame:
    """Booking outcome per request: 'unknown_slot', 'already_booked',
    'booked' for the first request (ts, id) on a free slot, else
    'slot_taken'. The winner per slot is one min aggregate (no window)."""
    s = slots.select(F.col("id").alias("__sid"), F.col("is_booked").alias("__booked"))
    j = requests.join(s, F.col(slot_col) == F.col("__sid"), "left")
    win = requests.groupBy(slot_col).agg(F.min(F.struct(F.col(ts), F.col(id_col))).alias("__w")) \
        .select(F.col(slot_col).alias("__ws"), F.col(f"__w.{id_col}").alias("__wid"))
    j = j.join(win, F.col(slot_col) == F.col("__ws"), "left")
    outcome = (F.when(F.col("__sid").isNull(), "unknown_slot")
                .when(F.col("__booked"), "already_booked")
                .when(F.col(id_col) == F.col("__wid"), "booked")
                .otherwise("slot_taken"))
    return j.select(*requests.columns, outcome.alias("outcome"))


def book(table: VersionedTable, requests: DataFrame, slot_col: str = "slot_id", ts: str = "ts",
         id_col: str = "id") -> tuple[int, DataFrame]:
    """W8/S7 with other writers about: mark the slots that ``requests`` win as
    booked, as the table's next version, and the outcome of every request as of
    the version that it went into. A slot that another writer has booked in the
    meantime is ``already_booked``."""
    outcomes = []

    def change(slots: DataFrame) -> DataFrame:
        outcomes.append(apply_bookings(requests, slots, slot_col, ts, id_col))
        won = outcomes[-1].where(F.col("outcome") == "booked").select(F.col(slot_col).alias("id"))
        return apply_updates(slots, won, "id", {"is_booked": True})

    version = table.update(requests.select(F.col(slot_col).alias("id")).where("id is not null"), change)
    return version, outcomes[-1]


# --------------------------------------------------------------------- P12

def access_decision(requests: DataFrame, status: DataFrame, key: str = "user_id",
                    endpoint: str = "endpoint", ts: str = "ts", id_col: str = "id",
                    quota: int = C.MONTHLY_FREE_SCORINGS, session: str = "session_id",
                    days: float = C.COOLDOWN_DAYS) -> DataFrame:
    """allow/deny with a reason for every request.

    ``status`` is (id, role, status, is_free) per account (J8 + W1).
    Admin or paid+active: allow. Anonymous: the scoring endpoint is limited
    by the accepted-only cool-down of the visitor's session (a request without
    a session is a visitor of its own), chat/booking need a login. Otherwise
    chat/booking are paid-only and scoring allows the first ``quota``
    requests per calendar month.
    """
    st = status.select(F.col("id").alias("__uid"), F.col("role").alias("__role"),
                       F.col("status").alias("__status"), F.col("is_free").alias("__free"))
    paid = (F.col("__role") == "admin") | ((F.col("__status") == "active") & ~F.coalesce(F.col("__free"), F.lit(True)))
    # The request log joined with account status is read by four passes
    # (quota ranks, their slice counts, the anonymous check, the final
    # join): write that narrow projection once instead of re-joining the log.
    j = checkpoint_table(requests.join(st, F.col(key) == F.col("__uid"), "left")
                         .select(*requests.columns, F.coalesce(paid, F.lit(False)).alias("__paid")),
                         "access_joined")
    anon = F.col(key).isNull()
    paid = F.col("__paid")
    ep = F.col(endpoint)
    restricted = ep.isin(*C.PAID_ONLY_ENDPOINTS)
    scoring = ep == C.SCORING_ENDPOINT
    # Quota ranks only the free users' scoring requests.
    free_scoring = j.where(~anon & ~paid & scoring)
    ranked = monthly_quota(free_scoring.select(id_col, key, ts), key, ts, id_col, quota, "__qok") \
        .select(F.col(id_col).alias("__qid"), "__qok")
    anon_scoring = j.where(anon & scoring).select(
        id_col, F.coalesce(F.col(session).cast("string"), F.concat(F.lit("request "), F.col(id_col).cast("string")))
        .alias("__client"), ts)
    cd = None
    if anon_scoring.take(1):  # the cool-down job only runs when anonymous scorings exist
        cd = cooldown(anon_scoring, "__client", ts, id_col, days, "__cok") \
            .select(F.col(id_col).alias("__cid"), "__cok")
    out = j.join(ranked, F.col(id_col) == F.col("__qid"), "left")
    if cd is not None:
        out = out.join(cd, F.col(id_col) == F.col("__cid"), "left")
    else:
        out = out.withColumn("__cok", F.lit(None).cast("int"))
    decision = (F.when(anon & restricted, F.struct(F.lit("deny").alias("d"), F.lit("login required").alias("r")))
                 .when(anon & scoring & (F.col("__cok") == 0),
                       F.struct(F.lit("deny").alias("d"), F.lit("cool-down").alias("r")))
                 .when(anon, F.struct(F.lit("allow").alias("d"), F.lit("anonymous").alias("r")))
                 .when(paid, F.struct(F.lit("allow").alias("d"), F.lit("paid or admin").alias("r")))
                 .when(restricted, F.struct(F.lit("deny").alias("d"), F.lit("paid only").alias("r")))
                 .when(scoring & (F.col("__qok") == 0), F.struct(F.lit("deny").alias("d"), F.lit("monthly limit").alias("r")))
                 .when(scoring, F.struct(F.lit("allow").alias("d"), F.lit("within quota").alias("r")))
                 .otherwise(F.struct(F.lit("allow").alias("d"), F.lit("unrestricted").alias("r"))))
    return out.select(*requests.columns, decision["d"].alias("decision"), decision["r"].alias("reason"))
