"""Access-control queries: cool-down, quota, rate limit, bookings, updates,
appends and the full access decision."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import access as X
from ..operators import activity as A
from ..session import scratch_path
from ..sources import standins as S
from ..sources.tables import append_rows, apply_updates
from ..sources.versions import VersionedTable, append_batch, read_batches
from . import oracle as O
from .registry import query

COOLDOWN_TEST_DAYS = 3   # events span 30 days; a 3-day cool-down gives ~10 accepts per user
RATE_WIDTH = "1 hour"    # events are sparse per minute; hourly windows make the limit bind
RATE_LIMITS = {"chat": 1}
RATE_DEFAULT = 2


def W(body):
    return O.with_ops(body)


def _chain_sql(source: str, key: str, days: int) -> str:
    """Accepted requests of ``source`` (id, key, ts), key by key: table acc."""
    return f"""
acc AS (SELECT * FROM (
  WITH RECURSIVE chain(k, id, ts) AS (
    SELECT {key}, arg_min(id, (ts, id)), min(ts) FROM {source} GROUP BY {key}
    UNION ALL
    SELECT c.k, n.id, n.ts FROM chain c, LATERAL (
      SELECT id, ts FROM {source} r WHERE r.{key} = c.k AND r.ts >= c.ts + INTERVAL {days} DAY
      ORDER BY ts, id LIMIT 1) n)
  SELECT * FROM chain))"""


def _cooldown_sql(days: int) -> str:
    return W(f""", {_chain_sql("requests", "user_id", days)}
SELECT r.id, r.user_id, CAST(CASE WHEN acc.id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS accepted
FROM requests r LEFT JOIN acc ON r.id = acc.id""")


@query("cooldown_accepts", _cooldown_sql(COOLDOWN_TEST_DAYS))
def cooldown_accepts(spark, sf):
    """Accepted-only cool-down (3 days) over every user's requests."""
    req = S.requests(spark, sf).select("id", "user_id", "ts")
    return X.cooldown(req, "user_id", "ts", "id", COOLDOWN_TEST_DAYS).select("id", "user_id", "accepted")


@query("cooldown_accepts_30", _cooldown_sql(C.COOLDOWN_DAYS))
def cooldown_accepts_30(spark, sf):
    """The same with the 30 days that visitors have to wait."""
    req = S.requests(spark, sf).select("id", "user_id", "ts")
    return X.cooldown(req, "user_id", "ts", "id", C.COOLDOWN_DAYS).select("id", "user_id", "accepted")


@query("monthly_quota", W("""SELECT id, user_id, CAST(CASE WHEN row_number() OVER (PARTITION BY user_id, date_trunc('month', ts)
  ORDER BY ts, id) <= 1 THEN 1 ELSE 0 END AS INTEGER) AS allowed FROM requests WHERE endpoint = 'predict'"""))
def monthly_quota(spark, sf):
    """First scoring request per user and calendar month allowed."""
    req = S.requests(spark, sf).where(F.col("endpoint") == C.SCORING_ENDPOINT)
    return X.monthly_quota(req).select("id", "user_id", "allowed")


@query("rate_limit", W(f"""SELECT id, user_id, endpoint, CAST(CASE WHEN row_number() OVER (
  PARTITION BY user_id, endpoint, time_bucket(INTERVAL '{RATE_WIDTH}', ts) ORDER BY ts, id)
  <= CASE WHEN endpoint = 'chat' THEN {RATE_LIMITS['chat']} ELSE {RATE_DEFAULT} END THEN 1 ELSE 0 END AS INTEGER) AS allowed
FROM requests"""))
def rate_limit(spark, sf):
    """Fixed-window limit per (user, endpoint), hourly windows."""
    r = X.rate_limit(S.requests(spark, sf), limits=RATE_LIMITS, default=RATE_DEFAULT, width=RATE_WIDTH,
                     slice_unit="minute")
    return r.select("id", "user_id", "endpoint", "allowed")


@query("rate_limit_minute", W(f"""SELECT id, user_id, endpoint, CAST(CASE WHEN row_number() OVER (
  PARTITION BY user_id, endpoint, time_bucket(INTERVAL '1 minute', ts) ORDER BY ts, id)
  <= CASE WHEN endpoint = 'chat' THEN {C.RATE_LIMIT_CHAT} ELSE {C.RATE_LIMIT_DEFAULT} END THEN 1 ELSE 0 END AS INTEGER) AS allowed
FROM requests"""))
def rate_limit_minute(spark, sf):
    """The limits of 10 (chat: 5) requests a minute."""
    return X.rate_limit(S.requests(spark, sf)).select("id", "user_id", "endpoint", "allowed")


BOOK_SQL = """,
win AS (SELECT slot_id, arg_min(id, (ts, id)) AS wid FROM booking_requests GROUP BY 1),
outc AS (SELECT b.id, b.slot_id, CASE WHEN s.id IS NULL THEN 'unknown_slot' WHEN s.is_booked THEN 'already_booked'
                  WHEN b.id = w.wid THEN 'booked' ELSE 'slot_taken' END AS outcome
         FROM booking_requests b LEFT JOIN doctor_availability s ON b.slot_id = s.id LEFT JOIN win w ON b.slot_id = w.slot_id)"""


@query("apply_bookings", W(BOOK_SQL + " SELECT id, slot_id, outcome FROM outc"))
def apply_bookings(spark, sf):
    """Booking outcome per request (first request per free slot wins)."""
    return X.apply_bookings(S.booking_requests(spark, sf), S.doctor_availability(spark, sf)) \
        .select("id", "slot_id", "outcome")


@query("slots_after_booking", W(BOOK_SQL + """
SELECT s.id, s.is_booked OR s.id IN (SELECT slot_id FROM outc WHERE outcome = 'booked') AS is_booked
FROM doctor_availability s"""))
def slots_after_booking(spark, sf):
    """New version of the slot table with won bookings marked booked."""
    slots = S.doctor_availability(spark, sf)
    won = X.apply_bookings(S.booking_requests(spark, sf), slots) \
        .where(F.col("outcome") == "booked").select(F.col("slot_id").alias("id"))
    return apply_updates(slots, won, "id", {"is_booked": True}).select("id", "is_booked")


@query("book_versions", W(BOOK_SQL + """
SELECT s.id, s.is_booked OR s.id IN (SELECT slot_id FROM outc WHERE outcome = 'booked') AS is_booked,
  coalesce(o.n_booked, 0) AS n_booked, coalesce(o.n_refused, 0) AS n_refused
FROM doctor_availability s LEFT JOIN (SELECT slot_id, count(*) FILTER (WHERE outcome = 'booked') AS n_booked,
  count(*) FILTER (WHERE outcome <> 'booked') AS n_refused FROM outc GROUP BY slot_id) o ON o.slot_id = s.id"""))
def book_versions(spark, sf):
    """The slots as a versioned table; the requests book in two rounds
    (those of the first half of the time, then the others), each as one version."""
    slots, requests = S.doctor_availability(spark, sf), S.booking_requests(spark, sf)
    table = VersionedTable.create(slots, scratch_path(spark, "slots"), "id", buckets=8)
    middle = requests.agg((F.unix_micros(F.min(F.col("ts").cast("timestamp"))) / 2
                           + F.unix_micros(F.max(F.col("ts").cast("timestamp"))) / 2).alias("t")).first()["t"]
    early = F.unix_micros(F.col("ts").cast("timestamp")) <= F.lit(middle)
    outcomes = [X.book(table, requests.where(part))[1] for part in (early, ~early)]
    tally = outcomes[0].union(outcomes[1]).groupBy(F.col("slot_id").alias("id")).agg(
        F.count_if(F.col("outcome") == "booked").alias("n_booked"), F.count_if(F.col("outcome") != "booked").alias("n_refused"))
    return table.read().select("id", "is_booked").join(tally, "id", "left").fillna(0, ["n_booked", "n_refused"])


@query("cancel_subscriptions", W("""
SELECT s.id, s.user_id, CASE WHEN c.id IS NOT NULL THEN 'cancelled' ELSE s.status END AS status
FROM user_subscriptions s LEFT JOIN (SELECT DISTINCT id, user_id FROM cancel_requests) c ON s.id = c.id AND s.user_id = c.user_id"""))
def cancel_subscriptions(spark, sf):
    """Cancel requests applied only where the requester owns the
    subscription (guard on user_id)."""
    subs = S.user_subscriptions(spark, sf)
    return apply_updates(subs, S.cancel_requests(spark, sf), "id", {"status": "cancelled"}, guard=["user_id"]) \
        .select("id", "user_id", "status")


@query("append_rows", W("""SELECT consultation_type, CAST(count(*) AS BIGINT) AS n FROM records GROUP BY 1"""))
def append_rows_q(spark, sf):
    """Liver records written, the other records appended, table read back."""
    r = S.records(spark, sf)
    path = scratch_path(spark, "records_table")
    liver = F.coalesce(F.lower("consultation_type").contains("liver"), F.lit(False))
    append_rows(r.where(liver), path)
    append_rows(r.where(~liver), path)
    back = spark.read.parquet(path)
    return back.groupBy("consultation_type").agg(F.count(F.lit(1)).alias("n"))


@query("append_batches", W("""SELECT consultation_type, CAST(count(*) AS BIGINT) AS n FROM records GROUP BY 1"""))
def append_batches(spark, sf):
    """The records appended as a batch per weekday, every batch twice, table read back."""
    r = S.records(spark, sf)
    path, day = scratch_path(spark, "record_batches"), F.dayofweek("created_at")
    for k in [*range(1, 8), *range(1, 8)]:
        append_batch(r.where(F.coalesce(day, F.lit(1)) == k), path, f"day-{k}")
    return read_batches(spark, path, r.schema).groupBy("consultation_type").agg(F.count(F.lit(1)).alias("n"))


@query("access_decision", W(f"""
, ids AS (SELECT DISTINCT user_id AS id FROM visits WHERE user_id IS NOT NULL),
roles AS (SELECT ids.id, CASE WHEN u.id IS NOT NULL THEN coalesce(u.role, 'user') WHEN d.id IS NOT NULL THEN 'doctor'
                              WHEN a.id IS NOT NULL THEN 'admin' ELSE 'user' END AS role
          FROM ids LEFT JOIN users u ON ids.id = u.id LEFT JOIN (SELECT DISTINCT id FROM doctors) d ON ids.id = d.id
          LEFT JOIN (SELECT DISTINCT id FROM admins) a ON ids.id = a.id),
latest AS (SELECT user_id, status, plan_id FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_date DESC, id DESC) AS rn
             FROM user_subscriptions WHERE status <> 'cancelled') WHERE rn = 1),
st AS (SELECT ids.id, r.role,
         CASE WHEN r.role = 'admin' THEN 'active' WHEN l.user_id IS NOT NULL THEN l.status ELSE 'inactive' END AS status,
         CASE WHEN r.role = 'admin' THEN false WHEN l.user_id IS NOT NULL THEN coalesce(p.is_free, true) ELSE true END AS is_free
       FROM ids LEFT JOIN roles r ON ids.id = r.id LEFT JOIN latest l ON ids.id = l.user_id
       LEFT JOIN subscription_plans p ON l.plan_id = p.id),
j AS (SELECT q.*, coalesce(st.role = 'admin' OR (st.status = 'active' AND NOT coalesce(st.is_free, true)), false) AS paid
      FROM visits q LEFT JOIN st ON q.user_id = st.id),
fq AS (SELECT id, row_number() OVER (PARTITION BY user_id, date_trunc('month', ts) ORDER BY ts, id) AS rk
       FROM j WHERE user_id IS NOT NULL AND NOT paid AND endpoint = 'predict'),
anon AS (SELECT id, coalesce(session_id, 'request ' || id) AS client, ts FROM j WHERE user_id IS NULL AND endpoint = 'predict'),
{_chain_sql("anon", "client", C.COOLDOWN_DAYS)}
SELECT j.id, j.user_id, j.endpoint,
  CASE WHEN j.user_id IS NULL AND j.endpoint IN ('chat', 'book_appointment') THEN 'deny'
       WHEN j.user_id IS NULL AND j.endpoint = 'predict' AND acc.id IS NULL THEN 'deny'
       WHEN j.user_id IS NULL THEN 'allow' WHEN paid THEN 'allow'
       WHEN j.endpoint IN ('chat', 'book_appointment') THEN 'deny'
       WHEN j.endpoint = 'predict' AND fq.rk > 1 THEN 'deny' ELSE 'allow' END AS decision,
  CASE WHEN j.user_id IS NULL AND j.endpoint IN ('chat', 'book_appointment') THEN 'login required'
       WHEN j.user_id IS NULL AND j.endpoint = 'predict' AND acc.id IS NULL THEN 'cool-down'
       WHEN j.user_id IS NULL THEN 'anonymous' WHEN paid THEN 'paid or admin'
       WHEN j.endpoint IN ('chat', 'book_appointment') THEN 'paid only'
       WHEN j.endpoint = 'predict' AND fq.rk > 1 THEN 'monthly limit'
       WHEN j.endpoint = 'predict' THEN 'within quota' ELSE 'unrestricted' END AS reason
FROM j LEFT JOIN fq ON j.id = fq.id LEFT JOIN acc ON j.id = acc.id"""))
def access_decision(spark, sf):
    """allow/deny with reason for every request (role, subscription,
    paid-only endpoints, monthly scoring quota)."""
    req = S.visits(spark, sf)
    return X.access_decision(req, account_status(spark, sf, req)).select("id", "user_id", "endpoint", "decision", "reason")


def account_status(spark, sf, req):
    """(id, role, status, is_free) of every account that a request names."""
    u, d, a = S.users(spark, sf), S.doctors(spark, sf), S.admins(spark, sf)
    ids = req.where(F.col("user_id").isNotNull()).select(F.col("user_id").alias("id")).distinct()
    roles = A.resolve_role(ids, u, d, a, ("users", "doctors", "admins"))
    st = A.subscription_status(ids, S.user_subscriptions(spark, sf), S.subscription_plans(spark, sf), roles)
    return st.join(roles.select("id", "role"), "id")
