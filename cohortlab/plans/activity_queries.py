"""Activity, lookup and scalar queries over the operational stand-ins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import rules, scalars
from ..operators import activity as A
from ..operators import sketches as K
from ..session import scratch_path
from ..sources import standins as S
from ..sources.tables import checkpoint_table
from . import oracle as O
from .registry import query

AS_OF_ORDERS = "2001-08-01"        # orders-derived tables end here
AS_OF_EVENTS = "2024-01-31"        # events end on 2024-01-30
JOIN_AS_OF = "1996-09-17 00:10:00"  # a busy appointment day, 10 min past start


def W(body):
    return O.with_ops(body)


# ---------------------------------------------------------------- A1, A4-A6

@query("table_counts", W("""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM users) AS users, (SELECT CAST(count(*) AS BIGINT) FROM doctors) AS doctors,
       (SELECT CAST(count(*) AS BIGINT) FROM admins) AS admins, (SELECT CAST(count(*) AS BIGINT) FROM records) AS records,
       (SELECT CAST(count(*) AS BIGINT) FROM chat_history) AS chats,
       (SELECT CAST(count(*) AS BIGINT) FROM appointments) AS appointments"""))
def table_counts(spark, sf):
    """A1: row counts of six operational tables in one row."""
    return A.table_counts({"users": S.users(spark, sf), "doctors": S.doctors(spark, sf),
                           "admins": S.admins(spark, sf), "records": S.records(spark, sf),
                           "chats": S.chat_history(spark, sf), "appointments": S.appointments(spark, sf)})


@query("appointments_by_status", W(
    "SELECT coalesce(status, 'Unknown') AS status, CAST(count(*) AS BIGINT) AS n FROM appointments GROUP BY 1"))
def appointments_by_status(spark, sf):
    """A4: appointment counts per status (missing -> 'Unknown')."""
    return A.count_by(S.appointments(spark, sf), "status", C.UNKNOWN)


@query("users_by_role", W(
    "SELECT coalesce(role, 'user') AS role, CAST(count(*) AS BIGINT) AS n FROM users GROUP BY 1"))
def users_by_role(spark, sf):
    """A4: user counts per role (missing -> 'user')."""
    return A.count_by(S.users(spark, sf), "role", C.DEFAULT_ROLE)


BUCKET_SQL = """CASE WHEN lower(coalesce(consultation_type, 'Unknown')) LIKE '%liver%' AND lower(coalesce(consultation_type, 'Unknown')) LIKE '%clinical%' THEN 'Liver Clinical'
 WHEN lower(coalesce(consultation_type, 'Unknown')) LIKE '%liver%' AND lower(coalesce(consultation_type, 'Unknown')) LIKE '%lifestyle%' THEN 'Liver Lifestyle'
 WHEN lower(coalesce(consultation_type, 'Unknown')) LIKE '%liver%' THEN 'Liver Other' ELSE 'Other' END"""


@query("records_by_type", W(f"SELECT {BUCKET_SQL} AS bucket, CAST(count(*) AS BIGINT) AS n FROM records GROUP BY 1"))
def records_by_type(spark, sf):
    """Record counts per type bucket."""
    return A.count_by_bucket(S.records(spark, sf))


@query("daily_activity", W(f"""
, reg AS (SELECT strftime(created_at, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS registrations FROM users
          WHERE created_at >= TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL {C.TRAILING_DAYS} DAY GROUP BY 1),
app AS (SELECT strftime(appointment_time, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS appointments FROM appointments
        WHERE appointment_time >= TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL {C.TRAILING_DAYS} DAY GROUP BY 1)
SELECT coalesce(reg.day, app.day) AS day, coalesce(registrations, 0) AS registrations, coalesce(appointments, 0) AS appointments
FROM reg FULL JOIN app ON reg.day = app.day"""))
def daily_activity(spark, sf):
    """Registrations and appointments per day over the
    trailing 180 days as of a given date, aligned with zeros."""
    return A.daily_activity(S.users(spark, sf), S.appointments(spark, sf), AS_OF_ORDERS)


# ---------------------------------------------------------------- P8-P11

@query("slots_open", W("SELECT id, doctor_id, strftime(available_date, '%Y-%m-%d') AS day, start_time "
                       "FROM doctor_availability WHERE NOT is_booked"))
def slots_open(spark, sf):
    """Open (unbooked) availability slots."""
    s = A.slots_open(S.doctor_availability(spark, sf))
    return s.select("id", "doctor_id", F.date_format("available_date", "yyyy-MM-dd").alias("day"), "start_time")


@query("plans_active", W("""SELECT id, name, price, TRY_CAST(price AS DOUBLE) AS price_num,
       CAST(row_number() OVER (ORDER BY TRY_CAST(price AS DOUBLE), id) AS INTEGER) AS pos
FROM subscription_plans WHERE is_active"""))
def plans_active(spark, sf):
    """Active plans ordered by the numeric value of the price text.
    The plan table has one row per plan (bounded), so a global order is fine."""
    p = A.plans_active(S.subscription_plans(spark, sf))
    w = Window.orderBy("price_num", "id")
    return p.select("id", "name", "price", "price_num", F.row_number().over(w).cast("int").alias("pos"))


@query("records_of_kind", W("SELECT id, user_id, consultation_type FROM records WHERE lower(consultation_type) LIKE '%liver%'"))
def records_of_kind(spark, sf):
    """P10: records whose type contains 'liver' (case-insensitive)."""
    return A.records_of_kind(S.records(spark, sf)).select("id", "user_id", "consultation_type")


@query("joinable_meetings", W(f"""SELECT id, CASE WHEN meeting_url IS NULL OR meeting_url = '' THEN 'N/A'
 WHEN TIMESTAMP '{JOIN_AS_OF}' >= appointment_time AND TIMESTAMP '{JOIN_AS_OF}' <= appointment_time + INTERVAL {C.JOIN_WINDOW_MINUTES} MINUTE
 THEN 'Join Meeting' ELSE 'Meeting Link Ready' END AS join_status FROM appointments"""))
def joinable_meetings(spark, sf):
    """Meeting join status of every appointment at a given instant."""
    return A.joinable(S.appointments(spark, sf), JOIN_AS_OF).select("id", "join_status")


# ---------------------------------------------------------------- J3-J8

@query("subscriptions_with_plan", W("""SELECT s.id, s.user_id, s.status, p.name AS plan_name, p.price AS plan_price,
       p.is_free AS plan_is_free FROM user_subscriptions s LEFT JOIN subscription_plans p ON s.plan_id = p.id"""))
def subscriptions_with_plan(spark, sf):
    """Each subscription with its plan's name, price and free flag."""
    j = A.with_plan(S.user_subscriptions(spark, sf), S.subscription_plans(spark, sf))
    return j.select("id", "user_id", "status", "plan_name", "plan_price", "plan_is_free")


@query("appointments_named", W("""SELECT a.id, coalesce(d.specialization, 'Unknown') AS doctor,
       coalesce(u.name, 'N/A') AS patient
FROM appointments a LEFT JOIN doctors d ON a.doctor_id = d.id LEFT JOIN users u ON a.user_id = u.id"""))
def appointments_named(spark, sf):
    """Appointments with doctor and patient names, defaults for misses."""
    a = S.appointments(spark, sf)
    a = A.lookup(a, S.doctors(spark, sf), "doctor_id", "id", {"specialization": ("doctor", C.UNKNOWN)})
    a = A.lookup(a, S.users(spark, sf), "user_id", "id", {"name": ("patient", C.NOT_AVAILABLE)})
    return a.select("id", "doctor", "patient")


@query("doctors_in_use", W("SELECT id, specialization FROM doctors WHERE id IN (SELECT doctor_id FROM appointments)"))
def doctors_in_use(spark, sf):
    """Doctors that appear in any appointment (semi join)."""
    return A.restrict_to(S.doctors(spark, sf), S.appointments(spark, sf), "id", "doctor_id") \
        .select("id", "specialization")


@query("doctor_profile", W("""SELECT u.id, u.name, u.email, d.bio, d.specialization, d.consultation_fee
FROM users u JOIN doctors d ON d.user_id = u.id"""))
def doctor_profile(spark, sf):
    """Account row merged with the doctor row (right side wins)."""
    u = S.users(spark, sf).select("id", "name", "email")
    d = S.doctors(spark, sf).select("user_id", "bio", "specialization", "consultation_fee")
    return A.merge_rows(u, d, "id", "user_id")


CANDIDATES_SQL = """, cands AS (SELECT '  ' || upper(c_name) || '@EXAMPLE.COM ' AS email FROM customer
                UNION ALL SELECT lower(s_name) || '@example.com' FROM supplier)"""


def _candidates(spark, sf):
    from ..sources.tables import read_table
    c = read_table(spark, sf, "customer").select(
        F.concat(F.lit("  "), F.upper("c_name"), F.lit("@EXAMPLE.COM ")).alias("email"))
    s = read_table(spark, sf, "supplier").select(F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email"))
    return c.unionByName(s)


@query("registrations_new", W(CANDIDATES_SQL + """
SELECT email, lower(trim(email)) AS normalised FROM cands
WHERE lower(trim(email)) NOT IN (SELECT lower(trim(email)) FROM users WHERE email IS NOT NULL)"""))
def registrations_new(spark, sf):
    """Candidate registrations whose normalised e-mail is new."""
    return A.only_new(_candidates(spark, sf), S.users(spark, sf), "email", "email").select("email", "normalised")


ROLE_SQL = """, ids AS (SELECT DISTINCT user_id AS id FROM requests),
r AS (SELECT ids.id, u.role AS urole, u.id IS NOT NULL AS in_u, d.id IS NOT NULL AS in_d, a.id IS NOT NULL AS in_a
      FROM ids LEFT JOIN users u ON ids.id = u.id LEFT JOIN (SELECT DISTINCT id FROM doctors) d ON ids.id = d.id
      LEFT JOIN (SELECT DISTINCT id FROM admins) a ON ids.id = a.id)"""


@query("resolve_roles", W(ROLE_SQL + """
SELECT id,
  CASE WHEN in_u THEN coalesce(urole, 'user') WHEN in_d THEN 'doctor' WHEN in_a THEN 'admin' ELSE 'user' END AS role_users_first,
  CASE WHEN in_d THEN 'doctor' WHEN in_a THEN 'admin' WHEN in_u THEN coalesce(urole, 'user') ELSE 'user' END AS role_doctors_first
FROM r"""))
def resolve_roles(spark, sf):
    """Role of every requesting id under both table precedences."""
    ids = S.requests(spark, sf).select(F.col("user_id").alias("id")).distinct()
    u, d, a = S.users(spark, sf), S.doctors(spark, sf), S.admins(spark, sf)
    r1 = A.resolve_role(ids, u, d, a, ("users", "doctors", "admins")).withColumnRenamed("role", "role_users_first")
    r2 = A.resolve_role(ids, u, d, a, ("doctors", "admins", "users")).withColumnRenamed("role", "role_doctors_first")
    return r1.join(r2, "id")


# ---------------------------------------------------------------- W1-W3, W10

@query("subscription_status", W("""
, ids AS (SELECT id FROM users UNION SELECT id FROM admins),
roles AS (SELECT ids.id, CASE WHEN u.id IS NOT NULL THEN coalesce(u.role, 'user') WHEN d.id IS NOT NULL THEN 'doctor'
                              WHEN a.id IS NOT NULL THEN 'admin' ELSE 'user' END AS role
          FROM ids LEFT JOIN users u ON ids.id = u.id LEFT JOIN (SELECT DISTINCT id FROM doctors) d ON ids.id = d.id
          LEFT JOIN (SELECT DISTINCT id FROM admins) a ON ids.id = a.id),
latest AS (SELECT user_id, status, plan_id FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_date DESC, id DESC) AS rn
             FROM user_subscriptions WHERE status <> 'cancelled') WHERE rn = 1)
SELECT ids.id,
  CASE WHEN r.role = 'admin' THEN 'active' WHEN l.user_id IS NOT NULL THEN l.status ELSE 'inactive' END AS status,
  CASE WHEN r.role = 'admin' THEN false WHEN l.user_id IS NOT NULL THEN coalesce(p.is_free, true) ELSE true END AS is_free
FROM ids LEFT JOIN roles r ON ids.id = r.id LEFT JOIN latest l ON ids.id = l.user_id
LEFT JOIN subscription_plans p ON l.plan_id = p.id"""))
def subscription_status(spark, sf):
    """Current subscription status and free flag of every account."""
    u, d, a = S.users(spark, sf), S.doctors(spark, sf), S.admins(spark, sf)
    ids = u.select("id").union(a.select("id")).distinct()
    roles = A.resolve_role(ids, u, d, a, ("users", "doctors", "admins"))
    return A.subscription_status(ids, S.user_subscriptions(spark, sf), S.subscription_plans(spark, sf), roles)


@query("user_kpis", W("""
, r AS (SELECT * FROM records WHERE lower(consultation_type) LIKE '%liver%'),
k AS (SELECT user_id, CAST(count(*) AS BIGINT) AS n_records,
             arg_min(health_score, (created_at, id)) AS first_score, arg_max(health_score, (created_at, id)) AS latest_score
      FROM r GROUP BY 1),
ap AS (SELECT user_id, CAST(count(*) AS BIGINT) AS n_appointments FROM appointments GROUP BY 1)
SELECT coalesce(k.user_id, ap.user_id) AS user_id, coalesce(n_records, 0) AS n_records,
       round_even(first_score, 6) AS first_score, round_even(latest_score, 6) AS latest_score,
       round_even(latest_score - first_score, 6) AS change, round_even(latest_score * 100, 1) AS latest_pct,
       coalesce(n_appointments, 0) AS n_appointments
FROM k FULL JOIN ap ON k.user_id = ap.user_id"""))
def user_kpis(spark, sf):
    """Per-user record KPIs (first, latest, change, percent) and
    appointment count."""
    k = A.user_kpis(S.records(spark, sf), S.appointments(spark, sf))
    return k.select("user_id", "n_records", *[F.bround(c, 6).alias(c) for c in ["first_score", "latest_score", "change"]],
                    "latest_pct", "n_appointments")


def _last_sql(n: int) -> str:
    return W(f"""SELECT conv_id, turn, role, message, CAST(pos AS INTEGER) AS pos FROM (
  SELECT *, count(*) OVER (PARTITION BY conv_id) - row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) + 1
            - greatest(count(*) OVER (PARTITION BY conv_id) - {n}, 0) AS pos,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rd
  FROM chat_history) WHERE rd <= {n}""")


def _last(spark, sf, n):
    return A.last_n(S.chat_history(spark, sf), "conv_id", "turn", n).select("conv_id", "turn", "role", "message", "pos")


@query("last_messages", _last_sql(3))
def last_messages(spark, sf):
    """The last 3 messages of every conversation, in order (fewer than most have)."""
    return _last(spark, sf, 3)


@query("last_messages_10", _last_sql(C.CHAT_HISTORY_LIMIT))
def last_messages_10(spark, sf):
    """The last 10 messages of every conversation, in order."""
    return _last(spark, sf, C.CHAT_HISTORY_LIMIT)


@query("chat_exchanges", W("""SELECT conv_id, turn, message AS user_message, nxt_msg AS bot_reply FROM (
  SELECT *, lead(role) OVER w AS nxt_role, lead(message) OVER w AS nxt_msg FROM chat_history
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nxt_role = 'assistant'"""))
def chat_exchanges(spark, sf):
    """User message paired with the assistant reply right after it."""
    return A.pair_exchanges(S.chat_history(spark, sf))


# ---------------------------------------------------------------- A13, O*, X*

@query("slots_by_doctor", W("""SELECT doctor_id, strftime(available_date, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n_slots,
       string_agg(start_time || '#' || CAST(id AS VARCHAR), ',' ORDER BY start_time || '#' || CAST(id AS VARCHAR)) AS slots
FROM doctor_availability WHERE NOT is_booked GROUP BY 1, 2"""))
def slots_by_doctor(spark, sf):
    """Open slots per doctor and day, with the sorted start times."""
    return A.slots_by_doctor(S.doctor_availability(spark, sf))


@query("slots_sorted", W("""SELECT doctor_id, id, CAST(row_number() OVER (PARTITION BY doctor_id
       ORDER BY available_date, start_time, id) AS BIGINT) AS pos FROM doctor_availability"""))
def slots_sorted(spark, sf):
    """O1: each doctor's slots in ascending (date, start, id) order."""
    s = S.doctor_availability(spark, sf)
    r = A.ordered_within(s, "doctor_id", [F.col("available_date"), F.col("start_time"), F.col("id")],
                         F.date_trunc("month", "available_date"))
    return r.select("doctor_id", "id", "pos")


@query("records_recent", W("""SELECT user_id, id, CAST(row_number() OVER (PARTITION BY user_id
       ORDER BY created_at DESC, id DESC) AS BIGINT) AS pos FROM records"""))
def records_recent(spark, sf):
    """O2: each user's records newest first (created_at desc, id desc)."""
    r = S.records(spark, sf)
    o = A.ordered_within(r, "user_id", [F.col("created_at").desc(), F.col("id").desc()],
                         -F.unix_date(F.to_date("created_at")), nulls_last=True)
    return o.select("user_id", "id", "pos")


SERIES_SQL = """
, s AS (SELECT user_id, id, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS pos,
        strftime(created_at, '%Y-%m') AS month, strftime(created_at, '%Y-%m-%d') AS label, health_score AS score
        FROM records WHERE lower(consultation_type) LIKE '%liver%')"""
SERIES_CHUNK = 1000


@query("chart_series", W(SERIES_SQL + " SELECT user_id, id, CAST(pos AS BIGINT) AS pos, month, label, score FROM s"))
def chart_series(spark, sf):
    """Every liver record of every user as a chart point, newest first."""
    return A.chart_series(S.records(spark, sf)).select("user_id", "id", "pos", "month", "label", "score")


@query("series_json", W(SERIES_SQL + f"""
SELECT user_id, CAST((pos - 1) // {SERIES_CHUNK} AS BIGINT) AS chunk,
       CAST(to_json(list(label ORDER BY pos)) AS VARCHAR) AS labels_json,
       '[' || string_agg(printf('%.4f', score), ',' ORDER BY pos) || ']' AS scores_json,
       CAST(count(*) AS INTEGER) AS n_points
FROM s GROUP BY 1, 2"""))
def series_json(spark, sf):
    """The chart points as JSON arrays, newest first, in chunks of 1,000."""
    return A.series_json(S.records(spark, sf), SERIES_CHUNK)


@query("plan_features", W("""
SELECT id AS plan_id, 0 AS pos, 'Risk scoring' AS feature FROM subscription_plans UNION ALL
SELECT id, 1, 'Chat assistant' FROM subscription_plans WHERE id >= 2 UNION ALL
SELECT id, 2, 'Doctor booking' FROM subscription_plans WHERE id >= 3 UNION ALL
SELECT id, 3, 'Priority support' FROM subscription_plans WHERE id >= 4"""))
def plan_features(spark, sf):
    """One row per listed plan feature."""
    p = S.subscription_plans(spark, sf).select(F.col("id").alias("plan_id"), "features")
    return scalars.explode_list(p, "features", "feature", keep=["plan_id"])


ALIAS_CASE = "CASE lower(trim(consultation_type)) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.MODEL_ALIASES.items()) + f" ELSE '{C.MODEL_ALIAS_DEFAULT}' END"


@query("alias_map", W(f"SELECT id, consultation_type, {ALIAS_CASE} AS model_type FROM records"))
def alias_map(spark, sf):
    """Record type to model type through the alias map, default clinical."""
    r = S.records(spark, sf)
    return r.select("id", "consultation_type", scalars.alias_map("consultation_type").alias("model_type"))


@query("scalar_text", W("""SELECT id, lower(trim('  ' || email || ' ')) AS email_norm,
       upper(substr(coalesce(role, 'n/a'), 1, 1)) || lower(substr(coalesce(role, 'n/a'), 2)) AS role_title,
       coalesce(lower(trim(CAST(id % 3 AS VARCHAR))), '') AS flag_text,
       coalesce(lower(trim(role)), '') AS role_flag
FROM users"""))
def scalar_text(spark, sf):
    """E-mail normalisation, title case, flag text."""
    u = S.users(spark, sf)
    return u.select("id", scalars.normalise_key(F.concat(F.lit("  "), F.col("email"), F.lit(" "))).alias("email_norm"),
                    scalars.title(F.coalesce(F.col("role"), F.lit("n/a"))).alias("role_title"),
                    scalars.text_flag(F.col("id") % 3).alias("flag_text"),
                    scalars.text_flag(F.col("role")).alias("role_flag"))


@query("scalar_casts", W("""SELECT event_id,
  CASE WHEN isnan(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k_float,
  TRY_CAST(event_type AS DOUBLE) AS type_float,
  TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_float
FROM events"""))
def scalar_casts(spark, sf):
    """Tolerant text-to-double over JSON fields, words and numbers."""
    from ..sources.tables import read_table
    e = read_table(spark, sf, "events")
    return e.select("event_id", scalars.to_float(F.get_json_object("props", "$.k")).alias("k_float"),
                    scalars.to_float("event_type").alias("type_float"),
                    scalars.to_float(F.col("value").cast("string")).alias("value_float"))


@query("scalar_dates", W("""SELECT event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed, strftime(ts, '%Y-%m-%d') AS day,
  strftime(ts, '%Y-%m-%d %H:%M') AS minute, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start
FROM events"""))
def scalar_dates(spark, sf):
    """ISO text with 'Z' parsed back, date and minute parts,
    month start."""
    from ..sources.tables import read_table
    e = read_table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    p = scalars.parse_iso_ts(iso)
    return e.select("event_id", F.date_format(p, "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                    scalars.date_part("ts").alias("day"), scalars.minute_part("ts").alias("minute"),
                    F.date_format(scalars.month_start("ts"), "yyyy-MM-dd").alias("month_start"))


@query("slot_times", W("""SELECT id, strftime(available_date, '%Y-%m-%d') || ' ' || start_time AS slot_start,
  strftime(available_date, '%Y-%m-%d') AS strict_day FROM doctor_availability"""))
def slot_times(spark, sf):
    """Strict date parse and date + time to a timestamp."""
    s = S.doctor_availability(spark, sf)
    d = scalars.strict_date(F.date_format("available_date", "yyyy-MM-dd"))
    ts = scalars.date_time(d, F.col("start_time"))
    return s.select("id", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("slot_start"),
                    F.date_format(d, "yyyy-MM-dd").alias("strict_day"))


@query("scalar_math", W("""SELECT id, CAST(trunc(consultation_fee * 100) AS BIGINT) AS fee_minor,
  printf('%.2f', consultation_fee) AS fee_text,
  round_even(1.0 / (1.0 + exp(-(consultation_fee / 1000.0))), 6) AS fee_sigmoid FROM doctors"""))
def scalar_math(spark, sf):
    """Minor units (truncating), money text, sigmoid."""
    d = S.doctors(spark, sf)
    return d.select("id", scalars.minor_units("consultation_fee").alias("fee_minor"),
                    scalars.money_text("consultation_fee").alias("fee_text"),
                    F.bround(scalars.sigmoid(F.col("consultation_fee") / 1000.0), 6).alias("fee_sigmoid"))


@query("json_fallback", W("""SELECT event_id, json_extract_string(props, '$.k') AS k,
  coalesce(nullif(json_extract_string(props, '$.name'), ''), 'user-' || CAST(user_id AS VARCHAR)) AS display_name
FROM events"""))
def json_fallback(spark, sf):
    """Nested JSON field with a fallback when absent or empty."""
    from ..sources.tables import read_table
    e = read_table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"),
                    scalars.json_field_or("props", "$.name",
                                          F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("display_name"))


@query("risk_bands", W(f"""SELECT id, p AS prob,
  CASE WHEN p > {C.RISK_HIGH} THEN 'High' WHEN p > {C.RISK_MEDIUM} THEN 'Medium' ELSE 'Low' END AS risk,
  CASE WHEN p > 0.5 THEN '{C.RESULT_POSITIVE}' ELSE '{C.RESULT_NEGATIVE}' END AS result
FROM (SELECT id, round_even(health_score, 4) AS p FROM records)"""))
def risk_bands(spark, sf):
    """Half-even 4-place probability, risk band, result text."""
    r = S.records(spark, sf)
    p = rules.round_prob("health_score")
    return r.select("id", p.alias("prob"), rules.risk_band(p).alias("risk"),
                    rules.result_text((p > 0.5).cast("int")).alias("result"))


# ---------------------------------------------------------------- daily quantile sketches (A10)

SHARES = [0.25, 0.5, 0.75]


@query("daily_quantiles", W(f"""
, r AS (SELECT CAST(created_at AS DATE) AS day, health_score AS v FROM records WHERE health_score IS NOT NULL),
a AS (SELECT day, count(*) AS n FROM r GROUP BY day UNION ALL SELECT NULL, count(*) FROM r)
SELECT day, CAST(p AS DOUBLE) AS p, CAST(n AS BIGINT) AS n, true AS within FROM a, unnest({SHARES}) t(p) WHERE n > 0"""))
def daily_quantiles(spark, sf_dir):
    """A10: a sketch a day, stored a day at a time (the first one twice), asked a
    day and merged over all days (null day); whether the exact rank of every
    answer is as close as the sketch promises (four times its 99% bound)."""
    r = S.records(spark, sf_dir).select(F.col("created_at").cast("date").alias("day"), F.col("health_score").alias("v"))
    days = checkpoint_table(K.daily_sketches(r, F.col("day"), [], "v"), "daily_sketches")
    path = scratch_path(spark, "stored_sketches")
    names = [x["day"] for x in days.select("day").distinct().orderBy("day").collect()]  # a row a day
    for d in [*names, *names[:1]]:
        K.store_day(days.where(F.col("day") == F.lit(d)), path, str(d))
    held = K.stored(spark, path, days.schema)
    whole = K.merged(held.withColumn("day", F.lit(None).cast("date")), ["day"])
    asked = K.quantiles(held, ["day"], SHARES).unionByName(K.quantiles(whole, ["day"], SHARES))
    rows = r.where("v is not null").withColumn("day", F.explode(F.array("day", F.lit(None).cast("date"))))
    met = rows.join(F.broadcast(asked.withColumnRenamed("day", "d")), F.col("day").eqNullSafe(F.col("d")))  # three rows a day
    exact = met.groupBy("day", "p").agg(F.count("*").alias("n"), F.count_if(F.col("v") < F.col("q")).alias("below"),
                                        F.count_if(F.col("v") <= F.col("q")).alias("upto"))
    slack = F.lit(4 * K.rank_error()) * F.col("n") + 1
    return exact.select("day", "p", "n", ((F.col("below") <= F.col("p") * F.col("n") + slack)
                                          & (F.col("upto") >= F.col("p") * F.col("n") - slack)).alias("within"))
