"""Activity analytics over users, doctors, appointments, slots, records,
subscriptions and chat messages (A1, A4-A6, A13, J3-J10, W1-W3, W10,
P8-P11, O1-O4, X23).

The source answers these one web request (one user) at a time; here each is
one job over all users. Per-key "latest"/"first" picks are ``max_by`` /
``min_by`` aggregates (map-side partial aggregation: a user with a third of
all rows is reduced on every mapper first), and per-key orderings use
``salted_row_number`` so a hot key is numbered by many tasks.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import rules, scalars
from .ordered import salted_row_number


# ---------------------------------------------------------------- A1, A4-A6

def table_counts(tables: dict) -> DataFrame:
    """A1: row count of several tables as one row (one aggregate each, joined
    as scalar subqueries — no ids are fetched)."""
    items = list(tables.items())
    first_name, first = items[0]
    out = first.agg(F.count(F.lit(1)).alias(first_name))
    return out.select(first_name, *[df.select(F.count(F.lit(1))).scalar().alias(n) for n, df in items[1:]])


def count_by(df: DataFrame, c: str, default: str, name: str | None = None) -> DataFrame:
    """A4: group count with a default label for missing values."""
    name = name or c
    return df.groupBy(F.coalesce(F.col(c), F.lit(default)).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def count_by_bucket(records: DataFrame, type_col: str = "consultation_type") -> DataFrame:
    """A5: counts per record-type bucket."""
    return records.groupBy(rules.type_bucket(type_col).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def since(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """Rows with ``ts >= as_of - days`` (``as_of`` is an argument, never
    the clock). The predicate is a literal bound, so it reaches the scan."""
    lo = F.to_timestamp(F.lit(as_of)) - F.make_interval(days=F.lit(days))
    return df.where(F.col(ts) >= lo)


def daily_counts(df: DataFrame, ts: str, name: str = "n") -> DataFrame:
    """(day, n) with the day as 'yyyy-MM-dd' text."""
    return df.groupBy(F.date_format(F.col(ts), "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias(name))


def align_series(a: DataFrame, b: DataFrame, on: str = "day") -> DataFrame:
    """Full outer join on the union of keys, 0 where a side is missing."""
    j = a.join(b, on=on, how="full")
    vals = [c for c in a.columns + b.columns if c != on]
    return j.select(on, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in vals])


def daily_activity(users: DataFrame, appts: DataFrame, as_of: str, days: int = C.TRAILING_DAYS) -> DataFrame:
    """Registrations and appointments per day over the trailing window,
    aligned on the union of days."""
    reg = daily_counts(since(users, "created_at", as_of, days), "created_at", "registrations")
    app = daily_counts(since(appts, "appointment_time", as_of, days), "appointment_time", "appointments")
    return align_series(reg, app, "day")


# ---------------------------------------------------------------- P8, P10, P11

def slots_open(slots: DataFrame) -> DataFrame:
    """Slots not yet booked."""
    return slots.where(~F.col("is_booked"))


def plans_active(plans: DataFrame) -> DataFrame:
    """Active plans with a numeric price for ordering."""
    return plans.where(F.col("is_active")).withColumn("price_num", scalars.to_float("price"))


def records_of_kind(records: DataFrame, kind: str = C.BUCKET_LIVER, col: str = "consultation_type") -> DataFrame:
    """P10: case-insensitive substring filter."""
    return records.where(F.lower(F.col(col)).contains(kind.lower()))


def joinable(df: DataFrame, as_of: str, ts: str = "appointment_time", url: str = "meeting_url",
             minutes: int = C.JOIN_WINDOW_MINUTES) -> DataFrame:
    """P11: 'Join Meeting' when ``ts <= as_of <= ts + minutes`` and a URL is
    present, 'Meeting Link Ready' with a URL otherwise, else 'N/A'."""
    now = F.to_timestamp(F.lit(as_of))
    window = (now >= F.col(ts)) & (now <= F.col(ts) + F.make_interval(mins=F.lit(minutes)))
    label = (F.when(F.col(url).isNull() | (F.col(url) == ""), F.lit(C.NOT_AVAILABLE))
              .when(F.coalesce(window, F.lit(False)), F.lit("Join Meeting"))
              .otherwise(F.lit("Meeting Link Ready")))
    return df.withColumn("join_status", label)


# ---------------------------------------------------------------- J3-J8

def with_plan(subs: DataFrame, plans: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """To-one embed of the plan's columns (left join on plan id)."""
    cols = cols or ["name", "price", "is_free"]
    p = plans.select(F.col("id").alias("__pid"), *[F.col(c).alias(f"plan_{c}") for c in cols])
    return subs.join(p, F.col("plan_id") == F.col("__pid"), "left").drop("__pid")


def lookup(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, cols: dict) -> DataFrame:
    """Left lookup join; ``cols`` maps dim column -> (output name, default)."""
    d = dim.select(F.col(dim_key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in cols])
    j = df.join(d, F.col(left_key) == F.col("__k"), "left")
    return j.select(*df.columns, *[F.coalesce(F.col(f"__{c}"), F.lit(dflt)).alias(out)
                                   for c, (out, dflt) in cols.items()])


def restrict_to(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str) -> DataFrame:
    """Dimension rows whose key appears in the fact table (semi join;
    no distinct list is collected)."""
    return dim.join(fact.select(F.col(fact_key).alias("__k")), F.col(dim_key) == F.col("__k"), "left_semi")


def merge_rows(a: DataFrame, b: DataFrame, a_key: str, b_key: str, how: str = "inner") -> DataFrame:
    """``{**a, **b}`` per key: b's value wins on shared names.
    Deviation: a null in b does not overwrite a's value."""
    shared = [c for c in b.columns if c in a.columns and c != b_key]
    bb = b.select(*[F.col(c).alias(f"__b_{c}") for c in b.columns])
    j = a.join(bb, F.col(a_key) == F.col(f"__b_{b_key}"), how)
    out = [F.coalesce(F.col(f"__b_{c}"), F.col(c)).alias(c) if c in shared else F.col(c) for c in a.columns]
    out += [F.col(f"__b_{c}").alias(c) for c in b.columns if c not in shared and c != b_key]
    return j.select(*out)


def only_new(cands: DataFrame, base: DataFrame, cand_col: str, base_col: str) -> DataFrame:
    """Candidates whose normalised key is not yet known (anti join)."""
    c = cands.withColumn("__k", scalars.normalise_key(cand_col))
    b = base.select(scalars.normalise_key(base_col).alias("__k"))
    return c.join(b, "__k", "left_anti").withColumnRenamed("__k", "normalised")


def resolve_role(ids: DataFrame, users: DataFrame, doctors: DataFrame, admins: DataFrame,
                 order: tuple = ("users", "doctors", "admins"), id_col: str = "id") -> DataFrame:
    """Role by table precedence. ``users`` gives its stored role (null
    read as the default 'user'); ``doctors``/``admins`` give 'doctor'/'admin'
    by presence of the id; no match gives 'user'. Three left joins to
    de-duplicated key sets + ``coalesce`` in the requested order."""
    u = users.select(F.col("id").alias("__u"), F.coalesce("role", F.lit(C.DEFAULT_ROLE)).alias("__urole")) \
        .dropDuplicates(["__u"])
    d = doctors.select(F.col("id").alias("__d")).distinct()
    a = admins.select(F.col("id").alias("__a")).distinct()
    j = (ids.join(u, F.col(id_col) == F.col("__u"), "left")
            .join(d, F.col(id_col) == F.col("__d"), "left")
            .join(a, F.col(id_col) == F.col("__a"), "left"))
    src = {"users": F.col("__urole"),
           "doctors": F.when(F.col("__d").isNotNull(), F.lit("doctor")),
           "admins": F.when(F.col("__a").isNotNull(), F.lit("admin"))}
    role = F.coalesce(*[src[t] for t in order], F.lit(C.DEFAULT_ROLE))
    return j.select(*ids.columns, role.alias("role"))


# ---------------------------------------------------------------- W1-W3, W10

def subscription_status(ids: DataFrame, subs: DataFrame, plans: DataFrame, roles: DataFrame,
                        id_col: str = "id") -> DataFrame:
    """Per id, status and is_free of the latest non-cancelled
    subscription (start date desc, then id desc); none gives
    ('inactive', true); a missing plan reads as free; admins get
    ('active', false)."""
    live = subs.where(F.col("status") != "cancelled") \
        .withColumn("__o", F.struct(F.col("start_date"), F.col("id")))
    latest = live.groupBy("user_id").agg(F.max_by(F.struct("status", "plan_id"), F.col("__o")).alias("__s"))
    latest = latest.select("user_id", F.col("__s.status").alias("__status"), F.col("__s.plan_id").alias("__plan"))
    p = plans.select(F.col("id").alias("__pid"), F.col("is_free").alias("__free"))
    j = (ids.join(roles.select(F.col(id_col).alias("__rid"), F.col("role").alias("__role")),
                  F.col(id_col) == F.col("__rid"), "left")
            .join(latest, F.col(id_col) == F.col("user_id"), "left")
            .join(p, F.col("__plan") == F.col("__pid"), "left"))
    admin = F.coalesce(F.col("__role") == "admin", F.lit(False))
    has = F.col("user_id").isNotNull()
    status = F.when(admin, "active").when(has, F.col("__status")).otherwise("inactive")
    is_free = F.when(admin, False).when(has, F.coalesce(F.col("__free"), F.lit(True))).otherwise(True)
    return j.select(*ids.columns, status.alias("status"), is_free.alias("is_free"))


def user_kpis(records: DataFrame, appts: DataFrame) -> DataFrame:
    """Per user over liver records: count, first (oldest) and latest
    score, change = latest - first, latest in percent (X12); plus the
    appointment count. min_by/max_by on (created_at, id)."""
    r = records_of_kind(records)
    o = F.struct(F.col("created_at"), F.col("id"))
    k = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_records"),
                                 F.min_by("health_score", o).alias("first_score"),
                                 F.max_by("health_score", o).alias("latest_score"))
    a = appts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_appointments"))
    j = k.join(a, "user_id", "full")
    return j.select("user_id", F.coalesce("n_records", F.lit(0)).alias("n_records"),
                    "first_score", "latest_score",
                    (F.col("latest_score") - F.col("first_score")).alias("change"),
                    scalars.percent1(F.col("latest_score")).alias("latest_pct"),
                    F.coalesce("n_appointments", F.lit(0)).alias("n_appointments"))


def last_n(df: DataFrame, key: str, order: str, n: int, slice_width: int = 64) -> DataFrame:
    """The last ``n`` rows per key in ascending order, with ``pos`` 1..k.

    Rank from the end = count - rank from the start; both come from
    ``salted_row_number`` (slices of ``slice_width`` order values), so a
    conversation of any length is numbered by many tasks. Short groups are
    kept whole (unlike a negative slice on an array).
    """
    r = salted_row_number(df, [key], [F.col(order)], F.floor(F.col(order) / slice_width), name="__rn", total="__cnt")
    keep = r.where(F.col("__rn") > F.col("__cnt") - n)
    return keep.withColumn("pos", (F.col("__rn") - F.greatest(F.col("__cnt") - n, F.lit(0))).cast("int")) \
        .drop("__rn", "__cnt")


def pair_exchanges(history: DataFrame, key: str = "conv_id", order: str = "turn",
                   slice_width: int = 64) -> DataFrame:
    """A user message with the reply that directly follows it.

    ``lead`` as an equi-join: messages are numbered per conversation
    (salted), then row k joins row k+1 on (conversation, number) — a unique
    key, so no group is skewed."""
    r = salted_row_number(history, [key], [F.col(order)], F.floor(F.col(order) / slice_width), name="__rn")
    u = r.where(F.col("role") == "user").select(key, order, "__rn", F.col("message").alias("user_message"))
    b = r.where(F.col("role") == "assistant").select(F.col(key).alias("__k2"), (F.col("__rn") - 1).alias("__rn2"),
                                                     F.col("message").alias("bot_reply"))
    j = u.join(b, F.col(key).eqNullSafe(F.col("__k2")) & (F.col("__rn") == F.col("__rn2")), "inner")
    return j.select(key, order, "user_message", "bot_reply")


# ---------------------------------------------------------------- A13, O*, X23

def slots_by_doctor(slots: DataFrame) -> DataFrame:
    """Open slots grouped per (doctor, day): count and the sorted start
    times as text. A doctor's day holds a bounded number of bookable slots,
    so the per-group list is bounded by the calendar, not by the data."""
    s = slots_open(slots)
    g = s.groupBy("doctor_id", F.date_format("available_date", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n_slots"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("#", "start_time", F.col("id").cast("string")))),
                     ",").alias("slots"))
    return g


def ordered_within(df: DataFrame, key: str, order: list[Column], slice_col: Column, name: str = "pos",
                   nulls_last: bool = False) -> DataFrame:
    """O1/O2: per-key position after sorting (exact, salted by ``slice_col``)."""
    return salted_row_number(df, [key], order, slice_col, name=name, nulls_last=nulls_last)


def chart_series(records: DataFrame) -> DataFrame:
    """The points of the charts: every liver record of every user, newest
    first, as (user_id, pos, month, label, score). One row per point, so a
    user's history of any length takes no list."""
    r = records_of_kind(records)
    o = ordered_within(r, "user_id", [F.col("created_at").desc_nulls_last(), F.col("id").desc()],
                       -F.unix_date(F.to_date("created_at")), nulls_last=True)
    return o.select("user_id", "pos", F.date_format("created_at", "yyyy-MM").alias("month"),
                    F.date_format("created_at", "yyyy-MM-dd").alias("label"), F.col("health_score").alias("score"), "id")


def series_json(records: DataFrame, chunk: int = 1000) -> DataFrame:
    """The same points as JSON arrays of labels and scores (4 places),
    newest first, in numbered chunks of at most ``chunk`` points per user, so
    that no list grows with the data: (user_id, chunk, labels_json,
    scores_json, n_points)."""
    pts = chart_series(records).withColumn("chunk", F.floor((F.col("pos") - 1) / chunk).cast("long"))
    g = pts.groupBy("user_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "label", "score"))).alias("pts"))
    return g.select("user_id", "chunk", scalars.json_string_array(F.col("pts.label")).alias("labels_json"),
                    scalars.json_number_array(F.col("pts.score"), 4).alias("scores_json"),
                    F.size("pts").alias("n_points"))
