"""Stand-in inputs built from the driver's tables.

The source application reads survey modules (one row per participant) and
operational tables (users, appointments, ...). None ship with it, so these
builders derive rows *of those schemas* from the TPC-H-like test tables.
They do none of the operators' work: every rule, join and aggregate that a
query names runs on these rows in ``operators``/``functions``/``ml``.

Each survey module is its own DataFrame keyed by ``SEQN``. The orders-based
modules come from one conditional aggregate over ``orders`` and the
lineitem-based ones from one over ``lineitem JOIN orders``, so the
stand-ins cost two scans and two shuffles regardless of how many modules
are cut from them (Spark reuses the exchange for every module).
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path, shared_dir
from .tables import file_listing, load_module, path_exists, publish, read_table, table_path, written_table


def _scalar_count(df: DataFrame) -> Column:
    """Row count as a scalar-subquery column (evaluated once, no cross join)."""
    return df.select(F.count(F.lit(1))).scalar()


# ------------------------------------------------------------------ modules

def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEMO module: one row per participant, plus a string category."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("SEQN"),
        (F.lit(18) + F.col("c_custkey") % 63).alias("RIDAGEYR"),
        (F.lit(1) + F.col("c_custkey") % 2).alias("RIAGENDR"),
        (F.lit(1) + F.col("c_nationkey") % 5).alias("RIDRETH3"),
        (F.lit(1) + (F.col("c_nationkey") * 3) % 5).alias("DMDEDUC2"),
        F.col("c_mktsegment").alias("SEGMENT"),
    )


def _orders_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    pr, st, k, p = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_totalprice")

    def on(cond, agg, x):
        return agg(F.when(cond, x))

    return o.groupBy(F.col("o_custkey").alias("SEQN")).agg(
        F.count_if(pr == "1-URGENT").alias("n_bmx"),
        on(pr == "1-URGENT", F.max, p).alias("bmx_max"),
        on(pr == "1-URGENT", F.min, p).alias("bmx_min"),
        F.count_if(pr == "2-HIGH").alias("n_smq"),
        on(pr == "2-HIGH", F.min, k).alias("smq_min"),
        on(pr == "2-HIGH", F.max, k).alias("smq_max"),
        F.count_if(pr == "3-MEDIUM").alias("n_alq"),
        on(pr == "3-MEDIUM", F.max, k).alias("alq_max"),
        F.count_if(pr == "4-NOT SPECIFIED").alias("n_diq"),
        on(pr == "4-NOT SPECIFIED", F.max, k).alias("diq_max"),
        F.count_if(pr == "5-LOW").alias("n_bpq"),
        on(pr == "5-LOW", F.max, k).alias("bpq_max"),
        F.count_if(st == "F").alias("n_mcq"),
        on(st == "F", F.min, k).alias("mcq_min"),
    )


def _lineitem_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    a, n, r = rf == "A", rf == "N", rf == "R"
    lo, lf = ls == "O", ls == "F"
    return j.groupBy(F.col("o_custkey").alias("SEQN")).agg(
        F.count_if(a).alias("n_cbc"),
        F.min(F.when(a, F.col("l_extendedprice"))).alias("cbc_min"),
        F.count_if(n).alias("n_glu"),
        F.min(F.when(n, F.col("l_quantity"))).alias("glu_min"),
        F.count_if(r).alias("n_ghb"),
        F.min(F.when(r, F.col("l_discount"))).alias("ghb_min"),
        F.count_if(lo).alias("n_hdl"),
        F.max(F.when(lo, F.col("l_suppkey") * 7)).alias("hdl_max"),
        F.count_if(lf).alias("n_tch"),
        F.max(F.when(lf, F.col("l_partkey") * 7)).alias("tch_max"),
        F.count_if(a & lo).alias("n_tri"),
        F.max(F.when(a & lo, F.col("l_orderkey") * 7)).alias("tri_max"),
    )


def survey_modules(spark: SparkSession, sf_dir: str, absent: tuple = (),
                   materialize: bool = True, buckets: int | None = None) -> dict:
    """Module name -> DataFrame(SEQN, columns...), or ``None`` when absent.

    With ``materialize`` (default) the modules are written once per input
    folder as parquet files in the shared folder and then loaded through
    ``load_module`` like real module files; otherwise they are lazy plans.
    With ``buckets`` they are catalog tables bucketed and sorted by SEQN into
    that many buckets, so the 12-way join reads co-partitioned buckets and
    needs no shuffle at all.
    """
    if not materialize and not buckets:
        return _module_plans(spark, sf_dir, absent)
    paths = module_files(spark, sf_dir)
    # the files of an input never change once they are in place, so their frames are resolved once a session
    held = _RESOLVED.setdefault(spark, {})
    key = (paths["DEMO"], buckets)
    if key not in held:
        held[key] = module_tables(spark, paths, buckets) if buckets else {m: load_module(spark, p) for m, p in paths.items()}
    return held[key] | dict.fromkeys(absent)


_RESOLVED: WeakKeyDictionary = WeakKeyDictionary()


WRITERS = 4  # modules written at a time


def side_by_side(write, names: list) -> None:
    """``write(name)`` for every name, several at a time: most modules are small,
    and a job's last tasks leave room for the next one's."""
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(write, names))


def module_files(spark: SparkSession, sf_dir: str) -> dict:
    """Write every stand-in module to ``<shared>/standins/<key>/<MODULE>``
    once (two aggregates over orders/lineitem feed all twelve) and return
    the paths. ``key`` changes when the input files change."""
    sig = [f for t in ("customer", "orders", "lineitem") for f in file_listing(spark, table_path(sf_dir, t))]
    key = hashlib.sha1("|".join(sig).encode()).hexdigest()[:16]
    base = f"{shared_dir(spark).rstrip('/')}/standins/{key}"
    names = ["DEMO", *MODULE_ORDER]
    if not path_exists(spark, base):
        fresh = scratch_path(spark, "standins")
        # Both measure aggregates feed six modules each: they are written once, in
        # as few files as their rows are worth, and the modules cut from them side by side.
        om, om_path = written_table(_orders_measures(spark, sf_dir), "orders_measures")
        lm, lm_path = written_table(_lineitem_measures(spark, sf_dir), "lineitem_measures")
        try:
            plans = _module_plans(spark, sf_dir, (), om, lm)
            side_by_side(lambda m: plans[m].write.parquet(f"{fresh}/{m}"), names)
        finally:
            for path in (om_path, lm_path):
                drop_path(spark, path)
        publish(spark, fresh, base)
    return {m: f"{base}/{m}" for m in names}


def module_tables(spark: SparkSession, paths: dict, buckets: int) -> dict:
    """Module files rewritten, bucketed and sorted by SEQN.

    Files live under the shared folder (written once per input and bucket
    count). A catalog entry gives them their bucket spec, so that the join
    planner sees matching bucketing on every side; it is dropped as soon as
    the plan over it is resolved, so none is left behind.
    """
    base = paths["DEMO"].rsplit("/", 1)[0] + f"-bucketed{buckets}"
    fresh = None if path_exists(spark, base) else scratch_path(spark, "bucketed")
    if fresh:
        def bucketed(m: str) -> None:
            name = f"cohortlab_{uuid.uuid4().hex}"
            (load_module(spark, paths[m]).write.bucketBy(buckets, "SEQN").sortBy("SEQN")
             .option("path", f"{fresh}/{m}").saveAsTable(name))
            spark.sql(f"DROP TABLE {name}")

        side_by_side(bucketed, list(paths))
        publish(spark, fresh, base)
    out = {}
    for m in paths:
        name = f"cohortlab_{uuid.uuid4().hex}"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{base}/{m}").schema.fields)
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet "
                  f"CLUSTERED BY (SEQN) SORTED BY (SEQN) INTO {buckets} BUCKETS LOCATION '{base}/{m}'")
        out[m] = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return out


MODULE_ORDER = ["BMX", "SMQ", "ALQ", "DIQ", "BPQ", "MCQ", "CBC", "GLU", "GHB", "HDL", "TCHOL", "TRIGLY"]


def _module_plans(spark: SparkSession, sf_dir: str, absent: tuple = (), om=None, lm=None) -> dict:
    om = om if om is not None else _orders_measures(spark, sf_dir)
    lm = lm if lm is not None else _lineitem_measures(spark, sf_dir)
    one = F.lit(1)
    mods = {
        "DEMO": spine(spark, sf_dir),
        "BMX": om.where("n_bmx > 0").select(
            "SEQN",
            F.round(F.lit(18) + F.col("bmx_max") / 25000, 1).alias("BMXBMI"),
            F.round(F.lit(60) + F.col("bmx_min") / 5000, 1).alias("BMXWAIST")),
        "SMQ": om.where("n_smq > 0").select(
            "SEQN", (one + F.col("smq_min") % 2).alias("SMQ020"),
            (one + F.col("smq_max") % 2).alias("SMQ040")),
        "ALQ": om.where("n_alq > 0").select("SEQN", (one + F.col("alq_max") % 6).alias("ALQ130")),
        "DIQ": om.where("n_diq > 0").select("SEQN", (one + F.col("diq_max") % 3).alias("DIQ010")),
        "BPQ": om.where("n_bpq > 0").select("SEQN", (one + F.col("bpq_max") % 2).alias("BPQ020")),
        "MCQ": om.where("n_mcq > 0").select("SEQN", (one + F.col("mcq_min") % 2).alias("MCQ160E")),
        "CBC": lm.where("n_cbc > 0").select(
            "SEQN", (F.lit(100) + F.floor(F.col("cbc_min") / 50)).cast("bigint").alias("LBXPLTSI")),
        "GLU": lm.where("n_glu > 0").select(
            "SEQN", (F.lit(70) + F.col("glu_min") * 10).alias("LBXGLU")),
        "GHB": lm.where("n_ghb > 0").select(
            "SEQN", F.round(F.lit(4.5) + F.col("ghb_min") * 40, 1).alias("LBXGH")),
        "HDL": lm.where("n_hdl > 0").select(
            "SEQN", (F.lit(30) + F.col("hdl_max") % 40).alias("LBDHDD")),
        "TCHOL": lm.where("n_tch > 0").select(
            "SEQN", (F.lit(150) + F.col("tch_max") % 150).alias("LBXTC")),
        "TRIGLY": lm.where("n_tri > 0").select(
            "SEQN", (F.lit(60) + F.col("tri_max") % 150).alias("LBXTLG")),
    }
    for m in absent:
        mods[m] = None
    return mods


# -------------------------------------------------------- operational tables

def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    first = read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")) \
        .agg(F.min("o_orderdate").alias("d"))
    return c.join(first, c.c_custkey == first.k, "left").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string"))
         .when(F.col("c_mktsegment") == "MACHINERY", F.lit("doctor"))
         .otherwise(F.lit("user")).alias("role"),
        F.col("d").alias("created_at"),
    )


def doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.where(F.col("s_suppkey") % 4 != 0).select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_suppkey") * 3).alias("user_id"),
        F.concat(F.lit("SPEC_"), F.col("s_nationkey").cast("string")).alias("specialization"),
        F.concat(F.lit("Profile of "), F.col("s_name")).alias("bio"),
        F.col("s_acctbal").alias("consultation_fee"),
    )


def admins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").where(F.col("c_custkey") % 97 == 0)
    # each of them twice: as a user, and under an id that no user has
    c = c.withColumn("c_custkey", F.explode(F.array("c_custkey", F.col("c_custkey") + ADMIN_OFFSET)))
    return c.select(
        F.col("c_custkey").alias("id"),
        F.lower("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
    )


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    nsup = _scalar_count(read_table(spark, sf_dir, "supplier"))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderkey") % nsup).alias("doctor_id"),
        F.col("o_orderdate").alias("appointment_time"),
        F.when(F.col("o_orderstatus") == "F", "completed")
         .when(F.col("o_orderstatus") == "O", "pending").otherwise("cancelled").alias("status"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://meet.example.com/"),
                             F.col("o_orderkey").cast("string"))).alias("meeting_url"),
    )


def doctor_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    nsup = _scalar_count(read_table(spark, sf_dir, "supplier"))
    hour = F.lit(8) + F.col("o_orderkey") % 10
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") % nsup).alias("doctor_id"),
        F.col("o_orderdate").cast("date").alias("available_date"),
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")).alias("start_time"),
        F.concat(F.lpad((hour + 1).cast("string"), 2, "0"), F.lit(":00:00")).alias("end_time"),
        (F.col("o_orderstatus") == "F").alias("is_booked"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.col("event_id").alias("id"),
        "user_id",
        F.when(et == "view", "liver_clinical").when(et == "click", "Liver_Lifestyle")
         .when(et == "purchase", "liver").otherwise(et).alias("consultation_type"),
        (F.col("value") / 500).alias("health_score"),
        F.col("ts").alias("created_at"),
    )


def user_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("plan_id"),
        F.when(F.col("o_orderstatus") == "F", "cancelled")
         .when(F.col("o_orderstatus") == "O", "active").otherwise("pending").alias("status"),
        F.col("o_orderdate").alias("start_date"),
    )


def subscription_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plan per order priority, with attributes derived from the orders
    of that priority (so the table is read, not made up)."""
    o = read_table(spark, sf_dir, "orders")
    g = o.groupBy(F.substring("o_orderpriority", 1, 1).cast("int").alias("id")).agg(
        F.min("o_orderpriority").alias("prio"),
        F.min("o_totalprice").alias("minp"),
    )
    pid = F.col("id")
    price = F.when(pid == 1, F.lit("0.00")).otherwise(
        F.concat((F.floor(F.col("minp")) % 100 + pid * 10).cast("bigint").cast("string"), F.lit(".99")))
    features = F.filter(F.array(F.lit("Risk scoring"),
                                F.when(pid >= 2, F.lit("Chat assistant")),
                                F.when(pid >= 3, F.lit("Doctor booking")),
                                F.when(pid >= 4, F.lit("Priority support"))),
                        lambda x: x.isNotNull())
    return g.select(
        pid,
        F.concat(F.upper(F.substring(F.col("prio"), 3, 1)),
                 F.lower(F.substring(F.col("prio"), 4, 100))).alias("name"),
        price.alias("price"),
        (pid * 30).alias("duration_days"),
        (pid == 1).alias("is_free"),
        (pid != 5).alias("is_active"),
        F.concat(F.lit("Plan for priority "), F.col("prio")).alias("description"),
        features.alias("features"),
    )


ENDPOINT_OF_EVENT = {"view": "predict", "click": "chat", "purchase": "book_appointment"}


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: (id, user_id, endpoint, ts)."""
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    ep = et
    for k, v in ENDPOINT_OF_EVENT.items():
        ep = F.when(et == k, F.lit(v)).otherwise(ep)
    return e.select(F.col("event_id").alias("id"), "user_id", ep.alias("endpoint"), "ts")


ADMIN_OFFSET = 10_000_000


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log with visitors: (id, user_id, session_id, endpoint, ts).

    A fifth of the requests has no user; some come from administrators that
    are no users; a few have neither user nor session."""
    r = requests(spark, sf_dir)
    anonymous = F.col("id") % 5 == 0
    admin = (F.col("id") % 5 == 1) & (F.col("user_id") % 97 == 0)
    return r.select(
        "id",
        F.when(anonymous, F.lit(None)).when(admin, F.col("user_id") + ADMIN_OFFSET).otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("id") % 100 != 0, F.concat(F.lit("s"), F.col("user_id").cast("string"))).alias("session_id"),
        "endpoint", "ts")


def booking_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booking requests (id, user_id, slot_id, ts): none to three for each slot,
    the third sometimes for a slot that does not exist."""
    s = doctor_availability(spark, sf_dir).select("id", "doctor_id", "available_date", F.explode(
        F.sequence(F.lit(1), F.col("id") % 4)).alias("k")).where((F.col("id") % 4 >= F.col("k")) & (F.col("k") > 0))
    return s.select((F.col("id") * 4 + F.col("k")).alias("id"), (F.col("doctor_id") + F.col("k")).alias("user_id"),
                    F.when((F.col("k") == 3) & (F.col("id") % 8 == 3), -F.col("id")).otherwise(F.col("id")).alias("slot_id"),
                    (F.col("available_date").cast("timestamp") + F.make_dt_interval(hours=(F.col("k") * 5 % 3).cast("int"))).alias("ts"))


def cancel_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancel requests (id, user_id) for two fifths of the subscriptions, half
    of them by someone else than the owner."""
    s = user_subscriptions(spark, sf_dir).where(F.col("id") % 5 < 2)
    return s.select("id", (F.col("user_id") + F.col("id") % 5).alias("user_id"))


def chat_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    return c.where(F.col("role") != "system").select(
        "conv_id", "turn", "role", F.col("text").alias("message"))
