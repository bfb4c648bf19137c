"""DuckDB SQL shared by the oracle strings.

These fragments rebuild the stand-in inputs (``sources.standins``) and the
expected results independently of Spark. Tables ``customer orders lineitem
supplier events conversations`` are views registered by the checker.
"""

# Stand-in survey modules and the left-join chain onto the spine.
MODULE_CTES = """
li AS (SELECT o.o_custkey AS ck, l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
bmx AS (SELECT o_custkey AS SEQN, round(18 + max(o_totalprice) / 25000, 1) AS BMXBMI,
               round(60 + min(o_totalprice) / 5000, 1) AS BMXWAIST
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
smq AS (SELECT o_custkey AS SEQN, 1 + min(o_orderkey) % 2 AS SMQ020, 1 + max(o_orderkey) % 2 AS SMQ040
        FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1),
alq AS (SELECT o_custkey AS SEQN, 1 + max(o_orderkey) % 6 AS ALQ130 FROM orders WHERE o_orderpriority = '3-MEDIUM' GROUP BY 1),
diq AS (SELECT o_custkey AS SEQN, 1 + max(o_orderkey) % 3 AS DIQ010 FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' GROUP BY 1),
bpq AS (SELECT o_custkey AS SEQN, 1 + max(o_orderkey) % 2 AS BPQ020 FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),
mcq AS (SELECT o_custkey AS SEQN, 1 + min(o_orderkey) % 2 AS MCQ160E FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
cbc AS (SELECT ck AS SEQN, CAST(100 + floor(min(l_extendedprice) / 50) AS BIGINT) AS LBXPLTSI FROM li WHERE l_returnflag = 'A' GROUP BY 1),
glu AS (SELECT ck AS SEQN, 70 + min(l_quantity) * 10 AS LBXGLU FROM li WHERE l_returnflag = 'N' GROUP BY 1),
ghb AS (SELECT ck AS SEQN, round(4.5 + min(l_discount) * 40, 1) AS LBXGH FROM li WHERE l_returnflag = 'R' GROUP BY 1),
hdl AS (SELECT ck AS SEQN, 30 + max(l_suppkey * 7) % 40 AS LBDHDD FROM li WHERE l_linestatus = 'O' GROUP BY 1),
tch AS (SELECT ck AS SEQN, 150 + max(l_partkey * 7) % 150 AS LBXTC FROM li WHERE l_linestatus = 'F' GROUP BY 1),
tri AS (SELECT ck AS SEQN, 60 + max(l_orderkey * 7) % 150 AS LBXTLG FROM li WHERE l_returnflag = 'A' AND l_linestatus = 'O' GROUP BY 1),
demo AS (SELECT c_custkey AS SEQN, 18 + c_custkey % 63 AS RIDAGEYR, 1 + c_custkey % 2 AS RIAGENDR,
                1 + c_nationkey % 5 AS RIDRETH3, 1 + (c_nationkey * 3) % 5 AS DMDEDUC2, c_mktsegment AS SEGMENT
         FROM customer)
"""

COHORT_SELECT = """
SELECT demo.*, BMXBMI, BMXWAIST, SMQ020, SMQ040, ALQ130, DIQ010, BPQ020, MCQ160E,
       LBXPLTSI, LBXGLU, LBXGH, LBDHDD, LBXTC, LBXTLG
FROM demo
LEFT JOIN bmx USING (SEQN) LEFT JOIN smq USING (SEQN) LEFT JOIN alq USING (SEQN)
LEFT JOIN diq USING (SEQN) LEFT JOIN bpq USING (SEQN) LEFT JOIN mcq USING (SEQN)
LEFT JOIN cbc USING (SEQN) LEFT JOIN glu USING (SEQN) LEFT JOIN ghb USING (SEQN)
LEFT JOIN hdl USING (SEQN) LEFT JOIN tch USING (SEQN) LEFT JOIN tri USING (SEQN)
"""

METABOLIC = "coalesce(BMXBMI > 30 OR LBXGLU > 140 OR LBXGH > 6.5 OR DIQ010 = 1, false)"
LIPID = ("coalesce((RIAGENDR = 1 AND LBDHDD < 40) OR (RIAGENDR = 2 AND LBDHDD < 50) "
         "OR LBXTLG > 150, false)")
OTHER = "coalesce(SMQ020 = 1 OR ALQ130 = 1, false)"
STRUCTURAL = "coalesce(LBXPLTSI < 150, false)"
ALL_NINE = ("(BMXBMI IS NOT NULL AND LBXGLU IS NOT NULL AND LBXGH IS NOT NULL AND DIQ010 IS NOT NULL "
            "AND LBDHDD IS NOT NULL AND LBXTLG IS NOT NULL AND SMQ020 IS NOT NULL "
            "AND ALQ130 IS NOT NULL AND LBXPLTSI IS NOT NULL)")
LABEL = (f"CASE WHEN (({METABOLIC} AND ({LIPID} OR {OTHER})) OR {STRUCTURAL}) AND {ALL_NINE} "
         "THEN 1 ELSE 0 END")

COHORT_CTES = MODULE_CTES + f""",
cohort AS ({COHORT_SELECT}),
labelled AS (SELECT *, {LABEL} AS LIVER_HIGH_RISK_PROFILE FROM cohort)
"""


def with_cohort(body: str) -> str:
    return "WITH " + COHORT_CTES + body


# Operational stand-ins.
OPS_CTES = """
users AS (SELECT c_custkey AS id, lower(c_name) || '@example.com' AS email, c_name AS name,
                 CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'doctor' ELSE 'user' END AS role,
                 o.d AS created_at
          FROM customer LEFT JOIN (SELECT o_custkey AS k, min(o_orderdate) AS d FROM orders GROUP BY 1) o ON c_custkey = o.k),
doctors AS (SELECT s_suppkey AS id, s_suppkey * 3 AS user_id, 'SPEC_' || CAST(s_nationkey AS VARCHAR) AS specialization,
                   'Profile of ' || s_name AS bio, s_acctbal AS consultation_fee
            FROM supplier WHERE s_suppkey % 4 <> 0),
admins AS (SELECT unnest([c_custkey, c_custkey + 10000000]) AS id, lower(c_name) AS name, lower(c_name) || '@example.com' AS email
           FROM customer WHERE c_custkey % 97 = 0),
appointments AS (SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey % (SELECT count(*) FROM supplier) AS doctor_id,
                        o_orderdate AS appointment_time,
                        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
                        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'https://meet.example.com/' || CAST(o_orderkey AS VARCHAR) END AS meeting_url
                 FROM orders),
doctor_availability AS (SELECT o_orderkey AS id, o_orderkey % (SELECT count(*) FROM supplier) AS doctor_id,
                               CAST(o_orderdate AS DATE) AS available_date,
                               lpad(CAST(8 + o_orderkey % 10 AS VARCHAR), 2, '0') || ':00:00' AS start_time,
                               lpad(CAST(9 + o_orderkey % 10 AS VARCHAR), 2, '0') || ':00:00' AS end_time,
                               o_orderstatus = 'F' AS is_booked
                        FROM orders),
records AS (SELECT event_id AS id, user_id,
                   CASE event_type WHEN 'view' THEN 'liver_clinical' WHEN 'click' THEN 'Liver_Lifestyle'
                                   WHEN 'purchase' THEN 'liver' ELSE event_type END AS consultation_type,
                   value / 500 AS health_score, ts AS created_at
            FROM events),
user_subscriptions AS (SELECT o_orderkey AS id, o_custkey AS user_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS plan_id,
                              CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'O' THEN 'active' ELSE 'pending' END AS status,
                              o_orderdate AS start_date
                       FROM orders),
plan_src AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id, min(o_orderpriority) AS prio,
                    min(o_totalprice) AS minp FROM orders GROUP BY 1),
subscription_plans AS (SELECT id,
                              upper(substr(substr(prio, 3), 1, 1)) || lower(substr(substr(prio, 3), 2)) AS name,
                              CASE WHEN id = 1 THEN '0.00'
                                   ELSE CAST(CAST(floor(minp) % 100 + id * 10 AS BIGINT) AS VARCHAR) || '.99' END AS price,
                              id * 30 AS duration_days, id = 1 AS is_free, id <> 5 AS is_active
                       FROM plan_src),
requests AS (SELECT event_id AS id, user_id,
                    CASE event_type WHEN 'view' THEN 'predict' WHEN 'click' THEN 'chat'
                                    WHEN 'purchase' THEN 'book_appointment' ELSE event_type END AS endpoint, ts
             FROM events),
visits AS (SELECT id, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 AND user_id % 97 = 0 THEN user_id + 10000000 ELSE user_id END AS user_id,
                  CASE WHEN id % 100 <> 0 THEN 's' || user_id END AS session_id, endpoint, ts
           FROM requests),
booking_requests AS (SELECT id * 4 + k AS id, doctor_id + k AS user_id, CASE WHEN k = 3 AND id % 8 = 3 THEN -id ELSE id END AS slot_id,
                            CAST(available_date AS TIMESTAMP) + to_hours(CAST(k * 5 % 3 AS INTEGER)) AS ts
                     FROM (SELECT *, unnest(range(1, id % 4 + 1)) AS k FROM doctor_availability)),
cancel_requests AS (SELECT id, user_id + id % 5 AS user_id FROM user_subscriptions WHERE id % 5 < 2),
chat_history AS (SELECT conv_id, turn, role, text AS message FROM conversations WHERE role <> 'system')
"""


def with_ops(body: str, cohort: bool = False) -> str:
    if cohort:
        return "WITH " + COHORT_CTES + "," + OPS_CTES + body
    return "WITH " + OPS_CTES + body
