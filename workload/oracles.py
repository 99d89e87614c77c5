"""The same results in plain SQL, written independently of the DataFrame code."""

from __future__ import annotations

from .views import WIDENED

TS = "'%Y-%m-%d %H:%M:%S.%f'"
LOAN_BAD = "(TARGET IS NULL OR TARGET NOT IN (0, 1) OR AMT_CREDIT IS NULL OR AMT_CREDIT <= 0)"

VIEWS = {
    "v_application": """
        SELECT o_orderkey AS SK_ID_CURR, o_custkey AS applicant_id, o_orderpriority AS NAME_CONTRACT_TYPE,
               o_totalprice AS AMT_CREDIT, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS TARGET,
               o_orderdate AS ingestion_ts
        FROM orders""",
    "v_applicant": """
        SELECT c_custkey AS applicant_id, CAST(-7000 - c_custkey % 18000 AS INT) AS DAYS_BIRTH,
               CASE WHEN c_custkey % 11 = 0 THEN 365243 ELSE CAST(-(c_custkey % 9000) AS INT) END AS DAYS_EMPLOYED,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'XNA' ELSE c_mktsegment END AS ORGANIZATION_TYPE,
               c_acctbal AS AMT_INCOME_TOTAL, c_mktsegment AS segment
        FROM customer""",
    "v_masked": """
        SELECT applicant_id, NULLIF(ORGANIZATION_TYPE, 'XNA') AS ORGANIZATION_TYPE, AMT_INCOME_TOTAL, segment,
               sha256(CAST(DAYS_BIRTH AS VARCHAR)) AS DAYS_BIRTH_MASKED,
               sha256(CAST(NULLIF(DAYS_EMPLOYED, 365243) AS VARCHAR)) AS DAYS_EMPLOYED_MASKED
        FROM v_applicant""",
    "v_instalment": """
        SELECT l_orderkey AS SK_ID_PREV, l_linenumber AS NUM_INSTALMENT_NUMBER, l_partkey AS SK_ID_CURR,
               l_extendedprice AS AMT_INSTALMENT, l_extendedprice * (1 - l_discount) AS AMT_PAYMENT,
               l_shipdate AS ingestion_ts, l_partkey AS tie_1, l_suppkey AS tie_2
        FROM lineitem""",
    "v_instalment_latest": """
        SELECT * EXCLUDE rn FROM (
            SELECT *, row_number() OVER (PARTITION BY SK_ID_PREV, NUM_INSTALMENT_NUMBER
                ORDER BY ingestion_ts DESC NULLS LAST, tie_1 DESC NULLS LAST, tie_2 DESC NULLS LAST) AS rn
            FROM v_instalment) WHERE rn = 1""",
    "v_bureau": """
        SELECT event_id AS SK_ID_BUREAU, user_id AS SK_ID_CURR,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS CREDIT_DAY_OVERDUE, value AS AMT_CREDIT_SUM
        FROM events""",
    "v_balance": """
        SELECT user_id AS SK_ID_BUREAU,
               CAST(date_diff('day', DATE '2024-01-30', CAST(ts AS DATE)) AS INT) AS MONTHS_BALANCE,
               event_type AS STATUS, value AS AMT_BALANCE, ts AS ingestion_ts, event_id AS tie_1
        FROM events""",
    "v_balance_latest": """
        SELECT * EXCLUDE rn FROM (
            SELECT *, row_number() OVER (PARTITION BY SK_ID_BUREAU, MONTHS_BALANCE
                ORDER BY ingestion_ts DESC NULLS LAST, tie_1 DESC NULLS LAST) AS rn
            FROM v_balance) WHERE rn = 1""",
    "v_records": """
        SELECT b.*, COALESCE(f.months_observed, 0) AS months_observed, f.latest_month, f.earliest_month,
               COALESCE(f.overdue_months, 0) AS overdue_months
        FROM v_bureau b LEFT JOIN (
            SELECT SK_ID_BUREAU, COUNT(*) AS months_observed, MAX(MONTHS_BALANCE) AS latest_month,
                   MIN(MONTHS_BALANCE) AS earliest_month, COUNT(*) FILTER (WHERE STATUS = 'error') AS overdue_months
            FROM v_balance_latest GROUP BY 1) f USING (SK_ID_BUREAU)""",
    "v_batch": """
        SELECT CASE o_orderstatus WHEN 'O' THEN 'O' ELSE 'F' END AS batch, c_custkey AS applicant_id, c_custkey AS SK_ID_CURR,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Working' WHEN '2-HIGH' THEN 'Working'
                    WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Pensioner' END AS name_income_type,
               n_name AS name_education_type,
               CASE WHEN o_totalprice < 250000 THEN 'Single' ELSE 'Married' END AS name_family_status,
               CASE WHEN o_totalprice < 50000 THEN NULL WHEN o_totalprice < 250000 THEN 0 ELSE 1 END AS cnt_children
        FROM (SELECT * FROM orders QUALIFY row_number() OVER (
                  PARTITION BY CASE o_orderstatus WHEN 'O' THEN 'O' ELSE 'F' END, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_told": """
        SELECT o_custkey AS applicant_id, o_orderkey AS SK_ID_CURR,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Working' WHEN '2-HIGH' THEN 'Working'
                    WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Pensioner' END AS name_income_type,
               'Higher' AS name_education_type,
               CASE WHEN o_totalprice < 250000 THEN 'Single' ELSE 'Married' END AS name_family_status,
               CASE WHEN o_totalprice >= 50000 THEN CAST(floor(o_totalprice / 250000) AS INT) END AS cnt_children, o_orderdate AS told_at
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1""",
    "v_chain": """
        SELECT sha256(CAST(applicant_id AS VARCHAR) || '|' || strftime(told_at, '%Y-%m-%dT%H:%M:%S.%f')) AS applicant_sk,
               * EXCLUDE (told_at, k, differs), told_at AS start_date, lead(told_at) OVER w AS end_date, lead(told_at) OVER w IS NULL AS is_current
        FROM (SELECT *, row_number() OVER w AS k,
                     (lag(name_income_type) OVER w) IS DISTINCT FROM name_income_type
                     OR (lag(name_family_status) OVER w) IS DISTINCT FROM name_family_status
                     OR (lag(cnt_children) OVER w) IS DISTINCT FROM cnt_children AS differs
              FROM v_told WINDOW w AS (PARTITION BY applicant_id ORDER BY told_at))
        WHERE k = 1 OR differs WINDOW w AS (PARTITION BY applicant_id ORDER BY told_at)""",
    "v_dim_v1": """
        SELECT sha256(CAST(applicant_id AS VARCHAR) || '|2024-01-01T00:00:00.000000') AS applicant_sk,
               * EXCLUDE batch, TIMESTAMP '2024-01-01 00:00:00' AS start_date,
               CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current
        FROM v_batch WHERE batch = 'F'""",
    "v_dim_src": "SELECT * EXCLUDE batch FROM v_batch WHERE batch = 'O'",
    "v_changed": """
        SELECT d.applicant_id,
               d.name_income_type IS DISTINCT FROM s.name_income_type
               OR d.name_education_type IS DISTINCT FROM s.name_education_type
               OR d.name_family_status IS DISTINCT FROM s.name_family_status
               OR d.cnt_children IS DISTINCT FROM s.cnt_children AS changed
        FROM v_dim_v1 d JOIN v_dim_src s USING (applicant_id) WHERE d.is_current""",
    "v_dim_v2": """
        SELECT applicant_sk, applicant_id, SK_ID_CURR, name_income_type, name_education_type, name_family_status,
               cnt_children, start_date,
               CASE WHEN applicant_id IN (SELECT applicant_id FROM v_changed WHERE changed)
                    THEN TIMESTAMP '2024-02-01 00:00:00' ELSE end_date END AS end_date,
               applicant_id NOT IN (SELECT applicant_id FROM v_changed WHERE changed) AS is_current
        FROM v_dim_v1
        UNION ALL
        SELECT sha256(CAST(applicant_id AS VARCHAR) || '|2024-02-01T00:00:00.000000'), applicant_id, SK_ID_CURR,
               name_income_type, name_education_type, name_family_status, cnt_children,
               TIMESTAMP '2024-02-01 00:00:00', NULL, TRUE
        FROM v_dim_src
        WHERE applicant_id NOT IN (SELECT applicant_id FROM v_changed WHERE NOT changed)""",
    "v_silver_source": """
        SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS SK_ID_CURR, c_mktsegment, n_name,
               CASE WHEN c_acctbal < 5000 THEN 'A' ELSE 'B' END AS status, c_nationkey AS children,
               TIMESTAMP '2024-01-01 00:00:00' AS ingestion_ts
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_latest_loan": """
        SELECT CASE o_orderstatus WHEN 'O' THEN 'O' ELSE 'F' END AS batch, o_custkey AS applicant_id, o_orderkey AS SK_ID_CURR, o_orderpriority AS NAME_CONTRACT_TYPE,
               CAST(o_totalprice AS DECIMAL(18,2)) AS AMT_CREDIT, o_orderdate AS ingestion_ts
        FROM orders QUALIFY row_number() OVER (
            PARTITION BY CASE o_orderstatus WHEN 'O' THEN 'O' ELSE 'F' END, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "v_target": "SELECT * EXCLUDE batch FROM v_latest_loan WHERE batch = 'F'",
    "v_updates": "SELECT * EXCLUDE batch FROM v_latest_loan WHERE batch = 'O'",
    "v_upserted": """
        SELECT * FROM v_target WHERE applicant_id NOT IN (SELECT applicant_id FROM v_updates)
        UNION ALL SELECT * FROM v_updates""",
    "v_loans": f"""
        SELECT sha256(CAST(SK_ID_CURR AS VARCHAR)) AS fact_loan_application_sk, SK_ID_CURR, applicant_id,
               NAME_CONTRACT_TYPE, TARGET, AMT_CREDIT
        FROM v_application WHERE NOT {LOAN_BAD}""",
}

# Views each view is built on, in the order they must be declared.
NEEDS = {
    "v_masked": ["v_applicant"],
    "v_instalment_latest": ["v_instalment"],
    "v_balance_latest": ["v_balance"],
    "v_records": ["v_bureau", "v_balance", "v_balance_latest"],
    "v_chain": ["v_told"],
    "v_dim_v1": ["v_batch"],
    "v_dim_src": ["v_batch"],
    "v_changed": ["v_batch", "v_dim_v1", "v_dim_src"],
    "v_dim_v2": ["v_batch", "v_dim_v1", "v_dim_src", "v_changed"],
    "v_target": ["v_latest_loan"],
    "v_updates": ["v_latest_loan"],
    "v_upserted": ["v_latest_loan", "v_target", "v_updates"],
    "v_loans": ["v_application"],
}

ORACLES: dict[str, str] = {}


def oracle(name: str, views: str, body: str) -> None:
    ordered: list[str] = []
    for view in views.split():
        ordered += [n for n in [*NEEDS.get(view, []), view] if n not in ordered]
    ctes = ", ".join(f"{view} AS ({VIEWS[view]})" for view in ordered)
    sql = f"WITH {ctes} {body}" if ctes else body
    widened = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in WIDENED.get(name, []))
    ORACLES[name] = f"SELECT * REPLACE ({widened}) FROM ({sql})" if widened else sql


def text(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, {TS}) AS {alias or column.split('.')[-1]}"


def pct(part: str, whole: str) -> str:
    return f"ROUND(100.0::DOUBLE * CAST({part} AS DOUBLE) / CAST(NULLIF({whole}, 0) AS DOUBLE), 6)"


def exact_avg(column: str, as_type: str = "DECIMAL(18,2)") -> str:
    return f"ROUND(CAST(SUM(CAST({column} AS {as_type})) AS DOUBLE) / CAST(NULLIF(COUNT({column}), 0) AS DOUBLE), 6)"


DIM = ("applicant_sk, applicant_id, SK_ID_CURR, name_income_type, name_education_type, name_family_status, "
       f"cnt_children, {text('start_date')}, {text('end_date')}, is_current")

# --- sources --------------------------------------------------------------------------------------

oracle("audit_tag", "", f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {text('o_orderdate')}, o_orderpriority,
           '2024-01-30 06:00:00.000000' AS ingestion_ts, '2024-01-30' AS ingestion_date,
           'orders.parquet' AS source_file, 'batch_001' AS batch_id, 'dev' AS env
    FROM orders""")
oracle("sample_limit", "v_application", f"""
    SELECT * EXCLUDE ingestion_ts, {text('ingestion_ts')} FROM v_application ORDER BY SK_ID_CURR LIMIT 5000""")
oracle("stratified_sample", "v_application", f"""
    SELECT * EXCLUDE ingestion_ts, {text('ingestion_ts')} FROM v_application
    WHERE substr(md5('42|' || CAST(SK_ID_CURR AS VARCHAR)), 1, 8) < '03d70a3d'""")
oracle("stratified_sample_exact", "v_application", f"""
    SELECT * EXCLUDE ingestion_ts, {text('ingestion_ts')} FROM v_application
    QUALIFY row_number() OVER (PARTITION BY TARGET ORDER BY md5('42|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR)
            <= floor(count(*) OVER (PARTITION BY TARGET) * 0.015::DOUBLE + 0.5)""")
oracle("schema_drift", "", """
    WITH t AS (SELECT COUNT(*) AS n,
                      COUNT(*) FILTER (WHERE o_orderstatus IS NOT NULL AND TRY_CAST(o_orderstatus AS INT) IS NULL) AS bad,
                      COUNT(*) FILTER (WHERE TRY_CAST(o_custkey AS INT) IS NULL) AS bad_key
               FROM orders)
    SELECT c.column_name, c.expected_type, c.arriving_type, c.status,
           CASE WHEN c.arriving_type IS NULL THEN 0 ELSE n END AS present_values,
           CASE c.column_name WHEN 'o_orderstatus' THEN bad WHEN 'o_custkey' THEN bad_key ELSE 0 END
               AS unconvertible_values
    FROM t, (VALUES ('o_orderkey', 'bigint', 'bigint', 'same'), ('o_custkey', 'int', 'bigint', 'retyped'),
                    ('o_orderstatus', 'int', 'string', 'retyped'), ('o_totalprice', 'double', 'double', 'same'),
                    ('o_orderpriority', 'string', 'string', 'same'), ('o_clerk', 'string', NULL, 'missing'),
                    ('o_orderdate', NULL, 'timestamp_ntz', 'unexpected'))
         AS c(column_name, expected_type, arriving_type, status)""")

# --- projection, casts, masking -------------------------------------------------------------------

STAGED = f"""
    SELECT SK_ID_CURR AS applicant_id, SK_ID_CURR, c_mktsegment AS name_income_type, n_name AS name_education_type,
           status AS name_family_status, children AS cnt_children, {text('ingestion_ts')}
    FROM v_silver_source WHERE SK_ID_CURR IS NOT NULL"""
oracle("stg_application", "v_silver_source", STAGED)
oracle("int_applicant_attributes", "v_silver_source", STAGED)
oracle("int_bureau_with_balance", "v_bureau", "SELECT SK_ID_BUREAU, SK_ID_CURR FROM v_bureau")
oracle("typed_cast", "", """
    SELECT o_orderkey AS SK_ID_CURR, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice END AS AMT_CREDIT,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(-(o_orderkey % 700) AS INT) END AS DAYS_DECISION,
           concat_ws(',', CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'bad_AMT_CREDIT' END,
                     CASE WHEN o_orderstatus = 'P' THEN 'bad_DAYS_DECISION' END) AS failed_rules
    FROM orders""")
oracle("null_sentinel", "v_applicant", """
    SELECT applicant_id, DAYS_BIRTH, NULLIF(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED,
           NULLIF(ORGANIZATION_TYPE, 'XNA') AS ORGANIZATION_TYPE, AMT_INCOME_TOTAL, segment,
           DAYS_EMPLOYED = 365243 AS DAYS_EMPLOYED_IS_SENTINEL, ORGANIZATION_TYPE = 'XNA' AS ORGANIZATION_TYPE_IS_SENTINEL
    FROM v_applicant""")
oracle("pii_mask", "v_masked", "SELECT * FROM v_masked")
oracle("scd_prep", "v_application", f"""
    SELECT * EXCLUDE ingestion_ts, {text('ingestion_ts')}, TRUE AS is_current,
           CAST(CAST(ingestion_ts AS DATE) AS VARCHAR) AS start_date, CAST(NULL AS VARCHAR) AS end_date
    FROM v_application""")
oracle("balance_snapshot", "v_balance_latest", f"""
    SELECT * EXCLUDE ingestion_ts, {text('ingestion_ts')} FROM v_balance_latest WHERE MONTHS_BALANCE = 0""")

# --- latest per key, per table --------------------------------------------------------------------

oracle("latest_instalment", "v_instalment_latest", f"""
    SELECT * EXCLUDE ingestion_ts, {text('ingestion_ts')} FROM v_instalment_latest""")
oracle("latest_by_arrival", "", """
    SELECT user_id AS SK_ID_PREV, event_type AS STATUS, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS AMT_BALANCE,
           '2024-01-01 00:00:00.000000' AS ingestion_ts, 'batch_001' AS batch_id
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1""")
oracle("latest_balance", "v_balance_latest", f"""
    SELECT * EXCLUDE ingestion_ts, {text('ingestion_ts')} FROM v_balance_latest""")


def latest(source: str, keys: str, ties: str = "arrival") -> str:
    return f"""SELECT * FROM ({source}) QUALIFY row_number() OVER (
        PARTITION BY {keys} ORDER BY ingestion_ts DESC, {', '.join(f"{t} DESC" for t in ties.split(', '))}) = 1"""


def good_latest_or_bad(source: str, keys: str, ties: str = "arrival") -> str:
    """The latest good row per key, and every bad one; ``source`` has ``failed_rules``."""
    good = latest(f"SELECT * FROM ({source}) WHERE failed_rules = ''", keys, ties)
    return f"({good}) UNION ALL SELECT * FROM ({source}) WHERE failed_rules <> ''"


oracle("silver_application", "", f"""
    WITH b AS ({good_latest_or_bad('''
        SELECT o_custkey AS SK_ID_CURR, o_orderdate AS ingestion_ts, o_orderkey AS arrival, o_orderstatus,
               o_orderpriority, o_totalprice,
               concat_ws(',', CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'bad_CNT_CHILDREN' END,
                         CASE WHEN o_orderstatus = 'P' THEN 'target_missing' END,
                         CASE WHEN o_totalprice < 50000 THEN 'credit_not_positive' END) AS failed_rules
        FROM orders''', 'SK_ID_CURR')})
    SELECT SK_ID_CURR, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS TARGET,
           o_orderpriority AS NAME_CONTRACT_TYPE,
           CASE WHEN o_totalprice < 50000 THEN 0.0::DOUBLE ELSE o_totalprice END AS AMT_CREDIT,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS ORGANIZATION_TYPE,
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(substr(o_orderpriority, 1, 1) AS INT) END AS CNT_CHILDREN,
           {text('ingestion_ts')}, arrival,
           sha256(CAST(-7000 - SK_ID_CURR % 18000 AS VARCHAR)) AS DAYS_BIRTH_MASKED,
           CASE WHEN o_orderpriority <> '2-HIGH' THEN sha256(CAST(-(arrival % 9000) AS VARCHAR)) END AS DAYS_EMPLOYED_MASKED,
           o_orderpriority = '2-HIGH' AS DAYS_EMPLOYED_IS_SENTINEL,
           o_orderpriority = '5-LOW' AS ORGANIZATION_TYPE_IS_SENTINEL,
           TRUE AS is_current, CAST(CAST(ingestion_ts AS DATE) AS VARCHAR) AS start_date,
           CAST(NULL AS VARCHAR) AS end_date, failed_rules
    FROM b""")
oracle("silver_bureau", "", f"""
    WITH b AS ({good_latest_or_bad('''
        SELECT *, ts AS ingestion_ts, event_id AS arrival, CASE WHEN event_type = 'error' THEN 'bad_DAYS_CREDIT' ELSE '' END AS failed_rules
        FROM events''', 'user_id')})
    SELECT user_id AS SK_ID_BUREAU, event_id AS SK_ID_CURR,
           CASE WHEN event_type <> 'error' THEN CAST(-(arrival % 900) AS INT) END AS DAYS_CREDIT,
           CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS AMT_CREDIT_SUM, value AS AMT_CREDIT_SUM_DEBT,
           {text('ingestion_ts')}, arrival, failed_rules
    FROM b""")
oracle("silver_previous_application", "", f"""
    WITH b AS ({good_latest_or_bad('''
        SELECT *, l_shipdate AS ingestion_ts, CASE WHEN l_returnflag = 'N' THEN 'bad_DAYS_DECISION' ELSE '' END AS failed_rules
        FROM lineitem''', 'l_partkey', 'l_orderkey, l_linenumber, l_suppkey')})
    SELECT l_partkey AS SK_ID_PREV, l_suppkey AS SK_ID_CURR,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS AMT_CREDIT,
           CASE WHEN l_returnflag <> 'N' THEN -CAST(l_quantity AS INT) END AS DAYS_DECISION,
           {text('ingestion_ts')}, l_orderkey AS arrival, l_linenumber AS arrival_line, l_suppkey AS arrival_supplier,
           failed_rules
    FROM b""")
oracle("silver_installments_payments", "", f"""
    WITH b AS ({good_latest_or_bad('''
        SELECT *, l_shipdate AS ingestion_ts, CASE WHEN l_returnflag = 'R' THEN 'bad_AMT_INSTALMENT' ELSE '' END AS failed_rules
        FROM lineitem''', 'l_orderkey, l_linenumber', 'l_partkey, l_suppkey')})
    SELECT l_orderkey AS SK_ID_PREV, l_linenumber AS NUM_INSTALMENT_NUMBER, l_partkey AS SK_ID_CURR,
           CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS AMT_INSTALMENT,
           l_extendedprice AS AMT_PAYMENT, {text('ingestion_ts')}, l_partkey AS arrival, l_suppkey AS arrival_supplier,
           failed_rules
    FROM b""")
for _table, _key in (("bureau_balance", "SK_ID_BUREAU"), ("pos_cash_balance", "SK_ID_PREV"),
                     ("credit_card_balance", "SK_ID_PREV")):
    oracle(f"silver_{_table}", "v_balance_latest", f"""
        SELECT SK_ID_BUREAU AS {_key}, MONTHS_BALANCE, STATUS, AMT_BALANCE, {text('ingestion_ts')}, tie_1 AS arrival,
               '' AS failed_rules
        FROM v_balance_latest""")

# --- versioned dimension --------------------------------------------------------------------------

oracle("tracked_change", "v_changed", "SELECT * FROM v_changed")
oracle("scd2_expire", "v_dim_v2", f"SELECT {DIM} FROM v_dim_v2 WHERE NOT is_current")
oracle("scd2_insert", "v_dim_v2", f"""
    SELECT {DIM} FROM v_dim_v2
    WHERE start_date = TIMESTAMP '2024-02-01 00:00:00' AND applicant_id NOT IN (SELECT applicant_id FROM v_dim_v1)""")
oracle("scd2_apply", "v_dim_v2", f"SELECT {DIM} FROM v_dim_v2")
oracle("scd2_idempotent", "v_dim_v2", f"SELECT {DIM} FROM v_dim_v2")
oracle("scd2_chain", "v_chain", f"SELECT {DIM} FROM v_chain")
oracle("scd2_late", "v_chain", f"SELECT {DIM} FROM v_chain")
oracle("scd2_close_missing", "v_dim_v2", f"""
    SELECT {DIM} FROM (
        SELECT * REPLACE (
            CASE WHEN is_current AND applicant_id NOT IN (SELECT applicant_id FROM v_dim_src)
                 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE end_date END AS end_date,
            is_current AND applicant_id IN (SELECT applicant_id FROM v_dim_src) AS is_current)
        FROM v_dim_v2)""")
oracle("scd2_return", "v_dim_v2", f"""
    -- After the second batch and a closure of the missing, the first batch is offered again with closures.
    , closed AS (
        SELECT * REPLACE (
            CASE WHEN is_current AND applicant_id NOT IN (SELECT applicant_id FROM v_dim_src)
                 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE end_date END AS end_date,
            is_current AND applicant_id IN (SELECT applicant_id FROM v_dim_src) AS is_current)
        FROM v_dim_v2),
    again AS (SELECT * EXCLUDE batch FROM v_batch WHERE batch = 'F'),
    same AS (SELECT c.applicant_id FROM closed c JOIN again a USING (applicant_id) WHERE c.is_current
             AND c.name_income_type IS NOT DISTINCT FROM a.name_income_type AND c.name_education_type IS NOT DISTINCT FROM a.name_education_type
             AND c.name_family_status IS NOT DISTINCT FROM a.name_family_status AND c.cnt_children IS NOT DISTINCT FROM a.cnt_children)
    SELECT {DIM} FROM (
        SELECT * REPLACE (
            CASE WHEN is_current AND applicant_id NOT IN (SELECT applicant_id FROM same) THEN TIMESTAMP '2024-03-01 00:00:00' ELSE end_date END AS end_date,
            is_current AND applicant_id IN (SELECT applicant_id FROM same) AS is_current)
        FROM closed
        UNION ALL
        SELECT sha256(CAST(applicant_id AS VARCHAR) || '|2024-03-01T00:00:00.000000'), applicant_id, SK_ID_CURR, name_income_type, name_education_type,
               name_family_status, cnt_children, TIMESTAMP '2024-03-01 00:00:00', NULL, TRUE
        FROM again WHERE applicant_id NOT IN (SELECT applicant_id FROM same))""")
oracle("fact_join_current", "v_application v_dim_v2", f"""
    SELECT a.applicant_id, a.SK_ID_CURR, a.AMT_CREDIT, d.applicant_sk, d.name_income_type, d.cnt_children,
           {text('d.start_date')}
    FROM v_application a LEFT JOIN v_dim_v2 d ON a.applicant_id = d.applicant_id AND d.is_current""")
for _name in ("fact_join_asof", "fact_join_asof_sorted"):
    oracle(_name, "v_dim_v2", f"""
    SELECT f.SK_ID_CURR, f.applicant_id, {text('f.applied_at')}, d.applicant_sk, d.name_income_type, d.cnt_children,
           {text('d.start_date')}
    FROM (SELECT o_orderkey AS SK_ID_CURR, o_custkey AS applicant_id,
                 TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY * CAST(o_orderkey % 60 AS INT) AS applied_at
          FROM orders) f
    LEFT JOIN v_dim_v2 d ON f.applicant_id = d.applicant_id AND d.start_date <= f.applied_at
         AND (d.end_date IS NULL OR f.applied_at < d.end_date)""")

# --- upserts --------------------------------------------------------------------------------------

UPSERTED = f"""
    SELECT applicant_id, SK_ID_CURR, NAME_CONTRACT_TYPE, CAST(AMT_CREDIT AS DOUBLE) AS AMT_CREDIT, {text('ingestion_ts')}
    FROM v_upserted"""
oracle("upsert", "v_upserted", UPSERTED)
oracle("upsert_idempotent", "v_upserted", UPSERTED)
oracle("upsert_latest", "v_target v_updates", f"""
    SELECT applicant_id, SK_ID_CURR, NAME_CONTRACT_TYPE, CAST(AMT_CREDIT AS DOUBLE) AS AMT_CREDIT, {text('ingestion_ts')}
    FROM (SELECT *, 0 AS side FROM v_target UNION ALL SELECT *, 1 FROM v_updates)
    QUALIFY row_number() OVER (PARTITION BY applicant_id ORDER BY ingestion_ts DESC, side DESC) = 1""")
oracle("dim_loan_type", "v_application", """
    SELECT DISTINCT sha256(NAME_CONTRACT_TYPE) AS loan_type_id, NAME_CONTRACT_TYPE AS loan_type_name FROM v_application""")
oracle("dim_credit_status", "v_balance", """
    SELECT DISTINCT sha256(STATUS) AS status_id, STATUS AS status_code,
           CASE STATUS WHEN 'error' THEN 'failed attempt' WHEN 'purchase' THEN 'completed purchase' ELSE STATUS END
               AS status_description
    FROM v_balance""")

# --- facts and marts ------------------------------------------------------------------------------

oracle("fact_loan_application", "v_loans", "SELECT * FROM v_loans")
oracle("fact_bureau_credit", "v_bureau", """
    SELECT sha256(CAST(SK_ID_BUREAU AS VARCHAR)) AS fact_bureau_credit_sk, * FROM v_bureau""")
oracle("fact_installment_payment", "v_instalment_latest", """
    SELECT sha256(CAST(SK_ID_PREV AS VARCHAR) || '|' || CAST(NUM_INSTALMENT_NUMBER AS VARCHAR))
               AS fact_installment_payment_sk,
           SK_ID_PREV, NUM_INSTALMENT_NUMBER, SK_ID_CURR, AMT_INSTALMENT, AMT_PAYMENT
    FROM v_instalment_latest""")
oracle("bureau_with_balance", "v_records", "SELECT * FROM v_records")
oracle("prev_app_count", "v_applicant v_application", """
    SELECT a.applicant_id, COUNT(p.SK_ID_CURR) AS prev_app_count
    FROM v_applicant a LEFT JOIN v_application p USING (applicant_id) GROUP BY 1""")
oracle("credit_risk_features", "v_applicant v_loans v_records", """
    , loans AS (SELECT applicant_id, COUNT(*) AS n, CAST(SUM(CAST(AMT_CREDIT AS DECIMAL(18,2))) AS DOUBLE) AS credit
                FROM v_loans GROUP BY 1),
    records AS (SELECT SK_ID_CURR AS applicant_id, COUNT(*) AS n, SUM(CREDIT_DAY_OVERDUE) AS late,
                       SUM(months_observed) AS months, MAX(months_observed) AS deepest
                FROM v_records GROUP BY 1)
    SELECT a.applicant_id, COALESCE(l.n, 0) AS application_count, COALESCE(r.n, 0) AS bureau_records,
           CAST(COALESCE(r.late, 0) AS BIGINT) AS overdue_records, CAST(COALESCE(r.months, 0) AS BIGINT) AS balance_months,
           COALESCE(r.deepest, 0) AS deepest_history, ROUND(COALESCE(l.credit, 0.0), 2) AS total_credit,
           ROUND(a.AMT_INCOME_TOTAL / NULLIF(l.credit, 0.0), 6) + 0.0::DOUBLE AS income_to_credit,
           ROUND(100.0::DOUBLE * CAST(r.late AS DOUBLE) / CAST(NULLIF(r.n, 0) AS DOUBLE), 6) AS delinquency_rate
    FROM v_applicant a LEFT JOIN loans l USING (applicant_id) LEFT JOIN records r USING (applicant_id)""")
oracle("credit_risk_summary", "v_loans v_applicant v_dim_v2", f"""
    SELECT l.NAME_CONTRACT_TYPE, COUNT(*) AS applications, COUNT(*) FILTER (WHERE TARGET = 1) AS defaults,
           {pct('COUNT(*) FILTER (WHERE TARGET = 1)', 'COUNT(*)')} AS default_rate,
           {exact_avg('AMT_CREDIT')} AS avg_credit,
           {exact_avg('d.AMT_INCOME_TOTAL / NULLIF(l.AMT_CREDIT, 0.0)', 'DECIMAL(18,6)')} AS income_to_credit,
           COUNT(d.applicant_id) AS with_applicant
    FROM v_loans l LEFT JOIN (SELECT applicant_id, AMT_INCOME_TOTAL FROM v_dim_v2 JOIN v_applicant USING (applicant_id)
                              WHERE is_current) d ON l.applicant_id = d.applicant_id
    GROUP BY 1""")

# --- indicators -----------------------------------------------------------------------------------

oracle("kpi_default_rate", "v_loans", f"""
    SELECT CASE WHEN GROUPING(NAME_CONTRACT_TYPE) = 1 THEN 'ALL' ELSE NAME_CONTRACT_TYPE END AS loan_type,
           COUNT(SK_ID_CURR) AS applications, COUNT(SK_ID_CURR) FILTER (WHERE TARGET = 1) AS defaults,
           {pct('COUNT(SK_ID_CURR) FILTER (WHERE TARGET = 1)', 'COUNT(SK_ID_CURR)')} AS default_rate
    FROM v_loans GROUP BY GROUPING SETS ((), (NAME_CONTRACT_TYPE))""")
oracle("kpi_avg_credit", "v_loans", f"""
    SELECT NAME_CONTRACT_TYPE AS loan_type, COUNT(*) AS applications, {exact_avg('AMT_CREDIT')} AS avg_credit
    FROM v_loans GROUP BY 1""")
oracle("kpi_delinquency", "v_bureau", f"""
    SELECT COUNT(SK_ID_BUREAU) AS bureau_records, COUNT(*) FILTER (WHERE CREDIT_DAY_OVERDUE > 0) AS overdue_records,
           {pct('COUNT(*) FILTER (WHERE CREDIT_DAY_OVERDUE > 0)', 'COUNT(SK_ID_BUREAU)')} AS delinquency_rate
    FROM v_bureau""")
oracle("kpi_income_credit", "v_loans v_applicant", f"""
    SELECT a.segment, COUNT(*) AS applications,
           {exact_avg('a.AMT_INCOME_TOTAL / NULLIF(l.AMT_CREDIT, 0.0)', 'DECIMAL(18,6)')} AS income_to_credit
    FROM v_loans l JOIN v_applicant a USING (applicant_id) GROUP BY 1""")
oracle("kpi_masked_presence", "v_masked", f"""
    SELECT CASE WHEN AMT_INCOME_TOTAL < 0 THEN 0 WHEN AMT_INCOME_TOTAL < 2500 THEN 1 WHEN AMT_INCOME_TOTAL < 5000 THEN 2
                WHEN AMT_INCOME_TOTAL < 7500 THEN 3 ELSE 4 END AS income_bracket,
           COUNT(*) AS applicants, COUNT(DAYS_EMPLOYED_MASKED) AS with_masked_value,
           {pct('COUNT(DAYS_EMPLOYED_MASKED)', 'COUNT(*)')} AS presence_rate
    FROM v_masked GROUP BY 1""")
for _name in ("balance_trend", "balance_trend_incremental"):
    oracle(_name, "v_balance_latest", f"""
    SELECT MONTHS_BALANCE, COUNT(*) AS accounts,
           ROUND(CAST(SUM(CAST(AMT_BALANCE AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_balance,
           {exact_avg('AMT_BALANCE')} AS avg_balance
    FROM v_balance_latest GROUP BY 1""")
oracle("delinquency_trend", "v_balance_latest", f"""
    SELECT MONTHS_BALANCE, COUNT(*) AS accounts, COUNT(*) FILTER (WHERE STATUS = 'error') AS delinquent_accounts,
           {pct("COUNT(*) FILTER (WHERE STATUS = 'error')", 'COUNT(*)')} AS delinquency_rate
    FROM v_balance_latest GROUP BY 1""")

# --- quality --------------------------------------------------------------------------------------

oracle("quarantine_split", "v_application", f"""
    SELECT SK_ID_CURR, {LOAN_BAD} AS quarantined,
           concat_ws(',', CASE WHEN TARGET IS NULL THEN 'target_missing' END,
                     CASE WHEN TARGET NOT IN (0, 1) THEN 'target_domain' END,
                     CASE WHEN AMT_CREDIT IS NULL OR AMT_CREDIT <= 0 THEN 'credit_not_positive' END) AS failed_rules
    FROM v_application""")
oracle("dq_duplicate_keys", "v_instalment", """
    SELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, COUNT(*) AS occurrences FROM v_instalment GROUP BY 1, 2 HAVING COUNT(*) > 1""")
oracle("dq_multi_current", "v_dim_v1", """
    SELECT applicant_id, COUNT(*) AS occurrences
    FROM (SELECT * FROM v_dim_v1 UNION ALL SELECT * FROM v_dim_v1 WHERE cnt_children IS NULL)
    WHERE is_current GROUP BY 1 HAVING COUNT(*) > 1""")
oracle("dq_zero_current", "v_dim_v1 v_dim_src", """
    SELECT s.applicant_id FROM v_dim_src s LEFT JOIN v_dim_v1 d ON d.applicant_id = s.applicant_id AND d.is_current
    WHERE d.applicant_id IS NULL""")
for _name in ("dq_orphans", "dq_orphans_by_blocks"):
    oracle(_name, "v_loans", """
    SELECT 'customer_without_events' AS reference, c_custkey AS key, COUNT(*) AS child_rows FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey) GROUP BY 2
    UNION ALL
    SELECT 'order_without_lines', o_orderkey, COUNT(*) FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY 2
    UNION ALL
    SELECT 'line_of_quarantined_order', l_orderkey, COUNT(*) FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM v_loans WHERE SK_ID_CURR = l_orderkey) GROUP BY 2""")


def bronze_checks(view: str, keys: str, expected: str | None = None) -> str:
    first = f"{keys.split(',')[0]}"
    rows = "" if expected is None else f"""
        UNION ALL SELECT 'row_count', 'CRITICAL', COUNT(*), {expected} FROM {view}"""
    return f"""
        SELECT 'missing_timestamps' AS check_name, 'CRITICAL' AS severity,
               COUNT(*) FILTER (WHERE ingestion_ts IS NULL) AS observed, 0 AS expected FROM {view}
        UNION ALL SELECT 'missing_keys', 'CRITICAL', COUNT(*) FILTER (WHERE {first} IS NULL), 0 FROM {view}
        UNION ALL SELECT 'repeated_keys', 'HIGH', CAST(SUM(n - 1) AS BIGINT), 0
                  FROM (SELECT COUNT(*) AS n FROM {view} GROUP BY {keys}){rows}"""


MASK_CHECKS = """
    SELECT 'sentinels_in_minus_nulled_out' AS check_name, 'CRITICAL' AS severity,
           COUNT(*) FILTER (WHERE DAYS_EMPLOYED = 365243)
           - COUNT(*) FILTER (WHERE DAYS_EMPLOYED = 365243 AND DAYS_EMPLOYED_MASKED IS NULL) AS observed, 0 AS expected
    FROM pairs
    UNION ALL SELECT 'masked_equals_original', 'CRITICAL',
           COUNT(*) FILTER (WHERE DAYS_EMPLOYED_MASKED = CAST(DAYS_EMPLOYED AS VARCHAR)), 0 FROM pairs
    UNION ALL SELECT 'digest_mismatches', 'CRITICAL', COUNT(*) FILTER (WHERE DAYS_EMPLOYED_MASKED IS DISTINCT FROM
           sha256(CAST(NULLIF(DAYS_EMPLOYED, 365243) AS VARCHAR))), 0 FROM pairs
    UNION ALL SELECT 'raw_column_present', 'CRITICAL', 0, 0
    UNION ALL SELECT 'sentinel_digests', 'CRITICAL', COUNT(*) FILTER (WHERE DAYS_EMPLOYED_MASKED = sha256('365243')), 0
    FROM pairs"""
PAIRS = """, pairs AS (SELECT a.DAYS_EMPLOYED, m.DAYS_EMPLOYED_MASKED FROM v_applicant a JOIN v_masked m USING (applicant_id))"""

JUDGED = "* REPLACE (CAST(expected AS BIGINT) AS expected), observed = expected AS passed"
oracle("dq_bronze", "v_instalment", f"SELECT {JUDGED} FROM ({bronze_checks('v_instalment', 'SK_ID_PREV, NUM_INSTALMENT_NUMBER', '(SELECT COUNT(*) FROM lineitem)')})")
oracle("dq_silver", "v_instalment_latest", f"""
    SELECT {JUDGED} FROM ({bronze_checks('v_instalment_latest', 'SK_ID_PREV, NUM_INSTALMENT_NUMBER')}
        UNION ALL SELECT 'payment_negative', 'HIGH', COUNT(*) FILTER (WHERE AMT_PAYMENT < 0), 0 FROM v_instalment_latest
        UNION ALL SELECT 'amount_high', 'HIGH', COUNT(*) FILTER (WHERE AMT_INSTALMENT > 50000), 0 FROM v_instalment_latest)""")
oracle("dq_mask", "v_masked", f"{PAIRS} SELECT {JUDGED} FROM ({MASK_CHECKS})")
oracle("dq_results", "v_application v_instalment v_masked", f"""{PAIRS}
    SELECT 'run_001' AS run_id, {JUDGED} FROM (
        SELECT 'application' AS table_name, * FROM ({bronze_checks('v_application', 'SK_ID_CURR')})
        UNION ALL SELECT 'instalment', * FROM ({bronze_checks('v_instalment', 'SK_ID_PREV, NUM_INSTALMENT_NUMBER')})
        UNION ALL SELECT 'applicant', * FROM ({MASK_CHECKS}))""")
oracle("dq_gate_counts", "v_instalment v_dim_v1 v_dim_src", """
    SELECT 'fact_installment_payment_grain' AS gate, 'CRITICAL' AS severity, COUNT(*) AS violations
    FROM (SELECT 1 FROM v_instalment GROUP BY SK_ID_PREV, NUM_INSTALMENT_NUMBER HAVING COUNT(*) > 1)
    UNION ALL SELECT 'fact_installment_payment_key_not_null', 'CRITICAL', COUNT(*) FROM v_instalment
              WHERE SK_ID_PREV IS NULL OR NUM_INSTALMENT_NUMBER IS NULL
    UNION ALL SELECT 'one_current_too_many', 'CRITICAL', COUNT(*)
              FROM (SELECT 1 FROM v_dim_v1 WHERE is_current GROUP BY applicant_id HAVING COUNT(*) > 1)
    UNION ALL SELECT 'one_current_none', 'CRITICAL', COUNT(*) FROM v_dim_src
              WHERE applicant_id NOT IN (SELECT applicant_id FROM v_dim_v1 WHERE is_current)""")
oracle("dq_scd2_intervals", "v_dim_v2", """
    , moved AS (
        SELECT applicant_id, start_date, is_current, cnt_children,
               CASE WHEN name_family_status = 'Single' THEN end_date - INTERVAL 1 DAY ELSE end_date END AS end_date
        FROM v_dim_v2 WHERE NOT (is_current AND name_income_type IS NULL)),
    broken AS (SELECT * FROM moved UNION ALL SELECT * FROM moved WHERE is_current AND cnt_children IS NULL),
    chained AS (SELECT *, lead(start_date) OVER w AS next_start, lead(TRUE, 1, FALSE) OVER w AS followed FROM broken
                WINDOW w AS (PARTITION BY applicant_id ORDER BY start_date, end_date NULLS LAST)),
    verdict AS (
        SELECT applicant_id, COUNT(*) AS versions, COUNT(*) FILTER (WHERE end_date IS NULL) AS open_versions,
               COUNT(*) FILTER (WHERE end_date <= start_date) AS empty_intervals,
               COUNT(*) FILTER (WHERE is_current <> (end_date IS NULL)) AS flag_mismatches,
               bool_or(CASE WHEN followed THEN end_date IS DISTINCT FROM next_start ELSE end_date IS NOT NULL END) AS broken_chain
        FROM chained GROUP BY 1)
    SELECT * FROM verdict WHERE open_versions <> 1 OR empty_intervals > 0 OR flag_mismatches > 0 OR broken_chain""")


def column_profile(column: str, name: str) -> str:
    return f"""SELECT '{name}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({column}) AS null_count,
        COUNT(DISTINCT {column}) AS distinct_values,
        ROUND(CAST(COUNT(*) - COUNT({column}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 6) AS null_rate,
        ROUND(CAST(COUNT({column}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 6) AS completeness FROM v_applicant"""


oracle("profile", "v_applicant", " UNION ALL ".join([
    column_profile("applicant_id", "applicant_id"), column_profile("DAYS_BIRTH", "DAYS_BIRTH"),
    column_profile("NULLIF(DAYS_EMPLOYED, 365243)", "DAYS_EMPLOYED"),
    column_profile("NULLIF(ORGANIZATION_TYPE, 'XNA')", "ORGANIZATION_TYPE"), column_profile("AMT_INCOME_TOTAL", "AMT_INCOME_TOTAL"),
    column_profile("segment", "segment"),
]))
oracle("metric_threshold", "v_loans v_bureau", f"""
    , metrics AS (
        SELECT 'default_rate:' || CASE WHEN GROUPING(NAME_CONTRACT_TYPE) = 1 THEN 'ALL' ELSE NAME_CONTRACT_TYPE END AS metric,
               {pct('COUNT(*) FILTER (WHERE TARGET = 1)', 'COUNT(*)')} AS value
        FROM v_loans GROUP BY GROUPING SETS ((), (NAME_CONTRACT_TYPE))
        UNION ALL SELECT 'delinquency_rate', {pct('COUNT(*) FILTER (WHERE CREDIT_DAY_OVERDUE > 0)', 'COUNT(*)')} FROM v_bureau),
    thresholds(metric, low, high) AS (VALUES ('default_rate:ALL', 45.0::DOUBLE, 55.0::DOUBLE),
        ('default_rate:1-URGENT', 0.0::DOUBLE, 50.0::DOUBLE), ('default_rate:5-LOW', 50.0::DOUBLE, NULL),
        ('delinquency_rate', NULL, 20.0::DOUBLE), ('never_published', 0.0::DOUBLE, 1.0::DOUBLE))
    SELECT t.metric, m.value, t.low, t.high,
           COALESCE(m.value < t.low, FALSE) OR COALESCE(m.value > t.high, FALSE) OR m.value IS NULL AS breached
    FROM metrics m RIGHT JOIN thresholds t USING (metric)""")

# --- parity ---------------------------------------------------------------------------------------


def manifest_row(name: str, view: str, keys: str, ts: str | None = "ingestion_ts") -> str:
    columns = keys.split(", ")
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    latest_ts = f"MAX({ts})" if ts else "CAST(NULL AS TIMESTAMP)"
    return f"""SELECT '{name}' AS table_name, COUNT(*) AS row_count,
        (SELECT COUNT(*) FROM (SELECT DISTINCT {keys} FROM {view} WHERE {complete})) AS key_distinct,
        COUNT(*) FILTER (WHERE NOT ({complete})) AS key_nulls, {latest_ts} AS max_ts FROM {view}"""


RAW = [
    manifest_row("instalments", "v_instalment", "SK_ID_PREV, NUM_INSTALMENT_NUMBER"),
    manifest_row("balance", "v_balance", "SK_ID_BUREAU, MONTHS_BALANCE"),
    manifest_row("application", "v_application", "SK_ID_CURR"),
]
CLEAN = [
    manifest_row("instalments", "v_instalment_latest", "SK_ID_PREV, NUM_INSTALMENT_NUMBER"),
    manifest_row("balance", "v_balance_latest", "SK_ID_BUREAU, MONTHS_BALANCE"),
    manifest_row("bureau", "v_bureau", "SK_ID_BUREAU", None),
]
oracle("manifest", "v_instalment v_balance v_application v_silver_source", f"""
    SELECT table_name, row_count, key_distinct, key_nulls, {text('max_ts')}
    FROM ({" UNION ALL ".join([*RAW, manifest_row("applicant", "v_silver_source", "SK_ID_CURR")])})""")
oracle("parity_manifest", "v_instalment_latest v_balance_latest v_application v_bureau", f"""
    , a AS ({" UNION ALL ".join(RAW)}), b AS ({" UNION ALL ".join(CLEAN)}),
    p AS (SELECT COALESCE(a.table_name, b.table_name) AS table_name, a.table_name IS NOT NULL AS in_a,
                 b.table_name IS NOT NULL AS in_b, a.row_count AS a_rows, b.row_count AS b_rows,
                 b.key_distinct, b.key_nulls,
                 CASE COALESCE(a.table_name, b.table_name) WHEN 'instalments' THEN (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
                      WHEN 'balance' THEN (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)) END AS stated
          FROM a FULL OUTER JOIN b ON a.table_name = b.table_name)
    SELECT table_name, 'T0' AS tier, CAST(in_a AS BIGINT) AS expected, CAST(in_b AS BIGINT) AS observed,
           in_a AND in_b AS passed FROM p
    UNION ALL SELECT table_name, 'T1', a_rows, b_rows, a_rows = b_rows FROM p WHERE in_a AND in_b
    UNION ALL SELECT table_name, 'T2', b_rows, key_distinct, key_distinct = b_rows FROM p WHERE in_a AND in_b
    UNION ALL SELECT table_name, 'T3', 0, key_nulls, key_nulls = 0 FROM p WHERE in_a AND in_b
    UNION ALL SELECT table_name, 'T5', stated, b_rows, b_rows = stated FROM p WHERE in_b AND stated IS NOT NULL""")
oracle("idempotency_check", "v_upserted", """
    , t AS (SELECT COUNT(*) AS n, COUNT(DISTINCT applicant_id) AS k, MAX(ingestion_ts) AS ts FROM v_target),
    u AS (SELECT COUNT(*) AS n, COUNT(DISTINCT applicant_id) AS k, MAX(ingestion_ts) AS ts FROM v_upserted)
    SELECT 'loans' AS table_name, 0 AS row_delta, TRUE AS in_both, TRUE AS rows_same, TRUE AS keys_same,
           TRUE AS latest_ts_same, TRUE AS passed FROM u
    UNION ALL
    SELECT 'target', u.n - t.n, TRUE, u.n = t.n, u.k = t.k, u.ts = t.ts, u.n = t.n AND u.k = t.k AND u.ts = t.ts
    FROM t, u""")


def digest(*columns: str) -> str:
    parts = [f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')" for c in columns]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


DIGEST = digest("applicant_id", "SK_ID_CURR", "NAME_CONTRACT_TYPE", "AMT_CREDIT", "ingestion_ts")
oracle("row_hash_diff", "v_upserted", f"""
    SELECT applicant_id, row_digest, CAST(SUM(l) AS BIGINT) AS n_left, CAST(SUM(r) AS BIGINT) AS n_right
    FROM (SELECT applicant_id, {DIGEST} AS row_digest, 1 AS l, 0 AS r FROM v_target
          UNION ALL SELECT applicant_id, {DIGEST}, 0, 1 FROM v_upserted)
    GROUP BY 1, 2 HAVING SUM(l) <> SUM(r)""")

_BEFORE = digest("applicant_id", "DAYS_BIRTH", "DAYS_EMPLOYED", "ORGANIZATION_TYPE", "CAST(AMT_INCOME_TOTAL AS DECIMAL(18,2))", "segment")
_AFTER = digest("applicant_id", "DAYS_BIRTH", "DAYS_EMPLOYED", "CASE WHEN DAYS_EMPLOYED <> 365243 THEN ORGANIZATION_TYPE END",
                "CAST(AMT_INCOME_TOTAL AS DECIMAL(18,2))", "segment")
for _name in ("row_hash_diff_screened", "row_hash_diff_sketched"):
    oracle(_name, "v_applicant", f"""
        SELECT applicant_id, {_BEFORE} AS row_digest, 1::BIGINT AS n_left, 0::BIGINT AS n_right FROM v_applicant WHERE DAYS_EMPLOYED = 365243
        UNION ALL SELECT applicant_id, {_AFTER}, 0, 1 FROM v_applicant WHERE DAYS_EMPLOYED = 365243""")

# --- profiles from sketches -----------------------------------------------------------------------

_PROFILED = " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) AS n, COUNT({c}) AS present FROM v_application"
                               for c in ("SK_ID_CURR", "applicant_id", "AMT_CREDIT", "TARGET", "ingestion_ts"))
oracle("profile_merged", "v_application", f"""
    SELECT column_name, n AS row_count, n - present AS null_count, ROUND(CAST(n - present AS DOUBLE) / n, 6) AS null_rate,
           ROUND(CAST(present AS DOUBLE) / n, 6) AS completeness, TRUE AS distinct_within_bound
    FROM ({_PROFILED})""")
_KNOWN = " UNION ".join(f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS x FROM v_application" for c in ("applicant_id", "NAME_CONTRACT_TYPE", "AMT_CREDIT"))
_ARRIVING = " UNION ".join(
    f"SELECT '{c}' AS c, CAST({e} AS VARCHAR) AS x FROM v_application WHERE TARGET IS NOT NULL"
    for c, e in (("client", "applicant_id"), ("contract", "NAME_CONTRACT_TYPE"), ("amount", "AMT_CREDIT"), ("fresh", "-SK_ID_CURR - 1")))
oracle("schema_renames", "v_application", f"""
    SELECT known, arriving FROM (
        SELECT k.c AS known, a.c AS arriving, COUNT(*) AS n FROM ({_KNOWN}) k JOIN ({_ARRIVING}) a USING (x) GROUP BY 1, 2)
    JOIN (SELECT c AS known, COUNT(*) AS n_known FROM ({_KNOWN}) GROUP BY 1) USING (known)
    JOIN (SELECT c AS arriving, COUNT(*) AS n_arriving FROM ({_ARRIVING}) GROUP BY 1) USING (arriving)
    WHERE 2 * n >= n_known + n_arriving - n""")
