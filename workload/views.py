"""Driver tables seen as the lending domain. Each view reads a whole table.

``MONTHS_BALANCE`` counts days before 2024-01-30, so it is 0, -1, -2, ...
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SNAPSHOT_DAY = "2024-01-30"
DIM_START = "2024-01-01 00:00:00"
AS_OF = "2024-02-01 00:00:00"
RETURN = "2024-03-01 00:00:00"
LATER = "2024-03-01 00:00:00"
EVENT_STATUSES = {"error": "failed attempt", "purchase": "completed purchase"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Integer columns with NULLs, per query. Clients read them as integers or as
# floats, depending on the engine; both sides give them as doubles.
WIDENED = {
    "sample_limit": ["TARGET"],
    "stratified_sample": ["TARGET"],
    "stratified_sample_exact": ["TARGET"],
    "scd_prep": ["TARGET"],
    "typed_cast": ["DAYS_DECISION"],
    "null_sentinel": ["DAYS_EMPLOYED"],
    "silver_application": ["CNT_CHILDREN", "TARGET"],
    "silver_bureau": ["DAYS_CREDIT"],
    "silver_previous_application": ["DAYS_DECISION"],
    "bureau_with_balance": ["earliest_month", "latest_month"],
    **dict.fromkeys(
        ["scd2_expire", "scd2_insert", "scd2_apply", "scd2_close_missing", "scd2_return", "scd2_idempotent", "scd2_chain", "scd2_late", "fact_join_current",
         "fact_join_asof", "fact_join_asof_sorted"],
        ["cnt_children"],
    ),
}


def comparable(df: DataFrame, query: str) -> DataFrame:
    """Times as text and NULL-bearing integers as doubles, so that a result reads the same in any engine."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(f.name, TIME_TEXT).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif f.name in WIDENED.get(query, []):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def application(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("SK_ID_CURR"),
        F.col("o_custkey").alias("applicant_id"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        F.col("o_totalprice").alias("AMT_CREDIT"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END").alias("TARGET"),
        F.col("o_orderdate").alias("ingestion_ts"),
    )


def applicant(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS applicant_id",
        "CAST(-7000 - c_custkey % 18000 AS INT) AS DAYS_BIRTH",
        "CASE WHEN c_custkey % 11 = 0 THEN 365243 ELSE CAST(-(c_custkey % 9000) AS INT) END AS DAYS_EMPLOYED",
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'XNA' ELSE c_mktsegment END AS ORGANIZATION_TYPE",
        "c_acctbal AS AMT_INCOME_TOTAL",
        "c_mktsegment AS segment",
    )


def instalment(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS SK_ID_PREV",
        "l_linenumber AS NUM_INSTALMENT_NUMBER",
        "l_partkey AS SK_ID_CURR",
        "l_extendedprice AS AMT_INSTALMENT",
        "l_extendedprice * (1 - l_discount) AS AMT_PAYMENT",
        "l_shipdate AS ingestion_ts",
        "l_partkey AS tie_1",
        "l_suppkey AS tie_2",
    )


def bureau(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id AS SK_ID_BUREAU",
        "user_id AS SK_ID_CURR",
        "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS CREDIT_DAY_OVERDUE",
        "value AS AMT_CREDIT_SUM",
    )


def balance(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "user_id AS SK_ID_BUREAU",
        f"CAST(datediff(CAST(ts AS DATE), DATE '{SNAPSHOT_DAY}') AS INT) AS MONTHS_BALANCE",
        "event_type AS STATUS",
        "value AS AMT_BALANCE",
        "ts AS ingestion_ts",
        "event_id AS tie_1",
    )


FIRST_BATCH, SECOND_BATCH = ("F", "P"), ("O",)  # order statuses; together they are all orders


def batch(spark, sf, status):
    """Latest application of each applicant within one batch, with the applicant's attributes."""
    from sedimenta.operators.cleanse import latest_per_key

    arrived = table(spark, sf, "orders").filter(F.col("o_orderstatus").isin(*status))
    latest = latest_per_key(arrived, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    return latest.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        "c_custkey AS applicant_id",
        "c_custkey AS SK_ID_CURR",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Working'"
        " WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'Pensioner' END AS name_income_type",
        "n_name AS name_education_type",
        "CASE WHEN o_totalprice < 250000 THEN 'Single' ELSE 'Married' END AS name_family_status",
        "CASE WHEN o_totalprice >= 50000 THEN CAST(floor(o_totalprice / 250000) AS INT) END AS cnt_children",
    )


def dim_v1(spark, sf):
    """Dimension after a first load of the first batch."""
    from sedimenta.operators.scd2 import first_versions

    return first_versions(batch(spark, sf, FIRST_BATCH), DIM_START)


def statements(spark, sf):
    """Every order as what it says about its applicant from its moment on, the k-th of that applicant; the last order of a moment counts."""
    from pyspark.sql import Window

    from sedimenta.operators.cleanse import latest_per_key

    last = latest_per_key(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"], ["o_orderkey"], [])
    told = last.selectExpr(
        "o_custkey AS applicant_id",
        "o_orderkey AS SK_ID_CURR",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Working' WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'Pensioner' END AS name_income_type",
        "'Higher' AS name_education_type",
        "CASE WHEN o_totalprice < 250000 THEN 'Single' ELSE 'Married' END AS name_family_status",
        "CASE WHEN o_totalprice >= 50000 THEN CAST(floor(o_totalprice / 250000) AS INT) END AS cnt_children",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS told_at",
    )
    return told.withColumn("k", F.row_number().over(Window.partitionBy("applicant_id").orderBy("told_at")))


def dim_source(spark, sf):
    """The second batch: some applicants new, some missing, most changed, some not."""
    return batch(spark, sf, SECOND_BATCH)


def silver_source(spark, sf):
    """Silver application rows with NULL keys among them, as the staging view reads them."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "CASE WHEN c_acctbal >= 0 THEN c_custkey END AS SK_ID_CURR",
        "c_mktsegment AS NAME_INCOME_TYPE",
        "n_name AS NAME_EDUCATION_TYPE",
        "CASE WHEN c_acctbal < 5000 THEN 'A' ELSE 'B' END AS NAME_FAMILY_STATUS",
        "CAST(c_nationkey AS INT) AS CNT_CHILDREN",
        "c_acctbal AS AMT_INCOME_TOTAL",
        f"TIMESTAMP_NTZ '{DIM_START}' AS ingestion_ts",
    )


def _latest_loan(status):
    def view(spark, sf):
        from sedimenta.operators.cleanse import latest_per_key

        arrived = table(spark, sf, "orders").filter(F.col("o_orderstatus").isin(*status))
        return latest_per_key(arrived, ["o_custkey"], ["o_orderdate"], ["o_orderkey"]).selectExpr(
            "o_custkey AS applicant_id", "o_orderkey AS SK_ID_CURR", "o_orderpriority AS NAME_CONTRACT_TYPE",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS AMT_CREDIT", "o_orderdate AS ingestion_ts",
        )

    return view


upsert_target = _latest_loan(FIRST_BATCH)
upsert_updates = _latest_loan(SECOND_BATCH)


# --- bronze stand-ins for the registry's seven tables ----------------------------------------------


def bronze_application(spark, sf):
    """Several arrivals per applicant, with text that does not parse and NULL targets."""
    return table(spark, sf, "orders").selectExpr(
        "o_custkey AS SK_ID_CURR",
        "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' END AS TARGET",
        "o_orderpriority AS NAME_CONTRACT_TYPE",
        "CASE WHEN o_totalprice < 50000 THEN 0.0D ELSE o_totalprice END AS AMT_CREDIT",
        "CAST(-7000 - o_custkey % 18000 AS INT) AS DAYS_BIRTH",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN 365243 ELSE CAST(-(o_orderkey % 9000) AS INT) END AS DAYS_EMPLOYED",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'XNA' ELSE o_orderpriority END AS ORGANIZATION_TYPE",
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'many' ELSE substring(o_orderpriority, 1, 1) END AS CNT_CHILDREN",
        "o_orderdate AS ingestion_ts",
        "o_orderkey AS arrival",
    )


def bronze_bureau(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "user_id AS SK_ID_BUREAU",
        "event_id AS SK_ID_CURR",
        "CASE WHEN event_type = 'error' THEN 'none' ELSE CAST(-(event_id % 900) AS STRING) END AS DAYS_CREDIT",
        "CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS AMT_CREDIT_SUM",
        "value AS AMT_CREDIT_SUM_DEBT",
        "ts AS ingestion_ts",
        "event_id AS arrival",
    )


def bronze_previous_application(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_partkey AS SK_ID_PREV",
        "l_suppkey AS SK_ID_CURR",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS AMT_CREDIT",
        "CASE WHEN l_returnflag = 'N' THEN 'pending' ELSE CAST(-CAST(l_quantity AS INT) AS STRING) END AS DAYS_DECISION",
        "l_shipdate AS ingestion_ts",
        "l_orderkey AS arrival",
        "l_linenumber AS arrival_line",
        "l_suppkey AS arrival_supplier",
    )


def bronze_instalments(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS SK_ID_PREV",
        "l_linenumber AS NUM_INSTALMENT_NUMBER",
        "l_partkey AS SK_ID_CURR",
        "CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END"
        " AS AMT_INSTALMENT",
        "l_extendedprice AS AMT_PAYMENT",
        "l_shipdate AS ingestion_ts",
        "l_partkey AS arrival",
        "l_suppkey AS arrival_supplier",
    )


def _monthly(key: str):
    def view(spark, sf):
        return table(spark, sf, "events").selectExpr(
            f"user_id AS {key}",
            f"CAST(datediff(CAST(ts AS DATE), DATE '{SNAPSHOT_DAY}') AS INT) AS MONTHS_BALANCE",
            "event_type AS STATUS",
            "value AS AMT_BALANCE",
            "ts AS ingestion_ts",
            "event_id AS arrival",
        )

    return view


bronze_bureau_balance = _monthly("SK_ID_BUREAU")
bronze_prev_balance = _monthly("SK_ID_PREV")
