"""Gold plan: staging views, facts, lookups, features and marts.

Facts hold measures next to their keys, so every indicator can be computed from
gold alone. A measure is carried when the input has it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fn
from ..operators import cleanse
from ..operators.scd2 import DIM_APPLICANT, DimensionSpec, join_current
from ..operators.upsert import lookup_rows

LOAN_GRAIN = ("SK_ID_CURR",)
BUREAU_GRAIN = ("SK_ID_BUREAU",)
INSTALMENT_GRAIN = ("SK_ID_PREV", "NUM_INSTALMENT_NUMBER")

# Monthly bureau status codes and what they stand for.
CREDIT_STATUS = {
    "C": "closed",
    "X": "status unknown",
    "0": "no days past due",
    "1": "1-30 days past due",
    "2": "31-60 days past due",
    "3": "61-90 days past due",
    "4": "91-120 days past due",
    "5": "over 120 days past due or written off",
}
OVERDUE_STATUSES = ("1", "2", "3", "4", "5")


def money(column: str):
    """Exact type for sums: a sum of doubles depends on the order of its tasks."""
    return F.col(column).cast("decimal(18,2)")


def exact_avg(column: str):
    return F.sum(money(column)).cast("double") / F.nullif(F.count(column), F.lit(0)).cast("double")


def _carried(df: DataFrame, columns: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in columns if c.lower() in have]


# --- views ----------------------------------------------------------------------------------------


def stg_application(silver_application: DataFrame, **options) -> DataFrame:
    return cleanse.stage_application(silver_application, **options)


def int_applicant_attributes(staged: DataFrame) -> DataFrame:
    """What the applicant dimension is built from."""
    return staged.select(
        "applicant_id", "SK_ID_CURR", "name_income_type", "name_education_type", "name_family_status", "cnt_children",
        *_carried(staged, ["ingestion_ts", "ingestion_date"]),
    )


def int_bureau_with_balance(bureau: DataFrame) -> DataFrame:
    """Key projection of bureau records."""
    return bureau.select("SK_ID_BUREAU", "SK_ID_CURR")


def balance_per_record(balance: DataFrame, key: str = "SK_ID_BUREAU", period: str = "MONTHS_BALANCE",
                       status: str = "STATUS", overdue: Sequence[str] = OVERDUE_STATUSES) -> DataFrame:
    """Monthly balance rows folded to one row per record; ``balance`` is unique on (key, period)."""
    return balance.groupBy(key).agg(
        F.count(F.lit(1)).alias("months_observed"),
        F.max(period).alias("latest_month"),
        F.min(period).alias("earliest_month"),
        F.count_if(F.col(status).isin(*overdue)).alias("overdue_months"),
    )


def bureau_with_balance(bureau: DataFrame, balance: DataFrame, **options) -> DataFrame:
    """Bureau records with their balance history, at bureau grain.

    The many side is folded before the join, so the join is one-to-one however
    many months a record has.
    """
    folded = balance_per_record(balance, **options)
    return bureau.join(folded, [folded.columns[0]], "left").fillna(0, ["months_observed", "overdue_months"])


# --- facts ----------------------------------------------------------------------------------------


def fact_loan_application(staged: DataFrame) -> DataFrame:
    return staged.select(
        fn.surrogate_key("SK_ID_CURR").alias("fact_loan_application_sk"),
        "SK_ID_CURR",
        "applicant_id",
        *_carried(staged, ["NAME_CONTRACT_TYPE", "TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL"]),
    )


def fact_bureau_credit(bureau: DataFrame) -> DataFrame:
    return bureau.select(
        fn.surrogate_key("SK_ID_BUREAU").alias("fact_bureau_credit_sk"),
        "SK_ID_BUREAU",
        "SK_ID_CURR",
        *_carried(bureau, ["CREDIT_DAY_OVERDUE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"]),
    )


def fact_installment_payment(instalments: DataFrame) -> DataFrame:
    return instalments.select(
        fn.surrogate_key(*INSTALMENT_GRAIN).alias("fact_installment_payment_sk"),
        *INSTALMENT_GRAIN,
        *_carried(instalments, ["SK_ID_CURR", "AMT_INSTALMENT", "AMT_PAYMENT"]),
    )


# --- lookups --------------------------------------------------------------------------------------


def dim_loan_type(application: DataFrame, source: str = "NAME_CONTRACT_TYPE") -> DataFrame:
    return lookup_rows(application, source, "loan_type_id", "loan_type_name")


def dim_credit_status(balance: DataFrame, source: str = "STATUS",
                      descriptions: Mapping[str, str] = CREDIT_STATUS) -> DataFrame:
    return lookup_rows(balance, source, "status_id", "status_code", descriptions, "status_description")


# --- features and marts ---------------------------------------------------------------------------


def prev_app_count(applicants: DataFrame, previous: DataFrame, key: str = "applicant_id") -> DataFrame:
    """Previous applications per applicant, zero where there are none."""
    counts = previous.groupBy(key).agg(F.count(F.lit(1)).alias("prev_app_count"))
    return applicants.select(key).join(counts, [key], "left").fillna(0, ["prev_app_count"])


def credit_risk_features(applicants: DataFrame, fact: DataFrame, bureau: DataFrame, records: DataFrame,
                         key: str = "applicant_id", income: str = "AMT_INCOME_TOTAL", previous: DataFrame | None = None) -> DataFrame:
    """One row per applicant: application volume, income to credit, bureau delinquency, balance depth.

    ``records`` is bureau with its folded balance. Each many side is reduced to
    one row per applicant first; all joins are on that same key. Applications are counted in ``previous``, the
    applicant's earlier ones, or in ``fact`` where none is given.
    """
    credits = F.sum(money("AMT_CREDIT")).cast("double").alias("total_credit")
    number = F.count(F.lit(1)).alias("application_count")
    if previous is None:
        applications = fact.groupBy(key).agg(number, credits)
    else:
        applications = fact.groupBy(key).agg(credits).join(previous.groupBy(key).agg(number), [key], "full_outer")
    credit = bureau.groupBy(key).agg(
        F.count(F.lit(1)).alias("bureau_records"),
        F.count_if(F.col("CREDIT_DAY_OVERDUE") > 0).alias("overdue_records"),
    )
    depth = records.groupBy(key).agg(
        F.sum("months_observed").alias("balance_months"), F.max("months_observed").alias("deepest_history")
    )
    joined = (
        applicants.select(key, F.col(income).alias("_income"))
        .join(applications, [key], "left")
        .join(credit, [key], "left")
        .join(depth, [key], "left")
    )
    counts = ["application_count", "bureau_records", "overdue_records", "balance_months", "deepest_history"]
    return joined.select(
        key,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.round(F.coalesce(F.col("total_credit"), F.lit(0.0)), 2).alias("total_credit"),
        F.round(F.col("_income") / F.nullif(F.col("total_credit"), F.lit(0.0)), 6).alias("income_to_credit"),
        F.round(
            100.0 * F.col("overdue_records").cast("double") / F.nullif(F.col("bureau_records"), F.lit(0)).cast("double"), 6
        ).alias("delinquency_rate"),
    )


def credit_risk_summary(fact: DataFrame, dim: DataFrame, income: str = "AMT_INCOME_TOTAL",
                        by: str = "NAME_CONTRACT_TYPE", spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Per loan type: volume, default rate, average credit, income to credit, applicants covered by the dimension.

    Income is read from the fact, or from the dimension where the fact lacks it.
    """
    looked_up = ["_known"] if _carried(fact, [income]) else ["_known", income]
    joined = join_current(fact, dim.withColumn("_known", F.lit(1)), looked_up, spec)
    ratio = (F.col(income) / F.nullif(F.col("AMT_CREDIT"), F.lit(0.0))).cast("decimal(18,6)")
    return joined.groupBy(by).agg(
        F.count(F.lit(1)).alias("applications"),
        F.count_if(F.col("TARGET") == 1).alias("defaults"),
        F.round(100.0 * F.count_if(F.col("TARGET") == 1) / F.count(F.lit(1)), 6).alias("default_rate"),
        F.round(exact_avg("AMT_CREDIT"), 6).alias("avg_credit"),
        F.round(F.sum(ratio).cast("double") / F.nullif(F.count(ratio), F.lit(0)).cast("double"), 6).alias(
            "income_to_credit"
        ),
        F.count("_known").alias("with_applicant"),
    )
