"""Risk indicators and trends. Rates are percentages rounded to six places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gold import exact_avg, money

ALL_GROUPS = "ALL"


def _rate(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), 6)


def default_rate(fact: DataFrame, by: str = "NAME_CONTRACT_TYPE", key: str = "SK_ID_CURR") -> DataFrame:
    """Share of applications in default, overall (``ALL``) and per loan type.

    Counted per type first; the grouping sets run over that small result.
    """
    per_type = fact.groupBy(F.col(by).alias("loan_type")).agg(
        F.count(key).alias("_n"), F.count_if((F.col("TARGET") == 1) & F.col(key).isNotNull()).alias("_d")
    )
    sets = per_type.groupingSets([["loan_type"], []], "loan_type").agg(
        F.sum("_n").alias("applications"), F.sum("_d").alias("defaults"), F.grouping("loan_type").alias("_all")
    )
    return sets.select(
        F.when(F.col("_all") == 1, F.lit(ALL_GROUPS)).otherwise(F.col("loan_type")).alias("loan_type"),
        F.coalesce("applications", F.lit(0)).alias("applications"),
        F.coalesce("defaults", F.lit(0)).alias("defaults"),
        _rate(F.col("defaults"), F.col("applications")).alias("default_rate"),
    )


def avg_credit(fact: DataFrame, by: str = "NAME_CONTRACT_TYPE") -> DataFrame:
    return fact.groupBy(F.col(by).alias("loan_type")).agg(
        F.count(F.lit(1)).alias("applications"), F.round(exact_avg("AMT_CREDIT"), 6).alias("avg_credit")
    )


def delinquency_rate(bureau: DataFrame) -> DataFrame:
    overdue, records = F.count_if(F.col("CREDIT_DAY_OVERDUE") > 0), F.count("SK_ID_BUREAU")
    return bureau.agg(
        records.alias("bureau_records"), overdue.alias("overdue_records"), _rate(overdue, records).alias("delinquency_rate")
    )


def income_to_credit(fact: DataFrame, applicants: DataFrame, segment: str, income: str = "AMT_INCOME_TOTAL",
                     key: str = "applicant_id") -> DataFrame:
    """Mean of income over credit per segment; applications without credit are left out of the mean.

    Income is read from the fact, or from ``applicants`` where the fact lacks it.
    """
    ratio = (F.col(income) / F.nullif(F.col("AMT_CREDIT"), F.lit(0.0))).cast("decimal(18,6)")
    in_fact = [income] if income in fact.columns else []
    looked_up = [segment] if in_fact else [segment, income]
    return (
        fact.select(key, "AMT_CREDIT", *in_fact)
        .join(applicants.select(key, *looked_up), [key], "inner")
        .groupBy(F.col(segment).alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("applications"),
            F.round(F.sum(ratio).cast("double") / F.nullif(F.count(ratio), F.lit(0)).cast("double"), 6).alias(
                "income_to_credit"
            ),
        )
    )


def masked_presence(applicants: DataFrame, masked: str = "DAYS_EMPLOYED_MASKED", income: str = "AMT_INCOME_TOTAL",
                    edges: Sequence[float] = (0.0, 2500.0, 5000.0, 7500.0)) -> DataFrame:
    """How many applicants per income bracket carry a masked value. Presence only.

    Bracket ``i`` holds incomes from ``edges[i-1]`` up to below ``edges[i]``.
    """
    bracket = F.lit(0)
    for edge in edges:
        bracket = bracket + F.when(F.col(income) >= edge, 1).otherwise(0)
    bracket = F.when(F.col(income).isNotNull(), bracket)
    return applicants.groupBy(bracket.alias("income_bracket")).agg(
        F.count(F.lit(1)).alias("applicants"),
        F.count(masked).alias("with_masked_value"),
        _rate(F.count(masked), F.count(F.lit(1))).alias("presence_rate"),
    )


def balance_trend(balance: DataFrame, amount: str = "AMT_BALANCE", period: str = "MONTHS_BALANCE") -> DataFrame:
    """Accounts, total and average balance per period."""
    return balance.groupBy(period).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.round(F.sum(money(amount)).cast("double"), 2).alias("total_balance"),
        F.round(exact_avg(amount), 6).alias("avg_balance"),
    )


# --- trends kept up to date from changes ----------------------------------------------------------

#: What a trend is made of, per period: sums that a change adds to or takes from.
TREND_SUMS = ("accounts", "amounts", "total", "known", "late")


def trend_sums(rows: DataFrame, sign: Column | int = 1, amount: str = "AMT_BALANCE", overdue: str = "SK_DPD",
               period: str = "MONTHS_BALANCE") -> DataFrame:
    """Per period the sums behind ``balance_trend`` and ``pos_trend``, each row counted ``sign`` times.

    ``accounts`` rows, ``amounts`` and ``total`` known amounts and their exact sum, ``known`` and ``late`` rows that say how many days they are
    overdue, and that are. A column the rows lack adds nothing.
    """
    sign = sign if isinstance(sign, Column) else F.lit(sign)
    value = money(amount) if amount in rows.columns else F.lit(None).cast("decimal(18,2)")
    days = F.col(overdue) if overdue in rows.columns else F.lit(None).cast("int")
    none = F.lit(0)
    return rows.groupBy(period).agg(
        F.sum(sign).cast("bigint").alias("accounts"),
        F.sum(F.when(value.isNotNull(), sign).otherwise(none)).cast("bigint").alias("amounts"),
        F.coalesce(F.sum(value * sign.cast("decimal(1,0)")), F.lit(0)).cast("decimal(38,2)").alias("total"),
        F.sum(F.when(days.isNotNull(), sign).otherwise(none)).cast("bigint").alias("known"),
        F.sum(F.when(days > 0, sign).otherwise(none)).cast("bigint").alias("late"),
    )


def changed_sums(sums: DataFrame, changes: DataFrame, period: str = "MONTHS_BALANCE") -> DataFrame:
    """Sums after the signed sums of what changed; periods without rows are gone. Reads one row per period and change."""
    both = sums.unionByName(changes)
    found = both.groupBy(period).agg(*[F.sum(c).alias(c) for c in TREND_SUMS])
    return found.filter("accounts <> 0").select(period, *[F.col(c).cast(sums.schema[c].dataType).alias(c) for c in TREND_SUMS])


def balance_trend_of(sums: DataFrame, period: str = "MONTHS_BALANCE") -> DataFrame:
    """``balance_trend`` from its sums."""
    total = F.when(F.col("amounts") > 0, F.col("total").cast("double"))
    return sums.select(period, "accounts", F.round(total, 2).alias("total_balance"), F.round(total / F.nullif(F.col("amounts"), F.lit(0)).cast("double"), 6).alias("avg_balance"))


def pos_trend_of(sums: DataFrame, period: str = "MONTHS_BALANCE") -> DataFrame:
    """``pos_trend`` from its sums."""
    return sums.select(period, "accounts", F.col("late").alias("delinquent_accounts"), _rate(F.col("late"), F.nullif(F.col("known"), F.lit(0))).alias("delinquency_rate"))


def delinquency_trend(balance: DataFrame, delinquent: Column, period: str = "MONTHS_BALANCE") -> DataFrame:
    """Share of accounts for which ``delinquent`` holds, per period."""
    return balance.groupBy(period).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.count_if(delinquent).alias("delinquent_accounts"),
        _rate(F.count_if(delinquent), F.count(F.lit(1))).alias("delinquency_rate"),
    )


def pos_trend(pos: DataFrame, overdue: str = "SK_DPD", period: str = "MONTHS_BALANCE") -> DataFrame:
    """Accounts per period and the share of them past due; NULL where the source does not say how many days."""
    late = F.col(overdue) > 0 if overdue in pos.columns else F.lit(None).cast("boolean")
    known = F.count(late)
    return pos.groupBy(period).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.count_if(late).alias("delinquent_accounts"),
        _rate(F.count_if(late), F.nullif(known, F.lit(0))).alias("delinquency_rate"),
    )
