"""One registered query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import asof, cleanse, keysets, parity, profiles, reconcile, scd2, upsert
from sedimenta.operators import quality as q
from sedimenta.plans import gold, kpis, silver
from sedimenta.sources import files
from sedimenta.sources.registry import SENTINEL_DAYS_EMPLOYED, SENTINEL_ORGANIZATION, TABLES

from . import views as v

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

INSTALMENT_ORDER, INSTALMENT_TIES = ["ingestion_ts"], ["tie_1", "tie_2"]
SENTINELS = {"DAYS_EMPLOYED": SENTINEL_DAYS_EMPLOYED, "ORGANIZATION_TYPE": SENTINEL_ORGANIZATION}
LOAN_RULES = {rule: predicate for rule, (_, predicate) in TABLES["application_train"].rules.items()}
LOAN_TYPES = {"SK_ID_CURR": "bigint", "AMT_CREDIT": "double", "DAYS_DECISION": "int"}


def register(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: v.comparable(fn(spark, sf_dir), fn.__name__)
    return fn


# --- sources --------------------------------------------------------------------------------------


@register
def audit_tag(spark, sf):
    return files.tag_audit(v.table(spark, sf, "orders"), ingestion_ts="2024-01-30T06:00:00+00:00", batch_id="batch_001",
                           env="dev")


@register
def sample_limit(spark, sf):
    return files.sample_limit(v.application(spark, sf), ["SK_ID_CURR"], 5000)


@register
def stratified_sample(spark, sf):
    return files.stratified_sample(v.application(spark, sf), "SK_ID_CURR", "TARGET", 0.015, seed=42)


@register
def stratified_sample_exact(spark, sf):
    return files.stratified_sample_exact(v.application(spark, sf), "SK_ID_CURR", "TARGET", 0.015, seed=42)


@register
def schema_drift(spark, sf):
    expected = {"o_orderkey": "bigint", "o_custkey": "int", "o_orderstatus": "int", "o_totalprice": "double",
                "o_orderpriority": "string", "o_clerk": "string"}
    return files.schema_drift(v.table(spark, sf, "orders"), expected)


# --- projection, casts, masking -------------------------------------------------------------------


@register
def stg_application(spark, sf):
    return gold.stg_application(v.silver_source(spark, sf))


@register
def int_applicant_attributes(spark, sf):
    return gold.int_applicant_attributes(gold.stg_application(v.silver_source(spark, sf)))


@register
def int_bureau_with_balance(spark, sf):
    return gold.int_bureau_with_balance(v.bureau(spark, sf))


@register
def typed_cast(spark, sf):
    text = v.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS SK_ID_CURR",
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS AMT_CREDIT",
        "CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE CAST(-(o_orderkey % 700) AS STRING) END AS DAYS_DECISION",
    )
    tagged = q.with_failed_rules(text, cleanse.failed_cast_rules(text, LOAN_TYPES))
    return cleanse.with_casts(tagged, LOAN_TYPES).withColumn("failed_rules", F.array_join("failed_rules", ","))


@register
def null_sentinel(spark, sf):
    return cleanse.null_sentinels(v.applicant(spark, sf), SENTINELS, flag_suffix="_IS_SENTINEL")


@register
def pii_mask(spark, sf):
    return cleanse.mask_columns(v.applicant(spark, sf), ["DAYS_BIRTH", "DAYS_EMPLOYED"], SENTINELS)


@register
def scd_prep(spark, sf):
    return cleanse.with_version_columns(v.application(spark, sf))


@register
def balance_snapshot(spark, sf):
    return cleanse.snapshot(v.balance(spark, sf), ["SK_ID_BUREAU", "MONTHS_BALANCE"], ["ingestion_ts"], tiebreak=["tie_1"])


# --- latest per key, per table --------------------------------------------------------------------


def _latest_instalment(spark, sf):
    return cleanse.latest_per_key(v.instalment(spark, sf), gold.INSTALMENT_GRAIN, INSTALMENT_ORDER, INSTALMENT_TIES)


def _latest_balance(spark, sf):
    return cleanse.latest_per_key(v.balance(spark, sf), ["SK_ID_BUREAU", "MONTHS_BALANCE"], ["ingestion_ts"], ["tie_1"])


@register
def latest_instalment(spark, sf):
    return _latest_instalment(spark, sf)


@register
def latest_balance(spark, sf):
    return _latest_balance(spark, sf)


@register
def latest_by_arrival(spark, sf):
    """All events are one batch of one moment: the row that stands last in the file counts, whatever its values."""
    arrived = files.with_source_line(v.table(spark, sf, "events")).selectExpr(
        "user_id AS SK_ID_PREV", "event_type AS STATUS", "CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS AMT_BALANCE",
        f"TIMESTAMP_NTZ '{v.DIM_START}' AS ingestion_ts", "'batch_001' AS batch_id", "source_line")
    return cleanse.latest_per_key(arrived, ["SK_ID_PREV"]).drop("source_line")


def _silver(source: str, view, tiebreak=("arrival",)) -> None:
    spec = TABLES[source]

    def query(spark, sf):
        prepared = silver.prepare(silver.keyed(view(spark, sf), spec), spec, tiebreak=tiebreak)
        return v.comparable(prepared.withColumn(silver.FAILED, F.array_join(silver.FAILED, ",")), spec.silver)

    QUERIES[spec.silver] = query


_silver("application_train", v.bronze_application)
_silver("bureau", v.bronze_bureau)
_silver("bureau_balance", v.bronze_bureau_balance)
_silver("previous_application", v.bronze_previous_application, ("arrival", "arrival_line", "arrival_supplier"))
_silver("installments_payments", v.bronze_instalments, ("arrival", "arrival_supplier"))
_silver("POS_CASH_balance", v.bronze_prev_balance)
_silver("credit_card_balance", v.bronze_prev_balance)


# --- versioned dimension --------------------------------------------------------------------------


def _applied(spark, sf):
    return scd2.apply_scd2(v.dim_v1(spark, sf), v.dim_source(spark, sf), v.AS_OF)


@register
def tracked_change(spark, sf):
    return scd2.changed_rows(v.dim_v1(spark, sf), v.dim_source(spark, sf))


@register
def scd2_expire(spark, sf):
    return scd2.expiring_versions(v.dim_v1(spark, sf), v.dim_source(spark, sf), v.AS_OF)


@register
def scd2_insert(spark, sf):
    return scd2.opening_versions(v.dim_v1(spark, sf), v.dim_source(spark, sf), v.AS_OF)


@register
def scd2_apply(spark, sf):
    return _applied(spark, sf)


@register
def scd2_close_missing(spark, sf):
    return scd2.apply_scd2(v.dim_v1(spark, sf), v.dim_source(spark, sf), v.AS_OF, close_missing=True)


@register
def scd2_return(spark, sf):
    """Entities closed because they were missing come back: a new version after a gap."""
    closed = scd2.apply_scd2(v.dim_v1(spark, sf), v.dim_source(spark, sf), v.AS_OF, close_missing=True)
    return scd2.apply_scd2(closed, v.batch(spark, sf, v.FIRST_BATCH), v.RETURN, close_missing=True)


@register
def scd2_idempotent(spark, sf):
    return scd2.apply_scd2(_applied(spark, sf), v.dim_source(spark, sf), v.LATER)


@register
def scd2_chain(spark, sf):
    """Every order is an arrival of its own moment: one run over all of them, after a first load of each applicant's earliest."""
    told = v.statements(spark, sf)
    first = told.filter("k = 1").drop("k")
    later = told.filter("k > 1").drop("k")
    return scd2.apply_arrivals(scd2.version_chains(first, "told_at"), later, "told_at")


@register
def scd2_late(spark, sf):
    """The same arrivals, those of odd orders a run too late: they are cut into the versions that the even ones made."""
    told = v.statements(spark, sf).drop("k")
    even, odd = told.filter("SK_ID_CURR % 2 = 0"), told.filter("SK_ID_CURR % 2 = 1")
    return scd2.apply_arrivals(scd2.version_chains(even, "told_at"), odd, "told_at", earlier=even)


@register
def fact_join_current(spark, sf):
    fact = v.application(spark, sf).select("SK_ID_CURR", "applicant_id", "AMT_CREDIT")
    dim = _applied(spark, sf)
    return scd2.join_current(fact, dim, ["applicant_sk", "name_income_type", "cnt_children", "start_date"])


def _applications_over_time(spark, sf):
    return v.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS SK_ID_CURR", "o_custkey AS applicant_id",
        "CAST(date_add(DATE '2024-01-01', CAST(o_orderkey % 60 AS INT)) AS TIMESTAMP_NTZ) AS applied_at",
    )


@register
def fact_join_asof(spark, sf):
    fact, dim = _applications_over_time(spark, sf), _applied(spark, sf)
    return scd2.join_as_of(fact, dim, "applied_at", ["applicant_sk", "name_income_type", "cnt_children", "start_date"])


@register
def fact_join_asof_sorted(spark, sf):
    fact, dim = _applications_over_time(spark, sf), _applied(spark, sf)
    return asof.join_as_of(fact, dim, "applied_at", ["applicant_sk", "name_income_type", "cnt_children", "start_date"])


# --- upserts --------------------------------------------------------------------------------------


def _upserted(spark, sf):
    return upsert.upsert(v.upsert_target(spark, sf), v.upsert_updates(spark, sf), ["applicant_id"])


def _money_as_double(df):
    return df.withColumn("AMT_CREDIT", F.col("AMT_CREDIT").cast("double"))


@register
def upsert_rows(spark, sf):
    return _money_as_double(_upserted(spark, sf))


QUERIES["upsert"] = QUERIES.pop("upsert_rows")


@register
def upsert_idempotent(spark, sf):
    return _money_as_double(upsert.upsert(_upserted(spark, sf), v.upsert_updates(spark, sf), ["applicant_id"]))


@register
def upsert_latest(spark, sf):
    merged = upsert.upsert_latest(v.upsert_target(spark, sf), v.upsert_updates(spark, sf), ["applicant_id"])
    return _money_as_double(merged)


@register
def dim_loan_type(spark, sf):
    return gold.dim_loan_type(v.application(spark, sf))


@register
def dim_credit_status(spark, sf):
    return gold.dim_credit_status(v.balance(spark, sf), descriptions=v.EVENT_STATUSES)


# --- facts and marts ------------------------------------------------------------------------------


def _loans(spark, sf):
    good, _ = q.split_quarantine(v.application(spark, sf), LOAN_RULES)
    return gold.fact_loan_application(good)


@register
def fact_loan_application(spark, sf):
    return _loans(spark, sf)


@register
def fact_bureau_credit(spark, sf):
    return gold.fact_bureau_credit(v.bureau(spark, sf))


@register
def fact_installment_payment(spark, sf):
    return gold.fact_installment_payment(_latest_instalment(spark, sf))


def _records(spark, sf):
    return gold.bureau_with_balance(v.bureau(spark, sf), _latest_balance(spark, sf), overdue=["error"])


@register
def bureau_with_balance(spark, sf):
    return _records(spark, sf)


@register
def prev_app_count(spark, sf):
    return gold.prev_app_count(v.applicant(spark, sf), v.application(spark, sf))


@register
def credit_risk_features(spark, sf):
    by_applicant = {"SK_ID_CURR": "applicant_id"}
    return gold.credit_risk_features(
        v.applicant(spark, sf), _loans(spark, sf), v.bureau(spark, sf).withColumnsRenamed(by_applicant),
        _records(spark, sf).withColumnsRenamed(by_applicant),
    )


@register
def credit_risk_summary(spark, sf):
    applicants = v.applicant(spark, sf).select("applicant_id", "AMT_INCOME_TOTAL")
    dim = _applied(spark, sf).join(applicants, ["applicant_id"])
    return gold.credit_risk_summary(_loans(spark, sf), dim)


# --- indicators -----------------------------------------------------------------------------------


@register
def kpi_default_rate(spark, sf):
    return kpis.default_rate(_loans(spark, sf))


@register
def kpi_avg_credit(spark, sf):
    return kpis.avg_credit(_loans(spark, sf))


@register
def kpi_delinquency(spark, sf):
    return kpis.delinquency_rate(v.bureau(spark, sf))


@register
def kpi_income_credit(spark, sf):
    return kpis.income_to_credit(_loans(spark, sf), v.applicant(spark, sf), "segment")


@register
def kpi_masked_presence(spark, sf):
    masked = cleanse.mask_columns(v.applicant(spark, sf), ["DAYS_BIRTH", "DAYS_EMPLOYED"], SENTINELS)
    return kpis.masked_presence(masked)


@register
def balance_trend(spark, sf):
    return kpis.balance_trend(_latest_balance(spark, sf))


@register
def balance_trend_incremental(spark, sf):
    """The trend after half of the balances, brought up to date from what an upsert of the other half replaced and added."""
    keys, order = ["SK_ID_BUREAU", "MONTHS_BALANCE"], ["ingestion_ts", "tie_1"]
    stored, arrived = (cleanse.latest_per_key(v.balance(spark, sf).filter(f"tie_1 % 2 = {i}"), keys, order) for i in (0, 1))
    accepted = upsert.accepted_updates(stored, arrived, keys, order)
    changes = upsert.signed_changes(stored, accepted, keys, ["MONTHS_BALANCE", "AMT_BALANCE"])
    sums = kpis.changed_sums(kpis.trend_sums(stored), kpis.trend_sums(changes, F.col("sign")))
    return kpis.balance_trend_of(sums)


@register
def delinquency_trend(spark, sf):
    return kpis.delinquency_trend(_latest_balance(spark, sf), F.col("STATUS") == "error")


# --- quality --------------------------------------------------------------------------------------


@register
def quarantine_split(spark, sf):
    tagged = q.with_failed_rules(v.application(spark, sf), LOAN_RULES)
    return tagged.select("SK_ID_CURR", (F.size("failed_rules") > 0).alias("quarantined"),
                         F.array_join("failed_rules", ",").alias("failed_rules"))


@register
def dq_duplicate_keys(spark, sf):
    return q.duplicate_keys(v.instalment(spark, sf), gold.INSTALMENT_GRAIN)


@register
def dq_multi_current(spark, sf):
    dim = v.dim_v1(spark, sf)
    return q.multiple_current(dim.unionByName(dim.filter("cnt_children IS NULL")))


@register
def dq_zero_current(spark, sf):
    return q.no_current(v.dim_v1(spark, sf), v.dim_source(spark, sf))


def _references(spark, sf, orphans):
    customer, orders = v.table(spark, sf, "customer"), v.table(spark, sf, "orders")
    found = {
        "customer_without_events": orphans(customer, "c_custkey", v.table(spark, sf, "events"), "user_id"),
        "order_without_lines": orphans(orders, "o_orderkey", v.table(spark, sf, "lineitem"), "l_orderkey"),
        "line_of_quarantined_order": orphans(v.table(spark, sf, "lineitem"), "l_orderkey", _loans(spark, sf), "SK_ID_CURR"),
    }
    parts = [rows.select(F.lit(name).alias("reference"), "key", "child_rows") for name, rows in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def profile_merged(spark, sf):
    """A profile of all applications from the sketches of each loan type; distinct counts against exact ones."""
    rows = v.application(spark, sf)
    sketched = profiles.profile_of(profiles.merged(profiles.profile_sketches(rows, by=["NAME_CONTRACT_TYPE"])))
    exact = q.profile(rows.drop("NAME_CONTRACT_TYPE"), exact=True).select("column_name", F.col("distinct_values").alias("_exact"))
    near = F.abs(F.col("distinct_values") - F.col("_exact")) <= 1 + 0.04 * F.col("_exact")
    return sketched.join(exact, ["column_name"]).select("column_name", "row_count", "null_count", "null_rate", "completeness", near.alias("distinct_within_bound"))


@register
def schema_renames(spark, sf):
    """Applications whose next delivery lacks the undecided ones and names three columns anew; a fourth column is new."""
    known = v.application(spark, sf)
    arriving = known.filter("TARGET IS NOT NULL").withColumnsRenamed({"applicant_id": "client", "NAME_CONTRACT_TYPE": "contract", "AMT_CREDIT": "amount"})
    found = profiles.renamed_columns(profiles.profile_sketches(known), profiles.profile_sketches(arriving.withColumn("fresh", -F.col("SK_ID_CURR") - 1)))
    return spark.createDataFrame([(a, b) for a, (b, _) in found.items()], "known string, arriving string")  # one row per renamed column


@register
def dq_orphans(spark, sf):
    return _references(spark, sf, q.orphans)


@register
def dq_orphans_by_blocks(spark, sf):
    return _references(spark, sf, keysets.orphans_by_blocks)


@register
def dq_bronze(spark, sf):
    return q.bronze_checks(v.bronze_instalments(spark, sf), gold.INSTALMENT_GRAIN, expected_rows=v.table(spark, sf, "lineitem").count())


@register
def dq_silver(spark, sf):
    return q.silver_checks(_latest_instalment(spark, sf), gold.INSTALMENT_GRAIN,
                           {"payment_negative": "AMT_PAYMENT < 0", "amount_high": "AMT_INSTALMENT > 50000"})


def _mask_results(spark, sf):
    raw = v.applicant(spark, sf)
    masked = cleanse.mask_columns(raw, ["DAYS_BIRTH", "DAYS_EMPLOYED"], SENTINELS)
    return q.mask_checks(raw, masked, ["applicant_id"], "DAYS_EMPLOYED", SENTINEL_DAYS_EMPLOYED)


@register
def dq_mask(spark, sf):
    return _mask_results(spark, sf)


@register
def dq_results(spark, sf):
    return q.check_results("run_001", {
        "application": q.bronze_checks(v.application(spark, sf), ["SK_ID_CURR"]),
        "instalment": q.bronze_checks(v.instalment(spark, sf), gold.INSTALMENT_GRAIN),
        "applicant": _mask_results(spark, sf),
    })


@register
def dq_gate_counts(spark, sf):
    fact = gold.fact_installment_payment(v.instalment(spark, sf))
    dim = v.dim_v1(spark, sf)
    return q.gate_counts([
        *q.fact_gates(fact, "fact_installment_payment", gold.INSTALMENT_GRAIN, q.INSTALMENT_GRAIN),
        q.Gate("one_current_too_many", q.multiple_current(dim), code=q.MULTIPLE_CURRENT),
        q.Gate("one_current_none", q.no_current(dim, v.dim_source(spark, sf)), code=q.NO_CURRENT),
    ])


@register
def dq_scd2_intervals(spark, sf):
    """Interval check on a dimension with injected gaps, missing open rows, and repeats."""
    dim = _applied(spark, sf)
    broken = dim.withColumn(
        "end_date",
        F.expr("CASE WHEN name_family_status = 'Single' THEN end_date - INTERVAL 1 DAY ELSE end_date END"),
    ).filter("NOT (is_current AND name_income_type IS NULL)")
    return scd2.interval_violations(broken.unionByName(broken.filter("is_current AND cnt_children IS NULL")))


@register
def profile(spark, sf):
    masked = cleanse.null_sentinels(v.applicant(spark, sf), SENTINELS)
    return q.profile(masked, exact=True)


@register
def metric_threshold(spark, sf):
    metrics = (
        kpis.default_rate(_loans(spark, sf))
        .select(F.concat(F.lit("default_rate:"), "loan_type").alias("metric"), F.col("default_rate").alias("value"))
        .unionByName(
            kpis.delinquency_rate(v.bureau(spark, sf)).select(
                F.lit("delinquency_rate").alias("metric"), F.col("delinquency_rate").alias("value")
            )
        )
    )
    thresholds = spark.sql(
        "SELECT * FROM VALUES ('default_rate:ALL', 45.0D, 55.0D), ('default_rate:1-URGENT', 0.0D, 50.0D),"
        " ('default_rate:5-LOW', 50.0D, CAST(NULL AS DOUBLE)), ('delinquency_rate', CAST(NULL AS DOUBLE), 20.0D),"
        " ('never_published', 0.0D, 1.0D)"
        " AS t(metric, low, high)"
    )
    return q.threshold_breaches(metrics, thresholds)


# --- parity ---------------------------------------------------------------------------------------


def _raw_tables(spark, sf):
    return {
        "instalments": (v.instalment(spark, sf), gold.INSTALMENT_GRAIN, "ingestion_ts"),
        "balance": (v.balance(spark, sf), ["SK_ID_BUREAU", "MONTHS_BALANCE"], "ingestion_ts"),
        "application": (v.application(spark, sf), ["SK_ID_CURR"], "ingestion_ts"),
    }


def _clean_tables(spark, sf):
    return {
        "instalments": (_latest_instalment(spark, sf), gold.INSTALMENT_GRAIN, "ingestion_ts"),
        "balance": (_latest_balance(spark, sf), ["SK_ID_BUREAU", "MONTHS_BALANCE"], "ingestion_ts"),
        "bureau": (v.bureau(spark, sf), ["SK_ID_BUREAU"], None),
    }


@register
def manifest(spark, sf):
    nullable = v.silver_source(spark, sf)
    return parity.manifests({**_raw_tables(spark, sf), "applicant": (nullable, ["SK_ID_CURR"], "ingestion_ts")})


@register
def parity_manifest(spark, sf):
    return parity.compare_manifests(
        parity.manifests(_raw_tables(spark, sf)), parity.manifests(_clean_tables(spark, sf)),
        expected_rows={
            "instalments": v.instalment(spark, sf).select(*gold.INSTALMENT_GRAIN).distinct().count(),
            "balance": v.balance(spark, sf).select("SK_ID_BUREAU", "MONTHS_BALANCE").distinct().count(),
        },
    )


@register
def idempotency_check(spark, sf):
    once = _upserted(spark, sf)
    twice = upsert.upsert(once, v.upsert_updates(spark, sf), ["applicant_id"])
    before = {"loans": (once, ["applicant_id"], "ingestion_ts"),
              "target": (v.upsert_target(spark, sf), ["applicant_id"], "ingestion_ts")}
    after = {"loans": (twice, ["applicant_id"], "ingestion_ts"), "target": (once, ["applicant_id"], "ingestion_ts")}
    return parity.compare_runs(parity.manifests(before), parity.manifests(after))


@register
def row_hash_diff(spark, sf):
    return parity.row_hash_diff(v.upsert_target(spark, sf), _upserted(spark, sf), ["applicant_id"])


def _remasked(spark, sf):
    """The applicant table and its re-masked copy, in which a few rows lost their organisation."""
    before = v.applicant(spark, sf).withColumn("AMT_INCOME_TOTAL", F.col("AMT_INCOME_TOTAL").cast("decimal(18,2)"))
    after = before.withColumn("ORGANIZATION_TYPE", F.expr("CASE WHEN DAYS_EMPLOYED <> 365243 THEN ORGANIZATION_TYPE END"))
    return before, after


@register
def row_hash_diff_screened(spark, sf):
    return parity.row_hash_diff(*_remasked(spark, sf), ["applicant_id"], screen=256)


@register
def row_hash_diff_sketched(spark, sf):
    return reconcile.row_hash_diff(*_remasked(spark, sf), ["applicant_id"])
