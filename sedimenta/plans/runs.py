"""Layer runs: ingest a batch, build silver, build gold.

Each run is inputs -> staged result -> gates -> publish, in order of data
dependency. A run that fails leaves every published table at its last good
version, and running it again gives the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import parity, scd2
from ..operators import quality as q
from ..sources import files, landing, sinks
from ..sources.registry import INGESTION_DATE, INGESTION_TS, TABLES, TableSpec
from . import gold, kpis, schemas, silver

BRONZE_PARTITIONS = (INGESTION_DATE, "batch_id")


def _specs(tables: Sequence[str] | None) -> list[TableSpec]:
    return [TABLES[name] for name in (tables or TABLES)]


def _path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


# --- bronze ---------------------------------------------------------------------------------------


def ingest(spark: SparkSession, landing_dir: str, bronze_root: str, *, batch_id: str, env: str,
           ingestion_ts: datetime | str, tables: Sequence[str] | None = None, replay: bool = True) -> dict[str, dict]:
    """Load every landed table of a batch into bronze, tagged.

    A batch owns its partition, so loading it again replaces it, on whatever day. ``replay=False``
    appends instead and keeps every copy. Returns per table the rows written,
    the rows without a complete key and the lines that did not parse, counted
    while writing.
    """
    written = {}
    for spec in _specs(tables):
        df = files.scan_source(spark, landing_dir, spec, ingestion_ts=ingestion_ts, batch_id=batch_id, env=env)
        path = f"{bronze_root}/{spec.bronze}"
        if _path_exists(spark, path):
            files.require_no_drift(spark.read.parquet(path).drop(*BRONZE_PARTITIONS).schema,
                                   df.drop(*BRONZE_PARTITIONS).schema, spec.bronze)
        seen = Observation()
        incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(incomplete).alias("missing_keys"),
                        F.count(files.CORRUPT).alias("unparsed_lines"))
        if replay:
            sinks.replace_partitions(df, path, BRONZE_PARTITIONS)
            day = files.utc(ingestion_ts).date().isoformat()
            sinks.drop_folders(spark, f"{path}/{INGESTION_DATE}=*/batch_id={batch_id}", keep=f"/{INGESTION_DATE}={day}/")
        else:
            sinks.append_partitioned(df, path, BRONZE_PARTITIONS)
        written[spec.bronze] = seen.get
    return written


def replay(spark: SparkSession, landing_dir: str, bronze_root: str, recorded: DataFrame, *, batch_id: str,
           tables: Sequence[str] | None = None) -> dict[str, dict]:
    """Rebuild a batch's bronze partition from landing, as it was first loaded.

    ``recorded`` is the stored landing manifest. Landing must still hold the
    recorded files byte for byte; timestamp and environment are the recorded ones.
    """
    batch = recorded.filter(F.col("batch_id") == batch_id)
    q.enforce([q.Gate("landing_unchanged", landing.landing_changes(batch, landing.landing_manifest(spark, landing_dir)))])
    micros, env = batch.agg(F.max(F.unix_micros("ingestion_ts")), F.max("env")).first()
    if micros is None:
        raise ValueError(f"no landing record of batch {batch_id}")
    moment = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)
    return ingest(spark, landing_dir, bronze_root, batch_id=batch_id, env=env, ingestion_ts=moment, tables=tables)


def check_bronze(spark: SparkSession, bronze_root: str, run_id: str, *, batch_id: str,
                 expected_rows: dict[str, int] | None = None, tables: Sequence[str] | None = None,
                 enforce: bool = False) -> DataFrame:
    """Check results of a batch's bronze rows; with ``enforce`` a failed CRITICAL one raises, HIGH ones are only returned."""
    expected_rows = expected_rows or {}
    return _checked(enforce, q.check_results(
        run_id,
        {
            spec.bronze: q.bronze_checks(
                files.scan_layer(spark, f"{bronze_root}/{spec.bronze}", batch_ids=[batch_id]),
                spec.keys,
                expected_rows=expected_rows.get(spec.source),
            )
            for spec in _specs(tables)
        },
    ))


def _checked(enforce: bool, results: DataFrame) -> DataFrame:
    if enforce:
        q.enforce_checks(results)
    return results


# --- silver ---------------------------------------------------------------------------------------


def build_silver(spark: SparkSession, bronze_root: str, root: str, *, batch_ids: Sequence[str] | None = None,
                 tables: Sequence[str] | None = None, drop_raw: bool = True,
                 layouts: Mapping[str, sinks.Layout] | None = None, snapshots: Mapping[str, int] | None = None) -> dict[str, dict[str, int]]:
    """Upsert each table's cleaned rows; rows that break a rule go to quarantine.

    Afterwards the published tables are checked; a failed CRITICAL check raises. With ``batch_ids`` only
    those bronze partitions are read. The cleaned batch is written once to a shared work folder, so the good and the bad rows do not
    each repeat the dedup shuffle. ``layouts`` lays out tables by silver name. ``snapshots`` names, by source, the one month whose
    balances a table keeps; the filter reaches the scan of bronze.
    """
    counts = {}
    for spec in _specs(tables):
        layout = (layouts or {}).get(spec.silver, sinks.Layout())
        bronze = files.scan_layer(spark, f"{bronze_root}/{spec.bronze}", batch_ids=batch_ids)
        if spec.source in (snapshots or {}):
            bronze = bronze.filter(F.col("MONTHS_BALANCE") == snapshots[spec.source])
        prepared = silver.prepare(silver.keyed(bronze, spec), spec, drop_raw=drop_raw).withColumn("_bad", silver.is_bad())
        work = sinks.shared_work_dir(spark, root)
        try:
            prepared.write.partitionBy("_bad").parquet(work)
            staged = spark.read.schema(prepared.schema).parquet(work)
            good = staged.filter(~F.col("_bad")).drop("_bad", silver.FAILED)
            bad = staged.filter(F.col("_bad")).drop("_bad")
            counts[spec.silver] = sinks.publish_upsert(
                spark, spec.silver, layout.apply(good), spec.keys, root, order=[INGESTION_TS], buckets=layout.buckets,
                partition_by=layout.partition_by, changes=spec.trend,
                gates=(lambda rows, spec=spec: silver.mask_gates(rows, spec)) if drop_raw else None,
            )
            _quarantine(bad.unionByName(silver.keyless(bronze, spec, drop_raw=drop_raw)), f"{root}/{spec.quarantine}",
                        batch_ids)
        finally:
            sinks.drop_work_dir(spark, work)
    check_silver(spark, "build_silver", tables, enforce=True)
    return counts


def _quarantine(rows: DataFrame, path: str, batch_ids: Sequence[str] | None) -> None:
    """A batch's quarantine is replaced as a whole, also by an empty one."""
    if batch_ids is None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(path)
        return
    sinks.replace_partitions(rows.filter(F.col("batch_id").isin(*batch_ids)), path, ["batch_id"])
    filled = {r[0] for r in rows.select("batch_id").distinct().collect()}  # one row per batch
    for batch_id in set(batch_ids) - filled:
        # Rows of a batch that has none now are those of an earlier run.
        sinks.drop_folders(rows.sparkSession, f"{path}/batch_id={batch_id}")


def silver_manifest(spark: SparkSession, tables: Sequence[str] | None = None) -> DataFrame:
    return parity.manifests({s.silver: (spark.table(s.silver), s.keys, INGESTION_TS) for s in _specs(tables)})


def check_silver(spark: SparkSession, run_id: str, tables: Sequence[str] | None = None, *, enforce: bool = False) -> DataFrame:
    """Check results of the published silver tables, one pass each; with ``enforce`` a failed CRITICAL one raises."""
    checks = {}
    for spec in _specs(tables):
        df = spark.table(spec.silver)
        rules = {name: predicate for name, (column, predicate) in spec.rules.items() if column in df.columns}
        masked = [c for c in spec.masked if f"{c}_MASKED" in df.columns]
        checks[spec.silver] = q.silver_checks(df, spec.keys, rules, masked, spec.sentinels)
    return _checked(enforce, q.check_results(run_id, checks))


def check_references(spark: SparkSession, tables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Orphans per silver table that declares a parent."""
    return {
        spec.silver: q.orphans(spark.table(spec.silver), spec.parent[1], spark.table(spec.parent[0]), spec.parent[1])
        for spec in _specs(tables)
        if spec.parent
    }


# --- gold -----------------------------------------------------------------------------------------


def loans(application: DataFrame) -> DataFrame:
    """Silver applications as the loan fact reads them."""
    return application.filter(F.col("SK_ID_CURR").isNotNull()).withColumn("applicant_id", F.col("SK_ID_CURR"))


def build_gold(spark: SparkSession, root: str, as_of: datetime | str, *, batch_ids: Sequence[str] | None = None,
               close_missing: bool = False, sliced: bool = False,
               layouts: Mapping[str, sinks.Layout] | None = None, bronze_root: str | None = None) -> dict[str, dict[str, int]]:
    """Applicant dimension first, then the facts that refer to it, each behind its gates.

    Without ``batch_ids`` facts are reloaded whole. With them, only the silver
    rows those batches left behind are read: the dimension sees them as its
    source and the facts are upserted, so cost follows what changed. Silver tables that ``layouts`` names with key ranges are read
    in the ranges only that the batches' rows in ``bronze_root`` fall into. ``sliced``
    keeps closed versions in partitions of their own, which a run leaves alone.
    """
    if batch_ids is not None and close_missing:
        raise ValueError("closing missing applicants needs the whole source")
    layouts = layouts or {}

    def arrived(name: str) -> DataFrame:
        df = spark.table(name)
        if batch_ids is None:
            return df
        layout = layouts.get(name, sinks.Layout())
        if bronze_root and layout.partition_by:
            spec = next(s for s in TABLES.values() if s.silver == name)
            landed = files.scan_layer(spark, f"{bronze_root}/{spec.bronze}", batch_ids=batch_ids)
            df = sinks.touched_partitions(df, layout.apply(landed), layout.partition_by)
        return df.filter(F.col("batch_id").isin(*batch_ids))

    application = arrived("silver_application")
    attributes = gold.int_applicant_attributes(gold.stg_application(application))
    if sliced:
        versions = sinks.publish_dimension_sliced(spark, "dim_applicant", attributes, as_of, root, close_missing=close_missing)
    else:
        versions = sinks.publish_dimension(
            spark, "dim_applicant", attributes, as_of, root, close_missing=close_missing,
            buckets=layouts.get("dim_applicant", sinks.Layout()).buckets,
        )
    counts = {"dim_applicant": versions}
    applicants = scd2.current_rows(spark.table("dim_applicant"))
    facts = {
        "fact_loan_application": gold.fact_loan_application(loans(application)),
        "fact_bureau_credit": gold.fact_bureau_credit(arrived("silver_bureau")),
        "fact_installment_payment": gold.fact_installment_payment(arrived("silver_installments_payments")),
    }
    for name, fact in facts.items():
        grain, code = GRAINS[name]

        def gates(staged: DataFrame, name=name, grain=grain, code=code) -> list[q.Gate]:
            return _fact_gates(staged, name, grain, code, applicants)

        layout = layouts.get(name, sinks.Layout())
        rows = layout.apply(schemas.fit(fact, schemas.gold_schema(name)))
        if batch_ids is None and layout.partition_by is None:
            counts[name] = sinks.publish(spark, name, rows, root, gates=gates, buckets=layout.buckets)
        else:
            counts[name] = sinks.publish_upsert(spark, name, rows, grain, root, gates=gates, buckets=layout.buckets,
                                                partition_by=layout.partition_by)
    lookups = {
        "dim_loan_type": (gold.dim_loan_type, application, "NAME_CONTRACT_TYPE", "loan_type_id"),
        "dim_credit_status": (gold.dim_credit_status, arrived("silver_bureau_balance"), "STATUS", "status_id"),
    }
    for name, (build, rows, code, key) in lookups.items():
        if code in rows.columns:
            counts[name] = sinks.publish_upsert(spark, name, build(rows), [key], root)
    return counts


GRAINS = {
    "fact_loan_application": (gold.LOAN_GRAIN, q.LOAN_GRAIN),
    "fact_bureau_credit": (gold.BUREAU_GRAIN, q.BUREAU_GRAIN),
    "fact_installment_payment": (gold.INSTALMENT_GRAIN, q.INSTALMENT_GRAIN),
}


def check_gold(spark: SparkSession, run_id: str) -> DataFrame:
    """Check results of the published gold tables: grains, references, one current version, intervals."""
    dim = spark.table("dim_applicant")
    source = gold.int_applicant_attributes(gold.stg_application(spark.table("silver_application")))
    absences = sinks.closes_missing(spark, "dim_applicant")
    checks = {"dim_applicant": q.gate_results(sinks.dimension_gates(source, absences=absences)(dim))}
    for name, (grain, code) in GRAINS.items():
        checks[name] = q.gate_results(_fact_gates(spark.table(name), name, grain, code, scd2.current_rows(dim)))
    return q.check_results(run_id, checks)


def _fact_gates(fact: DataFrame, name: str, grain: Sequence[str], code: int, applicants: DataFrame) -> list[q.Gate]:
    # A loan without its applicant is an error of the build; bureau and
    # instalment rows of applicants outside this extract are only counted.
    severity = "CRITICAL" if name == "fact_loan_application" else "HIGH"
    reference = q.orphans(fact, "SK_ID_CURR", applicants, "SK_ID_CURR")
    return [*q.fact_gates(fact, name, grain, code), q.Gate(f"{name}_applicant", reference, severity)]


#: Trend mart -> (silver table, how the mart follows from its sums).
TRENDS = {
    "mart_card_balance_trend": ("silver_credit_card_balance", kpis.balance_trend_of),
    "mart_pos_trend": ("silver_pos_cash_balance", kpis.pos_trend_of),
}


def refresh_trend(spark: SparkSession, name: str, root: str) -> tuple[dict[str, int], bool]:
    """Bring a trend up to date; (gate counts, whether that was done from changes alone).

    The sums behind the trend are a small table of their own that says which version of silver it reflects. If all changes since
    are known, only these are read and added up; silver itself is not. Otherwise (the first run, an interrupted upsert, a table
    written some other way) the sums are made anew.
    """
    source, trend_of = TRENDS[name]
    state = f"{name}_sums"
    silver_now = sinks.table_version(spark, source)
    reflected = sinks.reflects(spark, state)
    steps = sinks.changes_since(spark, source, root, reflected) if reflected else None
    if steps is None:
        sums = kpis.trend_sums(spark.table(source))
    else:
        paths, silver_now = steps
        sums = spark.table(state)
        if paths:
            changes = spark.read.schema(_change_schema(spark, source)).parquet(*paths)
            sums = kpis.changed_sums(sums, kpis.trend_sums(changes, F.col("sign")))
    if reflected:
        sinks.note_reflects(spark, state, "")  # until the new sums are in place they reflect no version
    counts = sinks.publish(spark, state, sums, root, gates=sinks.key_gates(state, ["MONTHS_BALANCE"]))
    sinks.note_reflects(spark, state, silver_now or "")
    sinks.forget_changes(spark, source, root)  # a trend is all that follows them
    counts |= sinks.publish(spark, name, trend_of(spark.table(state)), root, gates=sinks.key_gates(name, ["MONTHS_BALANCE"]))
    return counts, steps is not None


def _change_schema(spark: SparkSession, source: str) -> T.StructType:
    fields = {f.name: f for f in spark.table(source).schema.fields}
    trend = next(s.trend for s in TABLES.values() if s.silver == source)
    return T.StructType([*(fields[c] for c in trend if c in fields), T.StructField("sign", T.IntegerType())])


def build_marts(spark: SparkSession, root: str) -> dict[str, dict[str, int]]:
    """Applicant risk features, the per-loan-type summary and the balance trends, from published tables only.

    Trends follow the changes that the silver upserts kept, where these are complete."""
    fact, bureau = spark.table("fact_loan_application"), spark.table("fact_bureau_credit")
    records = gold.bureau_with_balance(bureau, spark.table("silver_bureau_balance"))
    features = gold.credit_risk_features(fact, fact, bureau, records, key="SK_ID_CURR", previous=spark.table("silver_previous_application"))
    summary = gold.credit_risk_summary(fact, spark.table("dim_applicant"))
    marts = [("int_credit_risk_features", features, ["SK_ID_CURR"]), ("mart_credit_risk_summary", summary, ["NAME_CONTRACT_TYPE"])]
    counts = {name: sinks.publish(spark, name, rows, root, gates=sinks.key_gates(name, keys)) for name, rows, keys in marts}
    return counts | {name: refresh_trend(spark, name, root)[0] for name in TRENDS}


def indicators(spark: SparkSession) -> dict[str, DataFrame]:
    """The risk indicators, each from gold (masked presence from silver, where the mask is)."""
    fact = spark.table("fact_loan_application")
    applicants = scd2.current_rows(spark.table("dim_applicant"))
    return {
        "default_rate": kpis.default_rate(fact),
        "avg_credit": kpis.avg_credit(fact),
        "delinquency_rate": kpis.delinquency_rate(spark.table("fact_bureau_credit")),
        "income_to_credit": kpis.income_to_credit(fact, applicants, "name_income_type"),
        "masked_presence": kpis.masked_presence(spark.table("silver_application")),
    }


def check_thresholds(spark: SparkSession, thresholds: DataFrame) -> DataFrame:
    """The published indicators' single figures against ``thresholds(metric, low, high)``."""
    found = indicators(spark)
    rate = found["default_rate"]
    metrics = rate.select(F.concat(F.lit("default_rate:"), "loan_type").alias("metric"), F.col("default_rate").alias("value")).unionByName(
        found["delinquency_rate"].select(F.lit("delinquency_rate").alias("metric"), F.col("delinquency_rate").alias("value")))
    return q.threshold_breaches(metrics, thresholds)


def record_results(results: DataFrame, path: str) -> None:
    """Store check results; a run's own rows are replaced when it is repeated."""
    sinks.replace_partitions(results, path, ["run_id"])
