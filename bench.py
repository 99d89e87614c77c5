"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full (every output row is computed and discarded by
the ``noop`` sink) after one warm-up of the whole set; the figure is the best
of $BENCH_RUNS timed runs. The ingest and publish workloads write real tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from sedimenta.plans import gold, runs, silver
from sedimenta.session import local_session
from sedimenta.sources import sinks
from sedimenta.sources.registry import INGESTION_TS, TABLES
from workload import views
from workload.queries import QUERIES

HEADLINE = (
    "latest_instalment", "latest_balance", "silver_application", "silver_bureau", "silver_installments_payments",
    "silver_previous_application", "silver_bureau_balance", "pii_mask", "quarantine_split", "upsert", "upsert_latest",
    "scd2_apply", "scd2_idempotent", "fact_loan_application", "fact_bureau_credit", "fact_installment_payment",
    "fact_join_current", "fact_join_asof", "bureau_with_balance", "kpi_default_rate", "kpi_income_credit",
    "credit_risk_features", "credit_risk_summary", "dq_orphans", "dq_scd2_intervals", "manifest", "parity_manifest",
    "row_hash_diff", "profile",
)


def run_query(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def landed_csv(spark, sf_dir: str, root: str) -> int:
    """The instalment rows as one landed CSV; returns their number."""
    rows = views.bronze_instalments(spark, sf_dir).select("SK_ID_PREV", "SK_ID_CURR", "NUM_INSTALMENT_NUMBER",
                                                          "AMT_INSTALMENT", "AMT_PAYMENT")
    rows.write.option("header", True).csv(f"{root}/landing/installments_payments.csv")
    return rows.count()


def ingest(spark, root: str, tag: str) -> None:
    """Landed CSV -> typed, tagged bronze partition."""
    runs.ingest(spark, f"{root}/landing", f"{root}/bronze_{tag}", batch_id=tag, env="dev",
                ingestion_ts="2024-01-01T00:00:00", tables=["installments_payments"])


def publish_silver(spark, sf_dir: str, root: str, tag: str) -> None:
    """Instalments: dedup, casts and rule tags, then a gated upsert into a published table."""
    spec = TABLES["installments_payments"]
    good, _ = silver.prepared(views.bronze_instalments(spark, sf_dir), spec, tiebreak=["arrival", "arrival_supplier"])
    sinks.publish_upsert(spark, f"bench_silver_{tag}", good.drop(silver.FAILED), spec.keys, root, order=[INGESTION_TS])


APPLICANTS = int(os.environ.get("BENCH_APPLICANTS", "300000"))


def applicants(spark, sf_dir: str, root: str) -> tuple[int, int]:
    """Both batches of applicants, each applicant repeated under keys of their own until a batch has ``APPLICANTS``; their numbers."""
    counts = []
    for name, status in (("first", views.FIRST_BATCH), ("second", views.SECOND_BATCH)):
        batch = views.batch(spark, sf_dir, status)
        times = -(-APPLICANTS // max(1, batch.count()))
        copies = batch.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
        key = (F.col("applicant_id") * times + F.col("_copy")).cast("bigint")
        copies.withColumns({"applicant_id": key, "SK_ID_CURR": key}).drop("_copy").write.parquet(f"{root}/applicants/{name}")
        counts.append(spark.read.parquet(f"{root}/applicants/{name}").count())
    return counts[0], counts[1]


def publish_dimension(spark, root: str, tag: str) -> None:
    """Applicant dimension: a first load and one changing run, each behind its gates."""
    for name, moment in (("first", views.DIM_START), ("second", views.AS_OF)):
        sinks.publish_dimension(spark, f"bench_dim_{tag}", spark.read.parquet(f"{root}/applicants/{name}"), moment, root)


def publish_fact(spark, root: str, tag: str) -> None:
    fact = gold.fact_installment_payment(spark.table(f"bench_silver_{tag}"))
    sinks.publish(spark, f"bench_fact_{tag}", fact, root, gates=sinks.key_gates("fact", gold.INSTALMENT_GRAIN))


def timed(work, *args) -> float:
    started = time.perf_counter()
    work(*args)
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    root = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cpus, "bench", "8g", **{"spark.sql.warehouse.dir": f"{root}/warehouse"})
    timings: dict[str, float] = {}
    for name in names:
        run_query(spark, name, sf_dir)
    for name in names:
        timings[name] = round(min(run_query(spark, name, sf_dir) for _ in range(repeats)), 3)
    instalments = landed_csv(spark, sf_dir, root)
    offered = sum(applicants(spark, sf_dir, root))
    writes: dict[str, list[float]] = {}
    for tag in ["warm", *(f"run{i}" for i in range(repeats))]:
        for name, seconds in (
            ("ingest_instalments", timed(ingest, spark, root, tag)),
            ("publish_silver_instalments", timed(publish_silver, spark, sf_dir, root, tag)),
            ("publish_dim_applicant", timed(publish_dimension, spark, root, tag)),
            ("publish_fact_instalments", timed(publish_fact, spark, root, tag)),
        ):
            writes.setdefault(name, []).append(seconds)
    timings.update({name: min(seconds[1:]) for name, seconds in writes.items()})
    balances = views.balance(spark, sf_dir).count()
    facts = spark.table("bench_fact_run0").count()
    throughput = {
        "bronze_instalments": instalments / timings["ingest_instalments"],
        "silver_instalments": instalments / timings["publish_silver_instalments"],
        "gold_fact_instalments": facts / timings["publish_fact_instalments"],
        "dim_applicant": offered / timings["publish_dim_applicant"],
    }
    if "silver_bureau_balance" in timings:
        throughput["silver_balance"] = balances / timings["silver_bureau_balance"]
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
        "rows_per_second": {name: round(value) for name, value in throughput.items()},
    }))


if __name__ == "__main__":
    main()
