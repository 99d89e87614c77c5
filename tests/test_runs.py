"""Landing files -> bronze -> silver -> gold, on small CSVs of all seven tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import parity
from sedimenta.operators import quality as q
from sedimenta.plans import gold, runs, schemas
from sedimenta.sources import files, landing, sinks
from sedimenta.sources.registry import TABLES

N = 60
LAYOUTS = {
    "silver_application": sinks.Layout(range_key="SK_ID_CURR", range_width=20),
    "silver_installments_payments": sinks.Layout(buckets=sinks.Buckets(("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"), 2)),
}


def write_batch(landing, *, children=lambda k: k % 3, applicants=range(N)):
    landing.mkdir(parents=True, exist_ok=True)

    def put(name, header, lines):
        (landing / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")

    put("application_train",
        "SK_ID_CURR,TARGET,NAME_CONTRACT_TYPE,AMT_CREDIT,AMT_INCOME_TOTAL,DAYS_BIRTH,DAYS_EMPLOYED,ORGANIZATION_TYPE,"
        "NAME_INCOME_TYPE,NAME_EDUCATION_TYPE,NAME_FAMILY_STATUS,CNT_CHILDREN",
        [
            f"{k},{'' if k % 20 == 7 else k % 2},{'Cash' if k % 3 else 'Revolving'},{1000 + k},{500 + k},{-9000 - k},"
            f"{365243 if k % 5 == 0 else -k},{'XNA' if k % 5 == 0 else 'School'},Working,Higher,Married,{children(k)}"
            for k in applicants
        ] + [",1,Cash,1,1,-9000,-1,School,Working,Higher,Married,0", "9999,1,Cash,oops,1,-9000,-1,School,Working,Higher,Married,0"])
    put("bureau", "SK_ID_CURR,SK_ID_BUREAU,DAYS_CREDIT,AMT_CREDIT_SUM,AMT_CREDIT_SUM_DEBT,CREDIT_DAY_OVERDUE",
        [f"{b % (N + 10)},{b},{-b},{b * 10}.5,{b}.25,{b % 4}" for b in range(100)])
    put("bureau_balance", "SK_ID_BUREAU,MONTHS_BALANCE,STATUS", [f"{b % 100},{-(b % 7)},{'CX012345'[b % 8]}" for b in range(700)])
    put("previous_application", "SK_ID_PREV,SK_ID_CURR,AMT_CREDIT,DAYS_DECISION", [f"{p},{p % N},{p}.0,{-p}" for p in range(80)])
    put("installments_payments", "SK_ID_PREV,SK_ID_CURR,NUM_INSTALMENT_NUMBER,AMT_INSTALMENT,AMT_PAYMENT",
        [f"{i % 40},{i % 40 % N},{i % 3},{i}.5,{i}.5" for i in range(300)])
    for name in ("POS_CASH_balance", "credit_card_balance"):
        put(name, "SK_ID_PREV,SK_ID_CURR,MONTHS_BALANCE,AMT_BALANCE", [f"{i % 50},{i % 50},{-(i % 6)},{i}.0" for i in range(300)])


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("zone")
    write_batch(base / "landing" / "b1")
    paths = {"landing": base / "landing", "bronze": str(base / "bronze"), "root": str(base / "tables")}
    paths["written"] = runs.ingest(spark, str(base / "landing" / "b1"), paths["bronze"], batch_id="b1", env="dev",
                                   ingestion_ts="2024-01-01T00:00:00")
    runs.build_silver(spark, paths["bronze"], paths["root"], batch_ids=["b1"], layouts=LAYOUTS)
    runs.build_gold(spark, paths["root"], "2024-01-01 00:00:00")
    yield paths
    assert not list((base / "tables").glob("_work/*"))
    for table in [*(s.silver for s in TABLES.values()), "dim_applicant", "dim_loan_type", "dim_credit_status",
                  "fact_loan_application", "fact_bureau_credit", "fact_installment_payment", "int_credit_risk_features",
                  "mart_credit_risk_summary", "mart_card_balance_trend", "mart_pos_trend", "mart_card_balance_trend_sums", "mart_pos_trend_sums"]:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def bronze(spark, zone, source):
    return spark.read.parquet(f"{zone['bronze']}/{TABLES[source].bronze}")


def test_every_bronze_row_is_tagged_and_counted(spark, zone):
    assert bronze(spark, zone, "application_train").count() == N + 2
    for source in TABLES:
        df = bronze(spark, zone, source)
        assert set(files.AUDIT_COLUMNS) <= set(df.columns)
        assert [tuple(r) for r in df.select("batch_id", "env", "source_file").distinct().collect()] == [("b1", "dev", f"{source}.csv")]


def test_rows_are_counted_while_they_are_written(zone):
    assert zone["written"]["bronze_application_train"] == {"rows": N + 2, "missing_keys": 1, "unparsed_lines": 1}
    assert zone["written"]["bronze_bureau_balance"] == {"rows": 700, "missing_keys": 0, "unparsed_lines": 0}


def test_bronze_checks_see_the_missing_key(spark, zone):
    checks = runs.check_bronze(spark, zone["bronze"], "run1", batch_id="b1", expected_rows={"application_train": N + 2}).collect()
    failed = {(r["table_name"], r["check_name"]): r["observed"] for r in checks if not r["passed"]}
    assert failed.pop(("bronze_application_train", "missing_keys")) == 1
    assert ("bronze_application_train", "row_count") not in failed
    assert failed[("bronze_installments_payments", "repeated_keys")] == 300 - 120


def test_silver_is_at_its_grain(spark, zone):
    for r in runs.silver_manifest(spark).collect():
        assert r["row_count"] == r["key_distinct"] > 0 and r["key_nulls"] == 0


def test_quarantine_holds_the_bad_rows_masked(spark, zone):
    bad = spark.read.parquet(f"{zone['root']}/quarantine_application")
    reasons = {r["SK_ID_CURR"]: r["failed_rules"] for r in bad.collect()}
    assert reasons[None] == ["key_missing"] and reasons[7] == ["target_missing"]
    assert reasons[9999] == ["unparsed_line", "credit_not_positive"] and len(reasons) == 5
    assert not {"DAYS_BIRTH", "DAYS_EMPLOYED", files.CORRUPT} & set(bad.columns)
    assert spark.table("silver_application").count() == N - 3


def test_no_raw_or_sentinel_digest_in_silver(spark, zone):
    df = spark.table("silver_application")
    assert not {"DAYS_BIRTH", "DAYS_EMPLOYED"} & set(df.columns)
    assert df.filter(df.DAYS_EMPLOYED_MASKED == hashlib.sha256(b"365243").hexdigest()).count() == 0
    assert df.filter("DAYS_EMPLOYED_MASKED IS NULL").count() == df.filter("DAYS_EMPLOYED_IS_SENTINEL").count() == 12
    assert df.filter("DAYS_BIRTH_MASKED IS NULL").count() == 0


def test_gold_counts(spark, zone):
    assert spark.table("fact_loan_application").count() == spark.table("dim_applicant").count() == N - 3
    assert spark.table("fact_installment_payment").count() == 120
    assert spark.table("fact_bureau_credit").count() == 100
    assert spark.table("dim_loan_type").count() == 2 and spark.table("dim_credit_status").count() == 8


def test_gold_tables_have_their_fixed_columns(spark, zone):
    for table in ("dim_applicant", "dim_loan_type", "dim_credit_status", "fact_loan_application", "fact_bureau_credit",
                  "fact_installment_payment"):
        got = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        assert got == [(f.name, f.dataType) for f in schemas.gold_schema(table).fields], table


def test_layer_checks_pass_and_report_unknown_applicants(spark, zone):
    results = runs.check_silver(spark, "run1").unionByName(runs.check_gold(spark, "run1")).collect()
    failed = {(r["table_name"], r["check_name"]): r["observed"] for r in results if not r["passed"]}
    assert failed == {("fact_bureau_credit", "fact_bureau_credit_applicant"): 13, ("fact_installment_payment", "fact_installment_payment_applicant"): 2}
    names = {(r["table_name"], r["check_name"]) for r in results}
    assert {("silver_application", "credit_not_positive"), ("silver_application", "sentinel_digest_DAYS_EMPLOYED"),
            ("silver_application", "raw_DAYS_BIRTH"), ("dim_applicant", "one_current_none")} <= names


def test_marts_and_indicators_from_published_tables(spark, zone, rows):
    runs.build_marts(spark, zone["root"])
    features = spark.table("int_credit_risk_features")
    assert features.count() == N - 3 and features.filter("bureau_records > 0 AND balance_months > 0").count() > 0
    assert {r["SK_ID_CURR"]: r["application_count"] for r in features.collect()} == {
        k: sum(p % N == k for p in range(80)) for k in range(N) if k % 20 != 7}
    card = {r["MONTHS_BALANCE"]: (r["accounts"], r["total_balance"]) for r in spark.table("mart_card_balance_trend").collect()}
    latest = {(i % 50, -(i % 6)): float(i) for i in range(300)}
    assert card == {m: (sum(k[1] == m for k in latest), sum(v for k, v in latest.items() if k[1] == m)) for m in range(-5, 1)}
    pos = {r["MONTHS_BALANCE"]: (r["accounts"], r["delinquency_rate"]) for r in spark.table("mart_pos_trend").collect()}
    assert pos == {m: (card[m][0], None) for m in card}
    limits = spark.sql("SELECT * FROM VALUES ('delinquency_rate', 0.0D, 50.0D), ('default_rate:ALL', 0.0D, 100.0D), ('missing', 0.0D, 1.0D) AS t(metric, low, high)")
    assert {r["metric"]: r["breached"] for r in runs.check_thresholds(spark, limits).collect()} == {"delinquency_rate": True, "default_rate:ALL": False, "missing": True}
    got = {name: rows(df) for name, df in runs.indicators(spark).items()}
    good = [k for k in range(N) if k % 20 != 7]
    share = lambda ks: round(100.0 * sum(k % 2 for k in ks) / len(ks), 6)
    assert ("ALL", N - 3, sum(k % 2 for k in good), share(good)) in got["default_rate"]
    assert got["delinquency_rate"] == [(100, 75, 75.0)]
    assert [r[:2] for r in got["income_to_credit"]] == [("Working", N - 3)]
    assert sum(r[2] for r in got["masked_presence"]) == N - 3 - 12
    summary = {r["NAME_CONTRACT_TYPE"]: r for r in spark.table("mart_credit_risk_summary").collect()}
    assert summary["Cash"]["with_applicant"] == summary["Cash"]["applications"] == len([k for k in good if k % 3])


def test_orphans_are_reported(spark, zone):
    assert runs.check_references(spark)["silver_bureau"].count() == 13  # 3 quarantined applicants, 10 unknown ones


def test_rerun_is_idempotent(spark, zone, rows):
    def snapshot():
        return {t: rows(spark.table(t)) for t in ("silver_application", "silver_installments_payments", "dim_applicant", "fact_bureau_credit", "dim_loan_type")}

    before, manifest = snapshot(), f"{zone['root']}/_manifest"
    runs.silver_manifest(spark).write.parquet(manifest)
    runs.ingest(spark, str(zone["landing"] / "b1"), zone["bronze"], batch_id="b1", env="dev", ingestion_ts="2024-01-01T00:00:00")
    runs.build_silver(spark, zone["bronze"], zone["root"], batch_ids=["b1"], layouts=LAYOUTS)
    runs.build_gold(spark, zone["root"], "2024-01-05 00:00:00")
    assert snapshot() == before
    assert bronze(spark, zone, "bureau").count() == 100
    verdict = parity.compare_runs(spark.read.parquet(manifest), runs.silver_manifest(spark))
    assert verdict.filter("NOT passed").count() == 0 and verdict.count() == len(TABLES)


def test_second_batch_updates_inserts_and_versions(spark, zone, rows):
    earlier = spark.table("silver_application").filter("SK_ID_CURR BETWEEN 50 AND 59")
    earlier.write.parquet(f"{zone['root']}/_earlier")
    earlier = spark.read.schema(earlier.schema).parquet(f"{zone['root']}/_earlier")
    write_batch(zone["landing"] / "b2", children=lambda k: 9, applicants=range(50, 70))
    runs.ingest(spark, str(zone["landing"] / "b2"), zone["bronze"], batch_id="b2", env="dev", ingestion_ts="2024-02-01T00:00:00")
    runs.build_silver(spark, zone["bronze"], zone["root"], batch_ids=["b2"], layouts=LAYOUTS)
    runs.build_gold(spark, zone["root"], "2024-02-01 00:00:00", batch_ids=["b2"], layouts=LAYOUTS, bronze_root=zone["bronze"])
    dim = spark.table("dim_applicant")
    # applicant 67 has no target, so 9 of 10 new ones arrive; 47 was already quarantined
    assert spark.table("silver_application").count() == N - 3 + 9
    assert dim.filter("is_current").count() == N - 3 + 9 and dim.filter("NOT is_current").count() == 10
    assert {r[0] for r in dim.filter("NOT is_current").select("applicant_id").collect()} == set(range(50, 60))
    # gold built from the batch alone equals gold reloaded from all of silver
    facts = ("fact_loan_application", "fact_bureau_credit", "fact_installment_payment", "dim_applicant", "dim_loan_type")
    incremental = {t: rows(spark.table(t)) for t in facts}
    runs.build_gold(spark, zone["root"], "2024-02-02 00:00:00")
    assert {t: rows(spark.table(t)) for t in facts} == incremental
    # and a sliced dimension holds the same versions
    spark.sql("DROP TABLE dim_applicant")
    for as_of, batch in (("2024-01-01 00:00:00", ["b1"]), ("2024-02-01 00:00:00", ["b2"])):
        if batch == ["b1"]:
            first = spark.table("silver_application").filter("batch_id = 'b1'").unionByName(earlier)
            attributes = gold.int_applicant_attributes(gold.stg_application(first))
            sinks.publish_dimension_sliced(spark, "dim_applicant", attributes, as_of, zone["root"])
        else:
            runs.build_gold(spark, zone["root"], as_of, batch_ids=batch, sliced=True)
    columns = [f.name for f in schemas.gold_schema("dim_applicant").fields]
    assert rows(spark.table("dim_applicant"), *columns) == incremental["dim_applicant"]
    assert runs.check_gold(spark, "run3").filter("NOT passed AND severity = 'CRITICAL'").count() == 0
    # replaying the first batch does not bring its older rows back
    runs.build_silver(spark, zone["bronze"], zone["root"], batch_ids=["b1"], layouts=LAYOUTS)
    assert spark.table("silver_application").filter("SK_ID_CURR = 55 AND CNT_CHILDREN = 9").count() == 1
    # nor does a full rebuild from all batches differ
    before = spark.table("silver_application")
    runs.build_silver(spark, zone["bronze"], zone["root"], tables=["application_train"], layouts=LAYOUTS)
    assert parity.row_hash_diff(before, spark.table("silver_application"), ["SK_ID_CURR"]).count() == 0


def test_replay_needs_landing_as_recorded_and_restores_the_batch(spark, zone, tmp_path, rows):
    place, store, target = zone["landing"] / "b1", str(tmp_path / "manifest"), str(tmp_path / "bronze")
    found = landing.landing_manifest(spark, str(place))
    landing.record_landing(found, batch_id="b1", env="dev", ingestion_ts="2024-01-01T05:06:07.000008+01:00").write.parquet(store)
    recorded = spark.read.parquet(store)
    runs.replay(spark, str(place), target, recorded, batch_id="b1", tables=["bureau"])
    once = spark.read.parquet(f"{target}/bronze_bureau")
    assert [str(r[0]) for r in once.select(F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).distinct().collect()] == ["2024-01-01 04:06:07.000008"]
    before = rows(once)
    runs.replay(spark, str(place), target, recorded, batch_id="b1", tables=["bureau"])
    assert rows(spark.read.parquet(f"{target}/bronze_bureau")) == before
    with pytest.raises(q.GateFailure, match="landing_unchanged"):
        runs.replay(spark, str(zone["landing"]), target, recorded, batch_id="b1", tables=["bureau"])
    with pytest.raises(q.GateFailure):
        runs.replay(spark, str(place), target, recorded, batch_id="unknown", tables=["bureau"])


def test_drifting_batch_is_refused_before_bronze(spark, zone):
    write_batch(zone["landing"] / "b3")
    path = zone["landing"] / "b3" / "bureau.csv"
    path.write_text("\n".join(line + (",EXTRA" if i == 0 else ",1") for i, line in enumerate(path.read_text().splitlines())))
    with pytest.raises(ValueError, match="EXTRA"):
        runs.ingest(spark, str(zone["landing"] / "b3"), zone["bronze"], batch_id="b3", env="dev", ingestion_ts="2024-03-01T00:00:00", tables=["bureau"])
    assert bronze(spark, zone, "bureau").filter("batch_id = 'b3'").count() == 0


def test_results_are_recorded_once_per_run(spark, zone):
    path = f"{zone['root']}/dq_results"
    for _ in range(2):
        runs.record_results(runs.check_bronze(spark, zone["bronze"], "run1", batch_id="b1"), path)
    runs.record_results(runs.check_bronze(spark, zone["bronze"], "run2", batch_id="b1", tables=["bureau"]), path)
    stored = spark.read.parquet(path)
    assert stored.filter("run_id = 'run1'").count() == 3 * len(TABLES) and stored.filter("run_id = 'run2'").count() == 3


def test_a_snapshot_keeps_one_month(spark, zone, name):
    """Built beside the table of all months, which is put back."""
    everything = spark.table("silver_bureau_balance").count()
    spark.sql(f"ALTER TABLE silver_bureau_balance RENAME TO {name}")
    try:
        runs.build_silver(spark, zone["bronze"], f"{zone['root']}_snapshot", batch_ids=["b1"], tables=["bureau_balance"], snapshots={"bureau_balance": -2})
        found = spark.table("silver_bureau_balance")
        assert {r[0] for r in found.select("MONTHS_BALANCE").distinct().collect()} == {-2} and 0 < found.count() < everything
        assert found.count() == len({b % 100 for b in range(700) if b % 7 == 2})
    finally:
        spark.sql("DROP TABLE IF EXISTS silver_bureau_balance")
        spark.sql(f"ALTER TABLE {name} RENAME TO silver_bureau_balance")


def test_gold_gate_stops_a_fact_with_repeated_grain(spark, zone):
    good = spark.table("fact_loan_application")
    n = good.count()
    with pytest.raises(q.GateFailure, match="51012"):
        sinks.publish(spark, "fact_loan_application", good.unionByName(good.limit(1)), zone["root"],
                      gates=lambda staged: q.fact_gates(staged, "fact_loan_application", gold.LOAN_GRAIN, q.LOAN_GRAIN))
    assert spark.table("fact_loan_application").count() == n
