import pytest
from pyspark.sql import functions as F

from sedimenta.operators import cleanse, scd2
from sedimenta.operators import quality as q


def test_each_gate_raises_on_injected_errors(spark):
    dim = spark.sql(
        "SELECT * FROM VALUES (1L, TRUE), (2L, TRUE), (2L, TRUE), (3L, FALSE) AS t(applicant_id, is_current)"
    )
    src = spark.sql("SELECT * FROM VALUES (1L), (2L), (3L), (4L) AS t(applicant_id)")
    with pytest.raises(q.GateFailure) as too_many:
        q.enforce([q.Gate("too_many", q.multiple_current(dim), code=q.MULTIPLE_CURRENT)])
    assert too_many.value.failures == {"too_many": 1} and too_many.value.codes == [51001]
    with pytest.raises(q.GateFailure) as none:
        q.enforce([q.Gate("none", q.no_current(dim, src), code=q.NO_CURRENT)])
    assert none.value.failures == {"none": 2} and none.value.codes == [51002]
    fact = spark.sql("SELECT * FROM VALUES (1L), (1L), (NULL) AS t(SK_ID_CURR)")
    with pytest.raises(q.GateFailure) as grain:
        q.enforce(q.fact_gates(fact, "fact", ["SK_ID_CURR"], q.LOAN_GRAIN))
    assert grain.value.failures == {"fact_grain": 1, "fact_key_not_null": 1} and grain.value.codes == [51012]


def test_advisory_gates_only_count(spark):
    fact = spark.sql("SELECT * FROM VALUES (1L), (1L) AS t(k)")
    assert q.enforce([q.Gate("advisory", q.duplicate_keys(fact, ["k"]), severity="HIGH")]) == {"advisory": 1}
    assert q.enforce([]) == {}


def test_quarantine_is_a_partition_of_its_input(spark, rows):
    df = spark.range(500).selectExpr("id", "CASE WHEN id % 7 = 0 THEN NULL ELSE id % 3 END AS TARGET", "CAST(id % 11 AS DOUBLE) AS AMT")
    rules = {"target_missing": "TARGET IS NULL", "target_domain": "TARGET NOT IN (0, 1)", "amt": "AMT IS NULL OR AMT <= 0"}
    good, bad = q.split_quarantine(df, rules)
    assert rows(good.unionByName(bad.drop("failed_rules"))) == rows(df)
    assert good.filter("TARGET IS NULL OR TARGET NOT IN (0, 1) OR AMT <= 0").count() == 0
    assert bad.filter("size(failed_rules) = 0").count() == 0
    assert {tuple(r["failed_rules"]) for r in bad.filter("id = 77").collect()} == {("target_missing", "amt")}


def test_orphans_count_child_rows_and_skip_nulls(spark, rows):
    child = spark.sql("SELECT * FROM VALUES (1), (9), (9), (NULL) AS t(fk)")
    parent = spark.sql("SELECT * FROM VALUES (1), (1), (2) AS t(pk)")
    assert rows(q.orphans(child, "fk", parent, "pk")) == [(9, 2)]


def test_bronze_checks(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, 'x'), (1, 1, 'y'), (1, 2, NULL), (NULL, 1, 'x'), (1, NULL, 'x') AS t(a, b, ingestion_ts)")
    got = {r["check_name"]: (r["observed"], r["passed"]) for r in q.bronze_checks(df, ["a", "b"], expected_rows=5).collect()}
    assert got == {"missing_timestamps": (1, False), "missing_keys": (2, False), "repeated_keys": (1, False), "row_count": (5, True)}


def test_mask_checks_catch_hashing_before_nulling(spark):
    raw = spark.sql("SELECT * FROM VALUES (1, 365243), (2, -500), (3, CAST(NULL AS INT)) AS t(k, DAYS_EMPLOYED)")
    right = cleanse.mask_columns(raw, ["DAYS_EMPLOYED"], {"DAYS_EMPLOYED": 365243})
    wrong = raw.withColumn("DAYS_EMPLOYED_MASKED", F.sha2(F.col("DAYS_EMPLOYED").cast("string"), 256))
    unmasked = raw.withColumn("DAYS_EMPLOYED_MASKED", F.col("DAYS_EMPLOYED").cast("string"))

    def failed(masked):
        checks = q.mask_checks(raw, masked, ["k"], "DAYS_EMPLOYED", 365243)
        return {r["check_name"] for r in checks.filter("NOT passed").collect()}

    assert failed(right) == set()
    assert failed(wrong) == {"sentinels_in_minus_nulled_out", "digest_mismatches", "sentinel_digests", "raw_column_present"}
    assert "masked_equals_original" in failed(unmasked)


def test_sentinel_leak_gate(spark):
    df = spark.sql("SELECT sha2('365243', 256) AS DAYS_EMPLOYED_MASKED UNION ALL SELECT sha2('-5', 256) UNION ALL SELECT NULL")
    assert q.sentinel_leaks(df, {"DAYS_EMPLOYED": 365243, "ORGANIZATION_TYPE": "XNA"}).count() == 1


def test_profile_sketch_agrees_with_exact(spark, rows):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN NULL ELSE id % 5 END AS v")
    sketch, exact = q.profile(df), q.profile(df, exact=True)
    counted = ["column_name", "row_count", "null_count", "null_rate", "completeness"]
    assert rows(sketch, *counted) == rows(exact, *counted)
    for (_, a), (_, b) in zip(rows(sketch, "column_name", "distinct_values"), rows(exact, "column_name", "distinct_values")):
        assert abs(a - b) <= 0.1 * b


def test_profile_of_an_empty_table(spark):
    r = q.profile(spark.range(0)).first()
    assert (r["row_count"], r["null_rate"]) == (0, None)


def test_threshold_bounds_are_inclusive_and_open_ended(spark):
    metrics = spark.sql("SELECT * FROM VALUES ('a', 1.0D), ('b', 2.0D), ('c', 9.0D), ('d', NULL) AS t(metric, value)")
    bounds = spark.sql("SELECT * FROM VALUES ('a', 1.0D, 1.0D), ('b', NULL, 1.5D), ('c', 3.0D, NULL), ('d', 0.0D, 1.0D) AS t(metric, low, high)")
    got = {r["metric"]: r["breached"] for r in q.threshold_breaches(metrics, bounds).collect()}
    assert got == {"a": False, "b": True, "c": False, "d": True}


def test_gate_on_a_broken_dimension(spark):
    dim = scd2.first_versions(
        spark.sql("SELECT 1L AS applicant_id, 1L AS SK_ID_CURR, 'a' AS name_income_type, 'b' AS name_education_type, 'c' AS name_family_status, 1 AS cnt_children"),
        "2024-01-01 00:00:00",
    )
    with pytest.raises(q.GateFailure, match="intervals"):
        q.enforce([q.Gate("intervals", scd2.interval_violations(dim.unionByName(dim)))])
