import json

from sedimenta.operators import parity
from sedimenta.sources import sinks


def entry(spark, name, n, distinct, nulls):
    return spark.sql(
        f"SELECT '{name}' AS table_name, {n}L AS row_count, CAST({distinct} AS BIGINT) AS key_distinct,"
        f" CAST({nulls} AS BIGINT) AS key_nulls, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS max_ts"
    )


def failures(checks):
    return {(r["table_name"], r["tier"]) for r in checks.filter("NOT passed").collect()}


def test_manifest_counts_composite_keys(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1), (1, 1), (1, 2), (NULL, 1) AS t(a, b)")
    r = parity.manifest("t", df, ["a", "b"]).first()
    assert (r["row_count"], r["key_distinct"], r["key_nulls"], r["max_ts"]) == (4, 2, 1, None)


def test_every_tier_fails_where_it_should(spark):
    baseline = entry(spark, "same", 5, 5, 0).union(entry(spark, "fewer", 5, 5, 0)).union(entry(spark, "gone", 1, 1, 0))
    rebuilt = (
        entry(spark, "same", 5, 4, 1).union(entry(spark, "fewer", 4, 4, 0)).union(entry(spark, "added", 1, 1, 0))
    )
    checks = parity.compare_manifests(baseline, rebuilt, {"fewer": 7, "added": 1})
    assert failures(checks) == {("same", "T2"), ("same", "T3"), ("fewer", "T1"), ("fewer", "T5"), ("gone", "T0"), ("added", "T0")}
    assert failures(parity.compare_manifests(baseline, baseline)) == set()


def test_baseline_without_key_counts_still_judges_the_rebuild(spark):
    baseline, rebuilt = entry(spark, "t", 5, "NULL", "NULL"), entry(spark, "t", 5, 4, 0)
    assert failures(parity.compare_manifests(baseline, rebuilt)) == {("t", "T2")}
    assert failures(parity.compare_manifests(rebuilt, baseline)) == set()


def test_idempotency_verdict(spark):
    one = entry(spark, "a", 5, 5, 0).union(entry(spark, "b", 5, 5, 0)).union(entry(spark, "c", 1, 1, 0))
    two = entry(spark, "a", 5, 5, 0).union(entry(spark, "b", 6, 5, 0))
    got = {r["table_name"]: (r["row_delta"], r["passed"]) for r in parity.compare_runs(one, two).collect()}
    assert got == {"a": (0, True), "b": (1, False), "c": (-1, False)}


def test_row_hash_diff_is_a_multiset_comparison(spark, rows):
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'a'), (2, NULL), (3, 'c') AS t(k, v)")
    right = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL), (3, 'C') AS t(k, v)")
    got = rows(parity.row_hash_diff(left, right, ["k"]), "k", "n_left", "n_right")
    assert got == [(1, 2, 1), (3, 0, 1), (3, 1, 0)]
    assert parity.row_hash_diff(left, left.repartition(3)).count() == 0


def test_screened_diff_equals_the_plain_one(spark, rows):
    left = spark.range(5000).selectExpr("id % 900 AS k", "id % 7 AS v", "IF(id % 11 = 0, NULL, 'x') AS w")
    right = left.filter("NOT (k = 5 AND v = 3)").unionByName(spark.sql("SELECT 899L AS k, 6L AS v, 'new' AS w"))
    plain = rows(parity.row_hash_diff(left, right, ["k"], screen=None))
    assert plain and rows(parity.row_hash_diff(left, right, ["k"], screen=64)) == plain
    assert parity.row_hash_diff(left, left.repartition(3), ["k"], screen=64).count() == 0
    assert rows(parity.row_hash_diff(left, right, screen=8)) == rows(parity.row_hash_diff(left, right, screen=None))


def test_manifest_round_trips_through_json(spark, tmp_path, rows):
    keys = {"a": ["x"], "b": ["x", "y"]}
    manifest = entry(spark, "a", 5, 5, 0).union(entry(spark, "b", 7, 6, 1))
    path = str(tmp_path / "manifest")
    sinks.write_json(parity.manifest_document(manifest, "test", "2024-01-01", keys), path)
    [part] = [p for p in (tmp_path / "manifest").iterdir() if p.name.startswith("part-")]
    document = json.loads(part.read_text())
    assert document["tables"]["b"] == {"row_count": 7, "pk": "x+y", "pk_distinct": 6, "pk_nulls": 1}
    back = parity.read_manifest_json(spark, path)
    assert rows(back.drop("max_ts")) == rows(manifest.drop("max_ts"))
    assert failures(parity.compare_manifests(back, manifest)) == {("b", "T2"), ("b", "T3")}
