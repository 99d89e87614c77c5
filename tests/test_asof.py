"""Sorted as-of join, orphans by bitmaps and exact shares, against plain definitions."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import asof, keysets, scd2
from sedimenta.operators import quality as q
from sedimenta.sources import files

ATTRIBUTES = ["applicant_sk", "cnt_children"]


def history(spark, entities=20, hot=400):
    """Versions of some entities; entity 3 has a very long history, entity 4 a gap at its end, 5 none."""
    rows = spark.range(entities).filter("id <> 5").selectExpr("id AS applicant_id", "explode(sequence(0, IF(id = 3, %d, id %% 4))) AS n" % hot)
    start = "timestamp_ntz'2024-01-01' + make_dt_interval(0, n)"
    return rows.selectExpr(
        "concat(applicant_id, '-', n) AS applicant_sk", "applicant_id", "applicant_id AS SK_ID_CURR", "'a' AS name_income_type", "'b' AS name_education_type",
        "'c' AS name_family_status", "IF(n % 3 = 0, NULL, CAST(n AS INT)) AS cnt_children", f"{start} AS start_date",
        f"IF(n < IF(applicant_id = 3, {hot}, applicant_id % 4), {start} + make_dt_interval(0, 1), IF(applicant_id = 4, {start} + make_dt_interval(0, 5), NULL)) AS end_date",
        f"n = IF(applicant_id = 3, {hot}, applicant_id % 4) AND applicant_id <> 4 AS is_current")


def facts(spark, n=3_000):
    return spark.range(n).selectExpr(
        "id", "IF(id % 3 = 0, 3, IF(id % 50 = 7, NULL, id % 22)) AS applicant_id",
        "IF(id % 97 = 0, NULL, timestamp_ntz'2023-12-31' + make_dt_interval(0, CAST(id % 450 AS INT), CAST(id % 60 AS INT))) AS applied_at")


@pytest.mark.parametrize("partitions", ["1", "2", "40"])
def test_sorted_join_equals_the_range_join(spark, rows, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dim, fact = history(spark), facts(spark)
        for how in ("left", "inner"):
            want = scd2.join_as_of(fact, dim, "applied_at", ATTRIBUTES, how=how)
            got = asof.join_as_of(fact, dim, "applied_at", ATTRIBUTES, how=how)
            assert got.columns == want.columns and rows(got) == rows(want)
        assert got.filter("cnt_children IS NOT NULL").count() > 500
        assert asof.join_as_of(fact.filter("false"), dim, "applied_at", ATTRIBUTES).count() == 0
        alone = asof.join_as_of(fact, dim.filter("false"), "applied_at", ATTRIBUTES)
        assert alone.count() == 3_000 and alone.filter("applicant_sk IS NOT NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_history_and_hot_facts_are_split(spark):
    """100,000 versions of one entity: many tasks hold a part of them, and no condition on times is left in a join."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dim = history(spark, entities=4, hot=100_000).filter("applicant_id = 3")
        fact = spark.range(20_000).selectExpr("id", "3L AS applicant_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id * 5 AS INT), 0, 1) AS applied_at")
        joined = asof.join_as_of(fact, dim, "applied_at", ATTRIBUTES)
        assert joined.filter("applicant_sk = concat('3-', id * 5)").count() == 20_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
        sizes = joined.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 8_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bad_kind_of_join_is_refused(spark):
    with pytest.raises(ValueError, match="left or inner"):
        asof.join_as_of(facts(spark), history(spark), "applied_at", ATTRIBUTES, how="full")


@pytest.mark.parametrize(("shift", "kind"), [(0, "bigint"), (-40_000, "int"), (2**53 + 5, "bigint"), (-(2**62), "bigint")])
def test_orphans_by_blocks_equal_the_key_join(spark, rows, shift, kind):
    child = spark.range(30_000).selectExpr(f"CAST(IF(id % 11 = 0, NULL, id DIV 3 + {shift}) AS {kind}) AS k")
    parent = spark.range(9_990).filter("id % 100 <> 17").selectExpr(f"id + {shift} AS p")
    assert keysets.dense(child, "k")
    want = rows(q.orphans(child, "k", parent, "p"))
    assert len(want) > 90 and rows(keysets.orphans_by_blocks(child, "k", parent, "p")) == want
    assert rows(keysets.orphans_by_blocks(child, "k", parent.filter("false"), "p")) == rows(q.orphans(child, "k", parent.filter("false"), "p"))
    assert keysets.orphans_by_blocks(child, "k", child, "k").count() == 0
    assert keysets.orphans_by_blocks(child.filter("false"), "k", parent, "p").count() == 0


def test_scattered_and_other_keys_are_compared_one_by_one(spark, rows):
    child = spark.range(500).selectExpr("xxhash64(id) AS k", "CAST(id AS STRING) AS s")
    parent = child.limit(300)
    for key in ("k", "s"):
        assert not keysets.dense(child, key)
        assert rows(keysets.orphans_by_blocks(child, key, parent, key)) == rows(q.orphans(child, key, parent, key))


def test_bitmaps_are_all_that_is_shuffled(spark):
    child = spark.range(400_000).selectExpr("id % 100000 AS k")
    plan = keysets.blocks(child, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan
    assert keysets.blocks(child, "k").count() == -(-100_000 // keysets.BLOCK)


def test_exact_shares(spark):
    strata = [None, "a", "b", "c"]
    df = spark.createDataFrame([(i, strata[min(3, i % 7)], i % 5) for i in range(5_000)] + [(None, "a", 1)] * 3, "k long, s string, v int")
    data = [tuple(r) for r in df.collect()]
    sizes = Counter(r[1] for r in data)

    def ticket(r):
        return hashlib.md5(("42" if r[0] is None else f"42|{r[0]}").encode()).hexdigest()

    for share in (0.0, 0.013, 0.5, 1.0, {"a": 0.25, None: 0.1}):
        got = [tuple(r) for r in files.stratified_sample_exact(df.repartition(5), "k", "s", share).collect()]
        wanted = {s: int((share.get(s, 0.0) if isinstance(share, dict) else share) * n + 0.5) for s, n in sizes.items()}
        assert Counter(r[1] for r in got) == Counter({s: n for s, n in wanted.items() if n})
        for s, n in wanted.items():
            assert sorted(ticket(r) for r in got if r[1] == s) == sorted(ticket(r) for r in data if r[1] == s)[:n]
    assert files.stratified_sample_exact(df.filter("false"), "k", "s", 0.5).count() == 0
