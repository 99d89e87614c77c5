import pytest
from pyspark.sql import functions as F

from sedimenta.operators import parity, reconcile


def pair(spark, n=3_000, changed=40, missing=15, extra=10):
    left = spark.range(n).selectExpr("id AS k", "CAST(id % 7 AS STRING) AS a", "IF(id % 5 = 0, NULL, id * 1.5D) AS b")
    right = left.withColumn("a", F.expr(f"IF(k < {changed}, NULL, a)")).filter(f"k < {n - missing}")
    return left, right.unionByName(spark.range(n, n + extra).selectExpr("id AS k", "'new' AS a", "CAST(NULL AS DOUBLE) AS b"))


def test_equals_the_exact_comparison(spark, rows):
    left, right = pair(spark)
    want = rows(parity.row_hash_diff(left, right, ["k"]))
    assert len(want) == 40 * 2 + 15 + 10
    assert rows(reconcile.row_hash_diff(left, right, ["k"], cells=3 * 128)) == want
    assert rows(reconcile.row_hash_diff(left, right, cells=3 * 128)) == rows(parity.row_hash_diff(left, right))
    assert rows(reconcile.row_hash_diff(left, right, ["k"], ["b"], cells=3 * 128)) == rows(parity.row_hash_diff(left, right, ["k"], ["b"]))


def test_repeated_rows_count(spark, rows):
    left = spark.createDataFrame([(1, "x")] * 5 + [(2, "y")] * 3 + [(3, None)] * 2 + [(None, "z")], "k long, v string")
    right = spark.createDataFrame([(1, "x")] * 2 + [(2, "y")] * 3 + [(3, None)] * 9, "k long, v string")
    got = rows(reconcile.row_hash_diff(left, right, ["k"], cells=3 * 16))
    assert got == rows(parity.row_hash_diff(left, right, ["k"]))
    assert sorted(r[2:] for r in got) == [(1, 0), (2, 9), (5, 2)]


def test_equal_and_empty_tables(spark):
    left, right = pair(spark)
    none = left.filter("false")
    assert reconcile.row_hash_diff(left, left, ["k"]).count() == 0
    assert reconcile.row_hash_diff(none, none, ["k"]).count() == 0
    assert reconcile.row_hash_diff(none, right.limit(20), ["k"], cells=3 * 64).count() == 20


def test_too_many_differences_fall_back_to_whole_tables(spark, rows):
    left, right = pair(spark, n=500, changed=300)
    _, whole = reconcile.peeled(reconcile.subtracted(*(reconcile.sketch(x, ["k", "a", "b"], 3 * 16) for x in (left, right))), 3 * 16)
    assert not whole
    assert rows(reconcile.row_hash_diff(left, right, ["k"], cells=3 * 16)) == rows(parity.row_hash_diff(left, right, ["k"]))
    with pytest.raises(ValueError, match="multiple"):
        reconcile.row_hash_diff(left, right, cells=10)


def test_cells_are_all_that_is_shuffled(spark):
    """The sketch sends a row per task and cell, and what it holds does not grow with equal rows."""
    left, right = pair(spark, n=20_000)
    cells = reconcile.subtracted(reconcile.sketch(left, left.columns, 3 * 128), reconcile.sketch(right, left.columns, 3 * 128))
    assert 0 < cells.count() <= 105 * 3
    found, whole = reconcile.peeled(cells, 3 * 128)
    assert whole and found.count() == 105 and found.filter("n = 1").count() == 55
    plan = reconcile.sketch(left, left.columns)._jdf.queryExecution().executedPlan().toString()
    assert "keys=[cell" in plan and plan.count("Exchange") == 1 and "partial_sum" in plan


def test_distinct_hashes_of_nulls_and_separators(spark):
    rows_ = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("", "a"), (None, None)]
    df = spark.createDataFrame(rows_, "x string, y string")
    assert reconcile.row_hashes(df, ["x", "y"]).select("_high", "_low").distinct().count() == len(rows_)
