import hashlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import columns as fn


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_mask_matches_hashlib_for_integers_and_text(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (-9000, 'School'), (0, ''), (NULL, NULL) AS t(n, s)")
    got = rows(df.select(fn.sha256_text("n"), fn.sha256_text("s")))
    assert sorted(got, key=repr) == sorted([(sha("-9000"), sha("School")), (sha("0"), sha("")), (None, None)], key=repr)


def test_typed_never_raises(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('1'), ('x'), (NULL) AS t(v)")
    assert rows(df.select(fn.typed("v", "int"), fn.cast_failed("v", "int"))) == sorted(
        [(1, False), (None, True), (None, False)], key=repr
    )


def test_surrogate_keys(spark):
    row = spark.sql("SELECT 7L AS a, CAST(NULL AS BIGINT) AS b").select(
        fn.surrogate_key("a"), fn.surrogate_key("b"), fn.surrogate_key("a", "b")
    ).first()
    assert tuple(row) == (sha("7"), sha("-1"), sha("7|-1"))


def test_version_key_depends_on_key_and_instant_only(spark):
    key = spark.sql("SELECT 7L AS a").select(fn.version_key("a", fn.instant("2024-02-01 00:00:00"))).first()[0]
    assert key == sha("7|2024-02-01T00:00:00.000000")


def test_instant_takes_aware_times_in_utc(spark):
    aware = datetime(2024, 2, 1, 2, tzinfo=timezone(timedelta(hours=2)))
    assert spark.range(1).select(fn.instant(aware)).first()[0] == datetime(2024, 2, 1)


@pytest.mark.parametrize(
    ("a", "b", "changed"),
    [("1", "1", False), ("1", "2", True), ("1", "NULL", True), ("NULL", "1", True), ("NULL", "NULL", False)],
)
def test_change_predicate_is_total(spark, a, b, changed):
    left = spark.sql(f"SELECT 1 AS id, CAST({a} AS INT) AS x").alias("l")
    right = spark.sql(f"SELECT 1 AS id, CAST({b} AS INT) AS x").alias("r")
    assert left.join(right, F.col("l.id") == F.col("r.id")).select(fn.any_changed("l", "r", ["x"])).first()[0] is changed


def test_row_digest_tells_nulls_and_separators_apart(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('1', NULL, 'a'), ('1', 'a', NULL), ('a|b', 'c', NULL), ('a', 'b|c', NULL),"
        " ('N', NULL, NULL), (NULL, 'N', NULL) AS t(x, y, z)"
    )
    assert df.select(fn.row_digest(["x", "y", "z"]).alias("d")).distinct().count() == 6
