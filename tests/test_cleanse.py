import hashlib
import random

import pytest

from sedimenta.operators import cleanse
from sedimenta.plans import silver
from sedimenta.sources.registry import TABLES


def sha(value):
    return hashlib.sha256(str(value).encode()).hexdigest()


def test_latest_wins(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, '2026-01-01', 'old'), (1, '2026-01-02', 'new'), (2, NULL, 'x') AS t(k, ingestion_ts, v)")
    assert rows(cleanse.latest_per_key(df, ["k"]), "k", "v") == [(1, "new"), (2, "x")]


def test_ties_are_reproducible_under_any_arrival_order(spark, rows):
    rng = random.Random(7)
    data = [(k, 1, rng.randint(0, 9), rng.choice("abc")) for k in range(40) for _ in range(6)]
    results = []
    for _ in range(3):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, ingestion_ts int, v int, w string").repartition(rng.randint(1, 7))
        results.append(rows(cleanse.latest_per_key(df, ["k"])))
    assert results[0] == results[1] == results[2]
    expected = {}
    for k, ts, v, w in data:
        expected[k] = max(expected.get(k, (ts, v, w)), (ts, v, w))
    assert results[0] == sorted(((k, *rest) for k, rest in expected.items()), key=repr)


def test_latest_is_idempotent(spark, rows):
    df = spark.range(200).selectExpr("id % 17 AS k", "id % 5 AS ingestion_ts", "id AS v")
    once = cleanse.latest_per_key(df, ["k"])
    assert rows(once) == rows(cleanse.latest_per_key(once, ["k"]))


def test_sentinel_is_nulled_before_hashing(spark):
    df = spark.sql("SELECT * FROM VALUES (1, -9000, 365243, 'XNA'), (2, -8000, -500, 'School') AS t(k, DAYS_BIRTH, DAYS_EMPLOYED, ORGANIZATION_TYPE)")
    out = cleanse.mask_columns(df, ["DAYS_BIRTH", "DAYS_EMPLOYED"], {"DAYS_EMPLOYED": 365243, "ORGANIZATION_TYPE": "XNA"},
                               flag_suffix="_F")
    got = {r["k"]: r for r in out.collect()}
    assert got[1]["DAYS_EMPLOYED_MASKED"] is None and got[1]["ORGANIZATION_TYPE"] is None
    assert got[1]["DAYS_EMPLOYED_F"] is True and got[2]["DAYS_EMPLOYED_F"] is False
    assert got[2]["DAYS_EMPLOYED_MASKED"] == sha(-500) and got[2]["DAYS_BIRTH_MASKED"] == sha(-8000)
    assert sha(365243) not in {r["DAYS_EMPLOYED_MASKED"] for r in got.values()}
    assert not {"DAYS_BIRTH", "DAYS_EMPLOYED"} & set(out.columns)


def test_raw_columns_can_be_kept_but_then_without_sentinel(spark, rows):
    df = spark.sql("SELECT 1 AS k, 365243 AS DAYS_EMPLOYED")
    out = cleanse.mask_columns(df, ["DAYS_EMPLOYED"], {"DAYS_EMPLOYED": 365243}, drop_raw=False)
    assert rows(out, "DAYS_EMPLOYED", "DAYS_EMPLOYED_MASKED") == [(None, None)]


def test_floating_point_is_not_masked(spark):
    with pytest.raises(TypeError, match="DAYS_BIRTH"):
        cleanse.mask_columns(spark.sql("SELECT 1.5D AS DAYS_BIRTH"), ["DAYS_BIRTH"])


def test_null_keys_are_split_off(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, 1), (NULL, 1), (1, NULL) AS t(a, b)")
    complete, missing = cleanse.split_null_keys(df, ["a", "b"])
    assert rows(complete) == [(1, 1)] and missing.count() == 2


def test_silver_application_end_to_end(spark):
    spec = TABLES["application_train"]
    df = spark.sql(
        """SELECT * FROM VALUES
        (100001L, -9000, 365243, 'XNA', 100000.0D, 1, '0', timestamp'2026-01-01 00:00:00'),
        (100001L, -9000, -500, 'School', 200000.0D, 1, '0', timestamp'2026-01-02 00:00:00'),
        (100002L, -9100, 365243, 'XNA', 0.0D, 1, '0', timestamp'2026-01-01 00:00:00'),
        (100003L, -9200, -100, 'Bank', 1.0D, NULL, 'two', timestamp'2026-01-01 00:00:00'),
        (NULL, -9300, -100, 'Bank', 1.0D, 1, '0', timestamp'2026-01-01 00:00:00')
        AS t(SK_ID_CURR, DAYS_BIRTH, DAYS_EMPLOYED, ORGANIZATION_TYPE, AMT_CREDIT, TARGET, CNT_CHILDREN, ingestion_ts)"""
    )
    out = {r["SK_ID_CURR"]: r for r in silver.prepare(silver.keyed(df, spec), spec).collect()}
    assert set(out) == {100001, 100002, 100003}
    assert out[100001]["AMT_CREDIT"] == 200000.0 and out[100001]["failed_rules"] == []
    assert out[100001]["DAYS_EMPLOYED_MASKED"] == sha(-500) and out[100001]["is_current"] is True
    assert out[100002]["failed_rules"] == ["credit_not_positive"] and out[100002]["DAYS_EMPLOYED_MASKED"] is None
    assert out[100003]["failed_rules"] == ["bad_CNT_CHILDREN", "target_missing"]
    lost = silver.keyless(df, spec).collect()
    assert [r["failed_rules"] for r in lost] == [["key_missing"]] and "DAYS_BIRTH" not in lost[0].asDict()


@pytest.mark.parametrize("source", sorted(TABLES))
def test_every_table_ends_at_its_grain(spark, source):
    spec = TABLES[source]
    keys = ", ".join(f"CAST(id % {7 + i} AS BIGINT) AS {k}" for i, k in enumerate(spec.keys))
    extra = {**spec.casts, **dict.fromkeys(spec.masked, "int")}
    rest = [f"CAST(CAST(id AS STRING) AS {t}) AS {c}" for c, t in extra.items() if c not in spec.keys]
    df = spark.range(300).selectExpr(keys.split(", ")[0], *keys.split(", ")[1:], *rest, "timestamp_seconds(id) AS ingestion_ts")
    out = silver.clean(df, spec)
    assert out.count() == out.select(*spec.keys).distinct().count() == df.select(*spec.keys).distinct().count()
