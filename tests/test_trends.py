"""Trends kept up to date from changes equal trends made anew."""

import random

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import upsert
from sedimenta.plans import kpis, runs
from sedimenta.sources import sinks

KEYS = ["SK_ID_PREV", "MONTHS_BALANCE"]
SCHEMA = "SK_ID_PREV long, MONTHS_BALANCE int, AMT_BALANCE double, SK_DPD int, ingestion_ts long"


def batch(seed, n=60):
    draw = random.Random(seed)
    keys = draw.sample([(k, -m) for k in range(25) for m in range(8)], n)
    return [(k, m, draw.choice([None, draw.randrange(10_000) / 100]), draw.choice([None, 0, 0, 5]), seed % 4) for k, m in keys]


def test_ten_batches_of_changes_equal_a_rebuild(spark, rows):
    stored = spark.createDataFrame(batch(0), SCHEMA)
    sums = kpis.trend_sums(stored)
    for seed in range(1, 11):
        arrived = spark.createDataFrame(batch(seed), SCHEMA)
        accepted = upsert.accepted_updates(stored, arrived, KEYS, ["ingestion_ts"])
        changes = upsert.signed_changes(stored, accepted, KEYS, ["MONTHS_BALANCE", "AMT_BALANCE", "SK_DPD"])
        sums = kpis.changed_sums(sums, kpis.trend_sums(changes, F.col("sign")))
        after = upsert.upsert_latest(stored, arrived, KEYS, ["ingestion_ts"])
        stored, sums = (spark.createDataFrame(x.collect(), x.schema) for x in (after, sums))
    assert rows(sums) == rows(kpis.trend_sums(stored))
    assert rows(kpis.balance_trend_of(sums)) == rows(kpis.balance_trend(stored))
    assert rows(kpis.pos_trend_of(sums)) == rows(kpis.pos_trend(stored))
    narrow = stored.drop("SK_DPD")
    assert rows(kpis.pos_trend_of(kpis.trend_sums(narrow))) == rows(kpis.pos_trend(narrow))


def test_a_period_without_rows_is_gone(spark):
    one = spark.createDataFrame([(1, -1, 5.0, 0, 1)], SCHEMA)
    gone = kpis.trend_sums(one.withColumn("sign", F.lit(-1)), F.col("sign"))
    assert kpis.changed_sums(kpis.trend_sums(one), gone).count() == 0


@pytest.fixture
def card(spark, monkeypatch, name, tmp_path):
    """A silver table and its trend under names of their own."""
    monkeypatch.setitem(runs.TRENDS, f"mart_{name}", (name, kpis.balance_trend_of))
    monkeypatch.setitem(runs.TABLES, name, runs.TableSpec(source=name, silver=name, keys=tuple(KEYS), trend=("MONTHS_BALANCE", "AMT_BALANCE")))
    yield name, f"mart_{name}", str(tmp_path)
    for table in (name, f"mart_{name}", f"mart_{name}_sums"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("partition_by", [None, "key_range"])
def test_published_trend_follows_kept_changes(spark, card, rows, partition_by):
    silver, mart, root = card
    layout = sinks.Layout(range_key="SK_ID_PREV", range_width=10) if partition_by else sinks.Layout()

    def put(seed, changes=("MONTHS_BALANCE", "AMT_BALANCE")):
        sinks.publish_upsert(spark, silver, layout.apply(spark.createDataFrame(batch(seed), SCHEMA)), KEYS, root, order=["ingestion_ts"],
                             partition_by=partition_by, changes=changes)

    def refreshed():
        _, from_changes = runs.refresh_trend(spark, mart, root)
        assert rows(spark.table(mart)) == rows(kpis.balance_trend(spark.table(silver)))
        return from_changes

    put(0)
    assert not refreshed()  # nothing to start from
    assert refreshed()  # nothing changed
    put(1)
    put(2)
    assert refreshed()  # two steps at once
    put(3, changes=())
    assert not refreshed()  # written without keeping changes
    put(4)
    assert not refreshed()  # made anew from a version that was never named
    put(5)
    assert refreshed()
    put(6)
    # an upsert that died after it had kept its changes leaves a second way on
    version = sinks.reflects(spark, f"{mart}_sums")
    spark.createDataFrame([(-1, 1.0, 1)], "MONTHS_BALANCE int, AMT_BALANCE double, sign int").write.parquet(f"{root}/_changes/{silver}/{version}__dead")
    assert not refreshed()
    put(7)
    assert refreshed()


def test_sums_that_were_being_replaced_are_made_anew(spark, card):
    silver, mart, root = card
    sinks.publish_upsert(spark, silver, spark.createDataFrame(batch(0), SCHEMA), KEYS, root, changes=["MONTHS_BALANCE", "AMT_BALANCE"])
    runs.refresh_trend(spark, mart, root)
    sinks.note_reflects(spark, f"{mart}_sums", "")
    assert not runs.refresh_trend(spark, mart, root)[1]
