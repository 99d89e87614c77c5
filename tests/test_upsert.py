import pytest

from sedimenta.operators import upsert as u


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k long, val string, ingestion_ts long")


def test_insert_update_and_keep(spark, rows):
    target = frame(spark, [(1, "a", 1), (2, "b", 1)])
    updates = frame(spark, [(2, "B", 2), (3, "c", 2)])
    assert rows(u.upsert(target, updates, ["k"])) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]


def test_repeating_an_upsert_changes_nothing(spark, rows):
    one = frame(spark, [(42, "a", 1)])
    twice = u.upsert(u.upsert(one, one, ["k"]), one, ["k"])
    assert rows(twice) == [(42, "a", 1)]


def test_column_order_does_not_matter_but_column_sets_do(spark, rows):
    target = frame(spark, [(1, "a", 1)])
    swapped = frame(spark, [(1, "z", 2)]).select("val", "ingestion_ts", "k")
    assert rows(u.upsert(target, swapped, ["k"])) == [(1, "z", 2)]
    with pytest.raises(ValueError, match="val"):
        u.upsert(target, swapped.drop("val"), ["k"])


def test_late_batch_does_not_replace_newer_rows(spark, rows):
    target, late = frame(spark, [(1, "new", 5)]), frame(spark, [(1, "old", 3), (2, "only", 3)])
    assert rows(u.upsert_latest(target, late, ["k"])) == [(1, "new", 5), (2, "only", 3)]
    assert rows(u.upsert_latest(late, target, ["k"])) == rows(u.upsert_latest(target, late, ["k"]))


def test_corrected_replay_of_the_same_batch_takes_effect(spark, rows):
    target, replay = frame(spark, [(1, "wrong", 5), (2, "x", None)]), frame(spark, [(1, "right", 5), (2, "y", None), (3, "z", None)])
    assert rows(u.upsert_latest(target, replay, ["k"])) == [(1, "right", 5), (2, "y", None), (3, "z", None)]
    undated = frame(spark, [(1, "undated", None)])
    assert rows(u.upsert_latest(target, undated, ["k"]))[0] == (1, "wrong", 5)


def test_lookup_has_stable_ids(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('C'), ('0'), ('C'), (NULL) AS t(STATUS)")
    out = u.lookup_rows(df, "STATUS", "status_id", "status_code", {"C": "closed"}, "status_description")
    assert rows(out, "status_code", "status_description") == [("0", "0"), ("C", "closed")]
    assert rows(out) == rows(u.lookup_rows(df.repartition(3), "STATUS", "status_id", "status_code", {"C": "closed"}, "status_description"))
