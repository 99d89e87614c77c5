"""Closures by absence, returns, refused states, batch ownership, rebuilds, removal of superseded versions."""

import pytest

from sedimenta.operators import quality as q
from sedimenta.operators import scd2
from sedimenta.plans import runs
from sedimenta.sources import sinks
from tests.test_scd2 import T0, T1, T2, source, state

COLUMNS = scd2.DIM_APPLICANT.columns


def people(spark, *keys, children=0):
    return source(spark, [(k, "a", "h", "m", children) for k in keys])


@pytest.mark.parametrize("publish", [sinks.publish_dimension, sinks.publish_dimension_sliced])
def test_closed_missing_and_returning_entities(spark, tmp_path, name, publish):
    root = str(tmp_path)
    publish(spark, name, people(spark, 1, 2, 3), T0, root)
    publish(spark, name, people(spark, 1), T1, root, close_missing=True)
    after = state(spark.table(name).select(*COLUMNS))
    assert [v[:3] for v in after[2]] == [(T0, T1, False)] and [v[:3] for v in after[1]] == [(T0, None, True)]
    publish(spark, name, people(spark, 1, 2), T2, root)  # back again; closing is over
    after = state(spark.table(name).select(*COLUMNS))
    assert [v[:3] for v in after[2]] == [(T0, T1, False), (T2, None, True)]
    assert scd2.interval_violations(spark.table(name)).count() > 0
    assert scd2.interval_violations(spark.table(name), absences=True).count() == 0
    assert sinks.closes_missing(spark, name)


@pytest.mark.parametrize("publish", [sinks.publish_dimension, sinks.publish_dimension_sliced])
def test_every_current_row_can_close(spark, tmp_path, name, rows, publish):
    root = str(tmp_path)
    publish(spark, name, people(spark, 1, 2), T0, root)
    publish(spark, name, people(spark), T1, root, close_missing=True)
    assert rows(spark.table(name), "applicant_id", "is_current") == [(1, False), (2, False)]
    publish(spark, name, people(spark, 2), T2, root, close_missing=True)
    assert rows(spark.table(name).filter("is_current"), "applicant_id") == [(2,)]
    assert spark.table(name).count() == 3


def test_versions_of_unknown_state_are_refused(spark, tmp_path, name):
    root = str(tmp_path)
    sinks.publish_dimension(spark, name, people(spark, 1, 2), T0, root)
    broken = spark.table(name).selectExpr(*[c if c != "is_current" else "CASE WHEN applicant_id = 1 THEN is_current END AS is_current" for c in COLUMNS])
    sinks.publish(spark, name, broken, root)
    with pytest.raises(q.GateFailure, match="state_known"):
        sinks.publish_dimension(spark, name, people(spark, 1, 2, children=1), T1, root)
    kept = scd2.apply_scd2(broken, people(spark, 1, 2, children=1), T1)
    assert kept.filter("applicant_id = 2 AND start_date = timestamp_ntz'2024-01-01 00:00:00'").count() == 1  # nothing is lost


@pytest.mark.parametrize(("versions", "bad"), [
    ([(T0, T1)], False), ([(T0, T1), (T2, None)], False), ([(T0, T2), (T1, None)], True), ([(T0, None), (T1, None)], True), ([(T0, T0)], True), ([(T0, T1), (T1, None)], False),
])
def test_intervals_with_absences(spark, versions, bad):
    df = spark.createDataFrame([(1, a, b, b is None) for a, b in versions], "applicant_id long, start_date timestamp_ntz, end_date timestamp_ntz, is_current boolean")
    assert (scd2.interval_violations(df, absences=True).count() > 0) is bad


def test_gates_have_names_of_their_own(spark):
    gates = [q.Gate("same", spark.range(3)), q.Gate("same", spark.range(0))]
    with pytest.raises(ValueError, match="same"):
        q.enforce(gates)


def test_only_blocking_checks_raise(spark):
    rows = "SELECT 'r' AS run_id, 't' AS table_name, 'c' AS check_name, '{}' AS severity, 3L AS observed, 0L AS expected, {} AS passed"
    q.enforce_checks(spark.sql(rows.format("HIGH", "false")))
    q.enforce_checks(spark.sql(rows.format("CRITICAL", "true")))
    with pytest.raises(q.GateFailure, match="t.c: 3"):
        q.enforce_checks(spark.sql(rows.format("CRITICAL", "false")))


def land(folder, lines):
    folder.mkdir(parents=True)
    (folder / "bureau.csv").write_text("\n".join(["SK_ID_CURR,SK_ID_BUREAU,DAYS_CREDIT,AMT_CREDIT_SUM,AMT_CREDIT_SUM_DEBT,CREDIT_DAY_OVERDUE", *lines]) + "\n")


@pytest.fixture
def bureau(spark, tmp_path):
    for batch, lines in {"b1": ["1,1,-1,10.0,1.0,0", "1,2,-1,20.0,1.0,0"], "b2": ["1,1,bad,11.0,1.0,0", "1,3,-1,30.0,1.0,0"], "b3": ["1,2,-3,22.0,1.0,0", "1,3,worse,31.0,1.0,0"]}.items():
        land(tmp_path / batch, lines)
    yield tmp_path
    spark.sql("DROP TABLE IF EXISTS silver_bureau")


def take_in(spark, base, batch, day):
    runs.ingest(spark, str(base / batch), str(base / "bronze"), batch_id=batch, env="dev", ingestion_ts=f"2024-01-0{day}T00:00:00", tables=["bureau"])


def test_a_batch_loaded_again_on_another_day_is_replaced(spark, bureau):
    take_in(spark, bureau, "b1", 1)
    take_in(spark, bureau, "b2", 1)
    take_in(spark, bureau, "b1", 2)
    rows = spark.read.parquet(str(bureau / "bronze" / "bronze_bureau"))
    assert sorted((r["batch_id"], str(r["ingestion_date"]), r["SK_ID_BUREAU"]) for r in rows.collect()) == [
        ("b1", "2024-01-02", 1), ("b1", "2024-01-02", 2), ("b2", "2024-01-01", 1), ("b2", "2024-01-01", 3)]


def test_rebuild_equals_batch_by_batch_and_keeps_every_bad_arrival(spark, bureau, rows):
    root = str(bureau / "one")
    for day, batch in enumerate(("b1", "b2", "b3"), 1):
        take_in(spark, bureau, batch, day)
        runs.build_silver(spark, str(bureau / "bronze"), root, batch_ids=[batch], tables=["bureau"])
    columns = ["SK_ID_BUREAU", "AMT_CREDIT_SUM", "batch_id"]
    step_by_step = rows(spark.table("silver_bureau"), *columns)
    bad = rows(spark.read.parquet(f"{root}/quarantine_bureau"), *columns)
    assert step_by_step == [(1, 10.0, "b1"), (2, 22.0, "b3"), (3, 30.0, "b2")] and bad == [(1, 11.0, "b2"), (3, 31.0, "b3")]
    spark.sql("DROP TABLE silver_bureau")
    runs.build_silver(spark, str(bureau / "bronze"), str(bureau / "two"), tables=["bureau"])
    assert rows(spark.table("silver_bureau"), *columns) == step_by_step
    assert rows(spark.read.parquet(str(bureau / "two" / "quarantine_bureau")), *columns) == bad


def test_superseded_versions_are_removed_and_live_ones_stay(spark, tmp_path, name, rows):
    root, layout = str(tmp_path), sinks.Layout(range_key="k", range_width=10)
    other = f"{name}_dim"
    for run in range(3):  # the first two key ranges are written once, the third three times
        keys = range(30) if run == 0 else range(20, 30)
        frame = spark.createDataFrame([(k, run) for k in keys], "k long, run long")
        sinks.publish_upsert(spark, name, layout.apply(frame), ["k"], root, partition_by=layout.partition_by)
        sinks.publish_dimension_sliced(spark, other, people(spark, 1, children=run), (T0, T1, T2)[run], root)
    before, history = rows(spark.table(name)), rows(spark.table(other))
    assert sinks.remove_superseded(spark, [name, other], root, 3600) == []
    removed = sinks.remove_superseded(spark, [name, other], root, -1)
    assert len(removed) == 2  # one version of the key ranges; one of the dimension, of which only a closed current slice was left
    assert rows(spark.table(name)) == before and rows(spark.table(other)) == history
    assert len(before) == 30 and len(history) == 3
