import contextlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import quality as q
from sedimenta.operators import scd2
from sedimenta.sources import sinks

SRC = "applicant_id long, SK_ID_CURR long, name_income_type string, name_education_type string, name_family_status string, cnt_children int"

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


@contextlib.contextmanager
def broadcast_off(spark):
    """Plan joins as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k long, v string, ingestion_ts long")


def source(spark, items):
    return spark.createDataFrame([(k, k, a, "h", "m", n) for k, a, n in items], SRC)


def test_publish_creates_then_replaces(spark, tmp_path, name, rows):
    root = str(tmp_path)
    sinks.publish(spark, name, frame(spark, [(1, "a", 1)]), root)
    reader = spark.table(name)
    sinks.publish(spark, name, frame(spark, [(2, "b", 1), (3, "c", 1)]), root)
    assert rows(spark.table(name)) == [(2, "b", 1), (3, "c", 1)]
    assert rows(reader) in ([(1, "a", 1)], [(2, "b", 1), (3, "c", 1)])  # old files stay readable


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path, name, rows):
    sinks.publish(spark, name, frame(spark, [(1, "a", 1)]), str(tmp_path))
    sinks.publish(spark, name, spark.table(name).withColumn("v", F.upper("v")), str(tmp_path))
    assert rows(spark.table(name)) == [(1, "A", 1)]


def test_failed_gate_leaves_the_last_good_version(spark, tmp_path, name, rows):
    sinks.publish(spark, name, frame(spark, [(1, "a", 1)]), str(tmp_path))
    with pytest.raises(q.GateFailure):
        sinks.publish(spark, name, frame(spark, [(2, "b", 1), (2, "c", 1)]), str(tmp_path), gates=sinks.key_gates(name, ["k"]))
    assert rows(spark.table(name)) == [(1, "a", 1)]


def test_failed_gate_on_first_load_creates_nothing(spark, tmp_path, name):
    with pytest.raises(q.GateFailure):
        sinks.publish(spark, name, frame(spark, [(None, "b", 1)]), str(tmp_path), gates=sinks.key_gates(name, ["k"]))
    assert not spark.catalog.tableExists(name)


def test_crash_between_stage_and_swap_leaves_the_last_good_version(spark, tmp_path, name, rows):
    sinks.publish(spark, name, frame(spark, [(1, "a", 1)]), str(tmp_path))

    def crash(_):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        sinks.publish(spark, name, frame(spark, [(2, "b", 1)]), str(tmp_path), gates=crash)
    assert rows(spark.table(name)) == [(1, "a", 1)]
    sinks.publish(spark, name, frame(spark, [(2, "b", 1)]), str(tmp_path))
    assert rows(spark.table(name)) == [(2, "b", 1)]


def test_schema_evolution_is_off(spark, tmp_path, name):
    sinks.publish(spark, name, frame(spark, [(1, "a", 1)]), str(tmp_path))
    with pytest.raises(ValueError, match="evolution"):
        sinks.publish(spark, name, frame(spark, [(1, "a", 1)]).withColumn("new", F.lit(1)), str(tmp_path))
    with pytest.raises(ValueError, match="'k'"):
        sinks.publish(spark, name, frame(spark, [(1, "a", 1)]).withColumn("k", F.col("k").cast("int")), str(tmp_path))


@pytest.mark.parametrize("buckets", [None, sinks.Buckets(("k",), 4)])
def test_upsert_branches_and_rerun(spark, tmp_path, name, rows, buckets):
    root = str(tmp_path)

    def run(pairs):
        sinks.publish_upsert(spark, name, frame(spark, pairs), ["k"], root, order=["ingestion_ts"], buckets=buckets)
        return rows(spark.table(name))

    assert run([(1, "a", 1), (2, "b", 1)]) == [(1, "a", 1), (2, "b", 1)]
    assert run([(1, "a", 1), (2, "b", 1)]) == [(1, "a", 1), (2, "b", 1)]
    assert run([(2, "B", 2), (3, "c", 2)]) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
    assert run([(2, "late", 0)]) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]


def test_upsert_refuses_repeated_and_null_keys(spark, tmp_path, name, rows):
    sinks.publish_upsert(spark, name, frame(spark, [(1, "a", 1)]), ["k"], str(tmp_path))
    for bad in ([(2, "x", 1), (2, "y", 1)], [(None, "x", 1)]):
        with pytest.raises(q.GateFailure):
            sinks.publish_upsert(spark, name, frame(spark, bad), ["k"], str(tmp_path))
    assert rows(spark.table(name)) == [(1, "a", 1)]


def test_bucketed_target_is_not_shuffled(spark, tmp_path, name):
    big = spark.range(2000).selectExpr("id AS k", "CAST(id AS STRING) AS v", "id AS ingestion_ts")
    sinks.publish_upsert(spark, name, big, ["k"], str(tmp_path), buckets=sinks.Buckets(("k",), 4))
    from sedimenta.operators.upsert import upsert

    with broadcast_off(spark):
        merged = upsert(spark.table(name), big.filter("k % 2 = 0").repartition(3), ["k"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(k") == 1  # the updates only


def test_repeated_upserts_into_buckets_keep_few_files(spark, tmp_path, name, rows):
    buckets = sinks.Buckets(("k",), 4)

    def batch(lo, hi, ts):
        return spark.range(lo, hi, 1, 5).selectExpr("id AS k", f"'b{ts}' AS v", f"{ts}L AS ingestion_ts")

    for ts, (lo, hi) in enumerate([(0, 400), (100, 500), (50, 60), (0, 500)]):
        with broadcast_off(spark):
            sinks.publish_upsert(spark, name, batch(lo, hi, ts), ["k"], str(tmp_path), order=["ingestion_ts"], buckets=buckets)
        table = spark.table(name)
        per_bucket = table.selectExpr("regexp_extract(input_file_name(), '_([0-9]{5})[.]', 1) AS b", "input_file_name() AS f")
        assert per_bucket.distinct().groupBy("b").count().agg({"count": "max"}).first()[0] <= 2
    assert rows(table.groupBy("v").count()) == [("b3", 500)]


def test_a_table_keeps_the_layout_it_was_created_with(spark, tmp_path, name, rows):
    root, buckets = str(tmp_path), sinks.Buckets(("k",), 2)
    sinks.publish(spark, name, frame(spark, [(1, "a", 1), (2, "b", 1)]), root, buckets=buckets)
    sinks.publish(spark, name, frame(spark, [(3, "c", 1)]), root)  # still written in its buckets
    assert rows(spark.table(name)) == [(3, "c", 1)]
    assert rows(spark.table(name).groupBy("k").count()) == [(3, 1)]
    with pytest.raises(ValueError, match="created with"):
        sinks.publish(spark, name, frame(spark, [(3, "c", 1)]), root, buckets=sinks.Buckets(("k",), 3))
    with pytest.raises(ValueError, match="not partitioned"):
        sinks.publish_partitions(spark, name, frame(spark, [(3, "c", 1)]), "v", root)
    parts = f"{name}_p"
    sinks.publish_partitions(spark, parts, frame(spark, [(3, "c", 1)]), "v", root)
    with pytest.raises(ValueError, match="partitioned by"):
        sinks.publish(spark, parts, spark.table(parts), root)
    with pytest.raises(ValueError, match="not both"):
        sinks.publish_upsert(spark, parts, spark.table(parts), ["k"], root, buckets=buckets, partition_by="v")


def test_range_partitions_are_written_in_few_files_and_a_hot_one_is_split(spark, tmp_path, name):
    """A third of the keys share one range; its rows are written by several tasks, the small ranges by one each."""
    df = spark.range(0, 60000, 1, 6).selectExpr(
        "id AS k", "sha2(CAST(id AS STRING), 256) AS v", "1L AS ingestion_ts",
        "IF(id % 3 = 0, 'hot', CONCAT('r', id % 20)) AS key_range",
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "300KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
                "spark.sql.shuffle.partitions": "30"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        sinks.publish_upsert(spark, name, df, ["k"], str(tmp_path), partition_by="key_range")
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
    files = spark.table(name).selectExpr("key_range", "input_file_name() AS f").distinct().groupBy("key_range").count()
    counts = {r["key_range"]: r["count"] for r in files.collect()}
    assert counts.pop("hot") > 1 and max(counts.values()) <= 2
    assert spark.table(name).count() == 60000


def test_bucketed_dimension_runs(spark, tmp_path, name, rows):
    root, buckets = str(tmp_path), sinks.Buckets(("applicant_id",), 3)
    plain = f"{name}_plain"
    for as_of, items in ((T0, [(k, "a", k % 2) for k in range(30)]), (T1, [(k, "a" if k % 3 else "b", k % 2) for k in range(40)])):
        with broadcast_off(spark):
            sinks.publish_dimension(spark, name, source(spark, items), as_of, root, buckets=buckets)
        sinks.publish_dimension(spark, plain, source(spark, items), as_of, root)
    assert rows(spark.table(name)) == rows(spark.table(plain))
    files = spark.table(name).selectExpr("input_file_name() AS f").distinct().count()
    assert files <= 9


def test_range_layout_names_partitions(spark, rows):
    layout = sinks.Layout(range_key="k", range_width=100)
    df = spark.sql("SELECT * FROM VALUES (0L), (99L), (100L), (-1L), (9007199254740993L) AS t(k)")
    assert rows(layout.apply(df)) == [(-1, "r-1"), (0, "r0"), (100, "r1"), (9007199254740993, "r90071992547409"), (99, "r0")]
    assert sinks.Layout().apply(df) is df and sinks.Layout().partition_by is None


def test_only_work_folders_are_dropped(spark, tmp_path):
    work = sinks.shared_work_dir(spark, str(tmp_path))
    assert work.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(1).write.parquet(work)
    sinks.drop_work_dir(spark, work)
    assert not Path(work).exists()
    with pytest.raises(ValueError, match="not a work folder"):
        sinks.drop_work_dir(spark, str(tmp_path))


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, tmp_path, name, rows):
    def ranged(lo, hi, v, ts):
        return spark.range(lo, hi).selectExpr("id AS k", f"'{v}' AS v", f"{ts}L AS ingestion_ts", "CONCAT('r', id DIV 10) AS key_range")

    def locations():
        out = {}
        for (p,) in spark.sql(f"SHOW PARTITIONS {name}").collect():
            value = p.split("=")[1]
            detail = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (key_range = '{value}')").collect()
            out[value] = [r["data_type"] for r in detail if r["col_name"] == "Location"][0]
        return out

    sinks.publish_upsert(spark, name, ranged(0, 30, "a", 1), ["k"], str(tmp_path), partition_by="key_range")
    before = locations()
    sinks.publish_upsert(spark, name, ranged(15, 18, "b", 2), ["k"], str(tmp_path), partition_by="key_range")
    after = locations()
    assert {p for p in before if before[p] != after[p]} == {"r1"}
    assert rows(spark.table(name).groupBy("v").count()) == [("a", 27), ("b", 3)]
    sinks.publish_upsert(spark, name, ranged(28, 32, "c", 3), ["k"], str(tmp_path), partition_by="key_range")
    assert spark.table(name).count() == 32



def test_dimension_runs(spark, tmp_path, name, rows):
    root = str(tmp_path)
    sinks.publish_dimension(spark, name, source(spark, [(1, "a", None), (2, "b", 1)]), T0, root)
    src = source(spark, [(1, "a", 2), (2, "b", 1), (3, "c", 0)])
    sinks.publish_dimension(spark, name, src, T1, root)
    first = rows(spark.table(name))
    sinks.publish_dimension(spark, name, src, T2, root)
    assert rows(spark.table(name)) == first and len(first) == 4


def test_dimension_refuses_a_source_that_repeats_a_key(spark, tmp_path, name):
    with pytest.raises(q.GateFailure, match="source_unique"):
        sinks.publish_dimension(spark, name, source(spark, [(1, "a", 1), (1, "b", 1)]), T0, str(tmp_path))


def test_dimension_refuses_an_instant_before_an_open_start(spark, tmp_path, name):
    sinks.publish_dimension(spark, name, source(spark, [(1, "a", 1)]), T1, str(tmp_path))
    with pytest.raises(q.GateFailure, match="intervals"):
        sinks.publish_dimension(spark, name, source(spark, [(1, "b", 1)]), T0, str(tmp_path))
    assert spark.table(name).count() == 1


def test_sliced_dimension_equals_the_whole_one(spark, tmp_path, name, rows):
    root = str(tmp_path)
    runs = [(T0, [(k, "a", k % 2) for k in range(20)]), (T1, [(k, "a" if k % 3 else "b", k % 2) for k in range(25)]),
            (T2, [(k, "c" if k % 5 == 0 else "a", k % 2) for k in range(25)])]
    for as_of, items in runs:
        src = source(spark, items)
        sinks.publish_dimension(spark, name, src, as_of, root)
        sinks.publish_dimension_sliced(spark, f"{name}_sliced", src, as_of, root)
    sliced = spark.table(f"{name}_sliced")
    columns = scd2.DIM_APPLICANT.columns
    assert rows(sliced, *columns) == rows(spark.table(name), *columns)
    assert scd2.interval_violations(sliced).count() == 0
    sinks.publish_dimension_sliced(spark, f"{name}_sliced", source(spark, runs[-1][1]), T2, root)  # again, same instant
    assert rows(spark.table(f"{name}_sliced"), *columns) == rows(spark.table(name), *columns)


def test_sliced_dimension_survives_a_crash_between_its_two_steps(spark, tmp_path, name, rows, monkeypatch):
    root, table = str(tmp_path), f"{name}_sliced"
    sinks.publish_dimension_sliced(spark, table, source(spark, [(1, "a", 1), (2, "b", 1)]), T0, root)
    src = source(spark, [(1, "z", 1), (2, "b", 1)])
    real = type(spark).sql

    def crash_on_current(self, text, *args, **kwargs):
        if "SET LOCATION" in text and "'current'" in text:
            raise KeyboardInterrupt
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", crash_on_current)
    with pytest.raises(KeyboardInterrupt):
        sinks.publish_dimension_sliced(spark, table, src, T1, root)
    monkeypatch.undo()
    spark.catalog.refreshTable(table)
    assert q.multiple_current(spark.table(table)).count() == 0 and q.no_current(spark.table(table), src).count() == 0
    sinks.publish_dimension_sliced(spark, table, src, T1, root)
    sinks.publish_dimension(spark, name, source(spark, [(1, "a", 1), (2, "b", 1)]), T0, root)
    sinks.publish_dimension(spark, name, src, T1, root)
    columns = scd2.DIM_APPLICANT.columns
    assert rows(spark.table(table), *columns) == rows(spark.table(name), *columns)


def test_json_sink_has_one_layout_at_every_size(spark, tmp_path):
    def parts(path):
        return len([p for p in path.iterdir() if p.name.startswith("part-")])

    sinks.write_json(spark.range(100).repartition(3), str(tmp_path / "small"))
    sinks.write_json(spark.range(100_000).repartition(3), str(tmp_path / "large"))
    assert parts(tmp_path / "small") == 3 and parts(tmp_path / "large") == 3
    assert spark.read.json(str(tmp_path / "large")).count() == 100_000


def scan_figures(df):
    """Figures of the executed scans of partitioned tables: (partitions read, files known, files read)."""
    found = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        metrics = node.metrics()
        if node.nodeName().startswith("Scan") and metrics.contains("numPartitions"):
            found.append(tuple(int(metrics.apply(m).value()) for m in ("numPartitions", "staticFilesNum", "numFiles")))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_upsert_prunes_partitions_at_run_time(spark, tmp_path, name):
    layout = sinks.Layout(range_key="k", range_width=10)
    table = layout.apply(spark.range(200).selectExpr("id AS k", "id AS v"))
    sinks.publish_upsert(spark, name, table, ["k"], str(tmp_path), partition_by=layout.partition_by)
    layout.apply(spark.range(42, 55).selectExpr("id AS k", "id * 2 AS v")).write.parquet(str(tmp_path / "updates"))
    updates = spark.read.parquet(str(tmp_path / "updates"))
    touched = sinks.touched_partitions(spark.table(name), updates, "key_range")
    assert len(touched.collect()) == 20
    assert "dynamicpruningexpression" in touched._jdf.queryExecution().executedPlan().toString()
    assert [(p, known) for p, known, _ in scan_figures(touched)] == [(2, 20)]
    sinks.publish_upsert(spark, name, updates, ["k"], str(tmp_path), partition_by="key_range")
    assert spark.table(name).agg(F.sum("v")).first()[0] == sum(range(200)) + sum(range(42, 55))


def test_updates_are_computed_once(spark, tmp_path, name):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    sinks.publish_upsert(spark, name, spark.range(30).selectExpr("id AS k", "id % 3 AS ts"), ["k"], str(tmp_path), order=["ts"])
    updates = spark.range(10, 40).selectExpr("id AS k", "5L AS ts").mapInArrow(counted, "k long, ts long")
    sinks.publish_upsert(spark, name, updates, ["k"], str(tmp_path), order=["ts"])
    assert seen.value == 30 and spark.table(name).filter("ts = 5").count() == 30
    assert not list(tmp_path.glob("_work/*"))
