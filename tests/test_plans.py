"""What the physical plans must look like for the operators to hold at scale."""

import contextlib

import pytest

from sedimenta.operators import cleanse, scd2
from sedimenta.operators import quality as q
from sedimenta.plans import kpis
from sedimenta.sources import files
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("query", sorted(QUERIES))
def test_no_python_and_no_cross_join_in_any_query(spark, query):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = physical(QUERIES[query](spark, SF))
    # What a query holds in the checkpoint folder, or says about columns, is read back as such.
    held = ("ExistingRDD",) if query not in ("fact_join_asof_sorted", "row_hash_diff_sketched", "schema_renames") else ()
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", *held):
        assert node not in plan, (query, node)


def test_dedup_is_limited_before_its_only_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = physical(cleanse.latest_per_key(df, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert plan.count("Exchange hashpartitioning") == 1
    before, after = plan.split("Exchange hashpartitioning")
    assert "Final" in before and "Partial" in after


def test_a_hot_key_sends_one_row_per_task_through_the_dedup_shuffle(spark):
    """A third of the rows share one key; with that key alone, only one row per task is written."""
    df = spark.range(0, 30000, numPartitions=6).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id % 100 AS ingestion_ts", "id AS v")
    latest = cleanse.latest_per_key(df, ["k"])
    assert latest.count() == 20001
    hot = cleanse.latest_per_key(df.filter("k = -1"), ["k"])
    assert [tuple(r) for r in hot.collect()] == [(-1, 99, 29799)]
    shuffled = written_records(hot)
    assert shuffled == 6


def written_records(df):
    """Records that crossed the shuffle stages of an executed adaptive plan."""
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
            continue
        metrics = node.metrics()
        if node.nodeName() == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_hot_fact_key_is_split_in_dimension_joins(spark, tmp_path):
    src = spark.range(3000).selectExpr(
        "id AS applicant_id", "id AS SK_ID_CURR", "CONCAT('type', id) AS name_income_type", "'h' AS name_education_type",
        "'m' AS name_family_status", "1 AS cnt_children",
    )
    scd2.first_versions(src, "2024-01-01 00:00:00").write.parquet(str(tmp_path / "dim"))
    spark.range(0, 200000, numPartitions=8).selectExpr(
        "id AS f", "IF(id % 3 = 0, 7, id % 3000) AS applicant_id", "TIMESTAMP_NTZ'2024-01-02 00:00:00' AS at",
        "sha2(CAST(id AS STRING), 256) AS payload",
    ).write.parquet(str(tmp_path / "fact"))
    dim, fact = spark.read.parquet(str(tmp_path / "dim")), spark.read.parquet(str(tmp_path / "fact"))
    settings = {
        "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__shuffle__partitions": "16", "spark__sql__adaptive__advisoryPartitionSizeInBytes": "256KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "512KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    }
    with conf(spark, **settings):
        for joined in (
            scd2.join_current(fact, dim, ["name_income_type"]),
            scd2.join_as_of(fact, dim, "at", ["name_income_type"]),
        ):
            assert joined.filter("applicant_id = 7 AND name_income_type = 'type7'").count() > 60000
            assert len(joined.collect()) == 200000
            assert "skew=true" in physical(joined)


def test_applying_a_source_joins_once_and_leaves_history_alone(spark, tmp_path):
    src = spark.range(100).selectExpr(
        "id AS applicant_id", "id AS SK_ID_CURR", "'a' AS name_income_type", "'h' AS name_education_type",
        "'m' AS name_family_status", "1 AS cnt_children",
    )
    scd2.first_versions(src, "2024-01-01 00:00:00").write.parquet(str(tmp_path / "dim"))
    src.write.parquet(str(tmp_path / "src"))
    dim, src = spark.read.parquet(str(tmp_path / "dim")), spark.read.parquet(str(tmp_path / "src"))
    plan = physical(scd2.apply_scd2(dim, src, "2024-02-01 00:00:00"))
    assert plan.count("FullOuter") == 1 and plan.count("Exchange hashpartitioning") == 2
    detail = spark._jvm.PythonSQLUtils.explainString(
        scd2.apply_scd2(dim, src, "2024-02-01 00:00:00")._jdf.queryExecution(), "formatted"
    )
    # history passes through on its own scan; only current rows and the source are shuffled
    assert "IsNotNull(is_current), EqualTo(is_current,true)" in detail
    assert "Or(IsNull(is_current),Not(EqualTo(is_current,true)))" in detail


def test_consumers_of_a_sliced_dimension_read_its_current_slice_only(spark, tmp_path):
    dim = spark.sql("SELECT 1L AS applicant_id, TRUE AS is_current, 'x' AS a, 'current' AS version_slice"
                    " UNION ALL SELECT 1L, FALSE, 'w', 'closed_2024'")
    dim.write.partitionBy("version_slice").parquet(str(tmp_path / "dim"))
    fact = spark.sql("SELECT 1L AS applicant_id")
    plan = physical(scd2.join_current(fact, spark.read.parquet(str(tmp_path / "dim")), ["a"]))
    assert "PartitionFilters: [isnotnull(version_slice" in plan


def test_order_aware_upsert_reads_narrow_columns_to_decide(spark, tmp_path):
    from sedimenta.operators.upsert import upsert_latest

    spark.range(100).selectExpr("id AS k", "id AS ingestion_ts", "CAST(id AS STRING) AS wide").write.parquet(str(tmp_path / "t"))
    spark.range(50).selectExpr("id AS k", "id AS ingestion_ts", "'u' AS wide").write.parquet(str(tmp_path / "u"))
    target, updates = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "u"))
    merged = upsert_latest(target, updates, ["k"])
    small = physical(merged)
    assert "Exchange hashpartitioning" not in small and small.count("BroadcastHashJoin") == 3  # target is not shuffled
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        large = physical(upsert_latest(target, updates, ["k"]))
    assert large.count("ReadSchema: struct<k:bigint,ingestion_ts:bigint,wide:string>") == 2  # one wide scan per side


def test_scans_read_only_what_is_used(spark):
    fact = spark.read.parquet(f"{SF}/orders.parquet").selectExpr(
        "o_orderkey AS SK_ID_CURR", "o_orderpriority AS NAME_CONTRACT_TYPE", "IF(o_orderstatus = 'F', 1, 0) AS TARGET", "*"
    )
    plan = physical(kpis.default_rate(fact))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = physical(q.orphans(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_orderkey", orders, "o_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_incremental_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for batch in ("b1", "b2"):
        files.tag_audit(spark.range(3), ingestion_ts="2024-01-01", batch_id=batch, env="dev", source_file="f").write.mode(
            "append").partitionBy("ingestion_date", "batch_id").parquet(path)
    plan = physical(files.scan_layer(spark, path, batch_ids=["b2"], since="2024-01-01"))
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and "PushedFilters: []" in plan


def test_manifest_reads_its_table_once(spark):
    from sedimenta.operators.parity import manifest

    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = physical(manifest("t", df, ["l_orderkey", "l_linenumber"], "l_shipdate"))
    assert plan.count("FileScan") == 1 and "Expand" not in plan
