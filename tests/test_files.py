import hashlib
import shutil

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.cleanse import latest_per_key
from sedimenta.sources import files, landing, sinks
from sedimenta.sources.registry import TABLES, declared_types


def test_csv_is_typed_from_its_header_and_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("SK_ID_CURR,AMT_CREDIT,NOTE\n1,10.5,x\n2,oops,y\n3,,z\n")
    df = files.read_csv(spark, str(tmp_path / "a.csv"), {"SK_ID_CURR": "bigint", "AMT_CREDIT": "double"})
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string", "string"]
    got = {r["SK_ID_CURR"]: r for r in df.collect()}
    assert got[1]["AMT_CREDIT"] == 10.5 and got[1][files.CORRUPT] is None
    assert got[2]["AMT_CREDIT"] is None and got[2][files.CORRUPT] == "2,oops,y"
    assert got[3]["AMT_CREDIT"] is None and got[3][files.CORRUPT] is None


def test_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,2\n")
    (tmp_path / "b.csv").write_text("v,k\n2,1\n")
    schema = files.header_schema(spark, str(tmp_path / "a.csv"), {"k": "bigint"})
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), schema=schema).collect()


def test_inference_is_only_on_request(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n1\n")
    assert files.read_csv(spark, str(tmp_path / "a.csv"), keep_corrupt=False).schema["k"].dataType.simpleString() == "string"
    assert files.read_csv(spark, str(tmp_path / "a.csv"), infer=True).schema["k"].dataType.simpleString() == "int"


def test_audit_columns_use_the_utc_date(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    df = files.tag_audit(spark.read.parquet(str(tmp_path / "t")), ingestion_ts="2024-01-01T23:30:00-02:00", batch_id="b1", env="dev")
    r = df.first()
    assert str(r["ingestion_date"]) == "2024-01-02" and r["batch_id"] == "b1" and r["env"] == "dev"
    assert r["source_file"].endswith(".parquet") and set(files.AUDIT_COLUMNS) <= set(df.columns)


def test_sample_limit_is_ordered(spark, rows):
    df = spark.range(100).selectExpr("99 - id AS id").repartition(5)
    assert rows(files.sample_limit(df, ["id"], 3)) == [(0,), (1,), (2,)]


def test_stratified_sample(spark, rows):
    df = spark.range(20000).selectExpr("id", "CASE WHEN id % 12 = 0 THEN 1 ELSE 0 END AS TARGET")
    sample = files.stratified_sample(df, "id", "TARGET", 0.1, seed=42)
    share = sample.count() / 20000
    assert abs(share - 0.1) < 0.01
    rate = sample.filter("TARGET = 1").count() / sample.count()
    assert abs(rate - 1 / 12) < 0.02
    assert rows(sample) == rows(files.stratified_sample(df.repartition(7), "id", "TARGET", 0.1, seed=42))
    assert rows(sample) != rows(files.stratified_sample(df, "id", "TARGET", 0.1, seed=43))
    by_class = files.stratified_sample(df, "id", "TARGET", {1: 1.0})
    assert rows(by_class) == rows(df.filter("TARGET = 1"))


def test_schema_drift_counts_what_would_be_lost(spark):
    df = spark.sql("SELECT * FROM VALUES ('1', 1), ('x', 2), (NULL, 3) AS t(a, b)")
    got = {r["column_name"]: tuple(r)[1:] for r in files.schema_drift(df, {"a": "int", "b": "int", "c": "string"}).collect()}
    assert got == {
        "a": ("int", "string", "retyped", 2, 1), "b": ("int", "int", "same", 3, 0), "c": ("string", None, "missing", 0, 0),
    }
    with pytest.raises(ValueError, match="drift"):
        files.require_no_drift({"a": "int"}, df.schema, "t")
    files.require_no_drift(df.schema, df.schema, "t")


def test_landing_manifest(spark, tmp_path):
    zone = tmp_path / "landing" / "dev" / "b1"
    zone.mkdir(parents=True)
    contents = {"a.csv": b"k\n1\n", "b with space.csv": bytes(range(256)) * 50, "empty.csv": b""}
    for file_name, data in contents.items():
        (zone / file_name).write_bytes(data)
    found = landing.landing_manifest(spark, str(tmp_path / "landing"))
    got = {r["file_name"]: (r["bytes"], r["sha256"]) for r in found.collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}


def test_landing_changes(spark, tmp_path):
    zone = tmp_path / "landing"
    zone.mkdir()
    for file_name in ("same", "altered", "removed"):
        (zone / file_name).write_text(file_name)
    store = str(tmp_path / "recorded")
    landing.record_landing(landing.landing_manifest(spark, str(zone)), batch_id="b1", env="dev", ingestion_ts="2024-01-01").write.parquet(store)
    recorded = spark.read.parquet(store)
    assert landing.landing_changes(recorded, landing.landing_manifest(spark, str(zone))).count() == 0
    shutil.copy(zone / "removed", zone / "added")
    (zone / "removed").unlink()
    (zone / "altered").write_text("ALTERED")
    changes = landing.landing_changes(recorded, landing.landing_manifest(spark, str(zone))).collect()
    assert {r["path"].rsplit("/", 1)[-1]: r["status"] for r in changes} == {"added": "added", "removed": "removed", "altered": "altered"}


def test_replay_replaces_its_own_batch_only(spark, tmp_path, rows):
    path = str(tmp_path / "bronze")

    def batch(batch_id, value):
        return files.tag_audit(spark.range(3).withColumn("v", F.lit(value)), ingestion_ts="2024-01-01T00:00:00", batch_id=batch_id, env="dev", source_file="f.csv")

    parts = ["ingestion_date", "batch_id"]
    sinks.append_partitioned(batch("b1", 1), path, parts)
    sinks.append_partitioned(batch("b2", 2), path, parts)
    sinks.replace_partitions(batch("b1", 9), path, parts)
    got = spark.read.parquet(path).groupBy("batch_id", "v").count()
    assert rows(got) == [("b1", 9, 3), ("b2", 2, 3)]
    assert files.scan_layer(spark, path, batch_ids=["b2"]).count() == 3
    assert files.scan_layer(spark, path, since="2024-01-02").count() == 0


def test_batch_names_that_look_like_numbers_stay_text(spark, tmp_path, rows):
    path = str(tmp_path / "bronze")
    for batch_id in ("0012", "13"):
        df = files.tag_audit(spark.range(2), ingestion_ts="2024-01-01", batch_id=batch_id, env="dev", source_file="f")
        sinks.replace_partitions(df, path, ["ingestion_date", "batch_id"])
    assert rows(files.scan_layer(spark, path), "batch_id") == [("0012",), ("0012",), ("13",), ("13",)]
    assert files.scan_layer(spark, path, batch_ids=["0012"]).count() == 2


def test_view_follows_its_table(spark, rows):
    sinks.create_view(spark.range(3).filter("id > 0"), "v_test_files")
    assert rows(spark.sql("SELECT * FROM v_test_files")) == [(1,), (2,)]


def test_declared_types_cover_keys_and_casts():
    for spec in TABLES.values():
        types = declared_types(spec)
        assert set(spec.keys) | set(spec.casts) <= set(types)
    assert declared_types(TABLES["installments_payments"])["NUM_INSTALMENT_NUMBER"] == "int"


def test_later_line_wins_whatever_the_splits(spark, tmp_path, rows):
    """One batch, one moment, ties everywhere: values as text would rank 99 above 249."""
    folder = tmp_path / "cards.csv"
    folder.mkdir()
    n = 3_000
    for part in range(2):
        (folder / f"part-{part}.csv").write_text("\n".join(["k,AMT_X,note", *(f"{i % 50},{(i * 7919) % 1000}.0,{part}-{i}" for i in range(n))]) + "\n")
    want = sorted((k, f"1-{max(i for i in range(n) if i % 50 == k)}") for k in range(50))
    want = sorted(want, key=repr)
    for size in ("64m", "4k", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            scan = files.with_source_line(files.read_csv(spark, str(folder), {"k": "bigint"}))
            if size == "700":
                assert scan.rdd.getNumPartitions() > 20
            tagged = files.tag_audit(scan, ingestion_ts="2024-01-01", batch_id="b1", env="dev")
            tagged.write.parquet(str(tmp_path / f"bronze{size}"))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        bronze = spark.read.parquet(str(tmp_path / f"bronze{size}"))
        assert bronze.schema["AMT_X"].dataType.simpleString() == "double"
        assert rows(latest_per_key(bronze.repartition(7), ["k"]), "k", "note") == want
        assert rows(latest_per_key(bronze.withColumn("batch_id", F.expr("IF(note LIKE '0-%', 'b2', 'b1')")), ["k"]), "k", "note") == sorted(((k, "0" + v[1:]) for k, v in want), key=repr)


def test_numbers_in_text_rank_as_numbers(spark, rows):
    df = spark.createDataFrame([(1, "t", "99.0"), (1, "t", "249.0"), (2, "t", "x"), (2, "t", "5")], "k long, ingestion_ts string, v string")
    assert rows(latest_per_key(df, ["k"], types={"v": "double"}), "k", "v") == [(1, "249.0"), (2, "5")]
    assert rows(latest_per_key(df, ["k"]), "k", "v") == [(1, "99.0"), (2, "x")]


def test_landing_manifest_hashes_files_of_any_size(spark, tmp_path):
    zone = tmp_path / "landing" / "b1" / "deep"
    zone.mkdir(parents=True)
    (tmp_path / "landing" / "_hidden").write_text("no")
    (tmp_path / "landing" / "b1" / ".tmp").write_text("no")
    (tmp_path / "landing" / "empty.csv").touch()
    (zone / "a b%20ü.csv").write_bytes(b"x" * (landing.PIECE + 3))
    large = 2**31 + 12_345  # beyond what fits one array of the JVM; a sparse file
    with open(zone / "large.bin", "wb") as file:
        file.truncate(large)
    got = {r["file_name"]: (r["bytes"], r["sha256"], r["path"]) for r in landing.landing_manifest(spark, str(tmp_path / "landing")).collect()}
    assert {k: v[0] for k, v in got.items()} == {"empty.csv": 0, "a b%20ü.csv": landing.PIECE + 3, "large.bin": large}
    zeros = hashlib.sha256()
    for _ in range(large // 2**20):
        zeros.update(bytes(2**20))
    zeros.update(bytes(large % 2**20))
    assert got["large.bin"][1] == zeros.hexdigest() and got["empty.csv"][1] == hashlib.sha256(b"").hexdigest()
    assert got["a b%20ü.csv"][1] == hashlib.sha256(b"x" * (landing.PIECE + 3)).hexdigest()
    assert got["empty.csv"][2] == f"file:{tmp_path}/landing/empty.csv"
    only = landing.landing_manifest(spark, str(tmp_path / "landing"), pattern="*.csv")
    assert sorted(r["file_name"] for r in only.collect()) == ["a b%20ü.csv", "empty.csv"]
    single = landing.landing_manifest(spark, str(tmp_path / "landing" / "empty.csv")).collect()
    assert [(r["file_name"], r["bytes"]) for r in single] == [("empty.csv", 0)]


def test_landing_manifest_through_another_store(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1")

    def store(uri):
        from pyarrow import fs

        return fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()), "/"

    got = landing.landing_manifest(spark, str(tmp_path), stores={"file": store}).collect()
    assert [(r["path"], r["bytes"]) for r in got] == [(f"file:{tmp_path}/x.csv", 1)]
