"""Manifests and comparisons that show a rebuild equals what it replaces."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as fn


def manifest(table_name: str, df: DataFrame, keys: Sequence[str], ts: str | None = None) -> DataFrame:
    """One row: row count, distinct complete keys, rows with a NULL in the key, latest timestamp."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    latest = F.max(F.col(ts)) if ts else F.max(F.lit(None).cast("timestamp_ntz"))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(*keys).alias("key_distinct"),
        F.count_if(incomplete).alias("key_nulls"),
        latest.cast("timestamp_ntz").alias("max_ts"),
    ).select(F.lit(table_name).alias("table_name"), "row_count", "key_distinct", "key_nulls", "max_ts")


def manifests(tables: Mapping[str, tuple[DataFrame, Sequence[str], str | None]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [manifest(n, df, keys, ts) for n, (df, keys, ts) in tables.items()])


def _paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both manifests side by side as ``a`` and ``b``, one row per table of either."""
    return left.alias("a").join(right.alias("b"), F.col("a.table_name") == F.col("b.table_name"), "full_outer")


def _either_name() -> Column:
    return F.coalesce(F.col("a.table_name"), F.col("b.table_name"))


def _check(tier: str, applies: Column, failed: Column, expected: Column, observed: Column) -> Column:
    return F.when(
        applies,
        F.struct(
            F.lit(tier).alias("tier"), expected.cast("bigint").alias("expected"),
            observed.cast("bigint").alias("observed"), (~failed).alias("passed"),
        ),
    )


def compare_manifests(baseline: DataFrame, rebuilt: DataFrame, expected_rows: Mapping[str, int] | None = None) -> DataFrame:
    """One row per table and tier with its verdict.

    ``T0`` table on both sides, ``T1`` row counts equal, ``T2`` key unique,
    ``T3`` no NULL keys, ``T5`` row count as stated in ``expected_rows``. Later
    tiers apply only to tables present on both sides; a key count that the
    rebuilt manifest does not hold is not judged.
    """
    a, b = {c: F.col(f"a.{c}") for c in baseline.columns}, {c: F.col(f"b.{c}") for c in rebuilt.columns}
    in_a, in_b = a["table_name"].isNotNull(), b["table_name"].isNotNull()
    both = in_a & in_b
    checks = [
        _check("T0", F.lit(True), ~both, in_a.cast("int"), in_b.cast("int")),
        _check("T1", both, a["row_count"] != b["row_count"], a["row_count"], b["row_count"]),
        _check("T2", both & b["key_distinct"].isNotNull(), b["key_distinct"] != b["row_count"], b["row_count"],
               b["key_distinct"]),
        _check("T3", both & b["key_nulls"].isNotNull(), b["key_nulls"] != 0, F.lit(0), b["key_nulls"]),
    ]
    if expected_rows:
        stated = F.create_map(*[F.lit(x) for pair in expected_rows.items() for x in pair])[_either_name()]
        checks.append(_check("T5", in_b & stated.isNotNull(), b["row_count"] != stated, stated, b["row_count"]))
    return _paired(baseline, rebuilt).select(
        _either_name().alias("table_name"), F.inline(F.array_compact(F.array(*checks)))
    )


def compare_runs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Idempotency verdict per table: counts, distinct keys and latest timestamp unchanged."""
    rows_same = F.col("a.row_count").eqNullSafe(F.col("b.row_count"))
    keys_same = F.col("a.key_distinct").eqNullSafe(F.col("b.key_distinct"))
    ts_same = F.col("a.max_ts").eqNullSafe(F.col("b.max_ts"))
    present = F.col("a.table_name").isNotNull() & F.col("b.table_name").isNotNull()
    return _paired(first, second).select(
        _either_name().alias("table_name"),
        (F.coalesce(F.col("b.row_count"), F.lit(0)) - F.coalesce(F.col("a.row_count"), F.lit(0))).alias("row_delta"),
        present.alias("in_both"),
        rows_same.alias("rows_same"),
        keys_same.alias("keys_same"),
        ts_same.alias("latest_ts_same"),
        (present & rows_same & keys_same & ts_same).alias("passed"),
    )


def row_hash_diff(left: DataFrame, right: DataFrame, keys: Sequence[str] = (),
                  columns: Sequence[str] | None = None, screen: int | None = None) -> DataFrame:
    """Rows that differ between two tables, as multisets: (keys, digest, n_left, n_right).

    Both sides are reduced to (key, digest) counts by one aggregation over
    their union, so identical copies of a row never meet in one task.

    The comparison is exact. ``screen`` asks for a cheaper one that can miss
    rows: they are first summed up in that many hash ranges, and only ranges
    whose sums differ are compared, so differences whose 64-bit hashes add up
    alike on both sides of a range stay unseen. It reads both tables twice but
    shuffles ``screen`` rows per task instead of every row. Range numbers are
    broadcast only as far as the engine's size check allows.
    """
    columns = list(columns or left.columns)
    used = list(dict.fromkeys([*keys, *columns]))
    sides = left.select(*used, F.lit(1).alias("_side")).unionByName(right.select(*used, F.lit(-1).alias("_side")))
    if screen:
        # NULL flags are hashed along: a NULL value alone leaves a hash as it was.
        row_hash = F.xxhash64(*used, *[F.col(c).isNull() for c in used])
        hashed = sides.withColumn("_hash", row_hash).withColumn("_range", F.pmod("_hash", F.lit(screen)))
        high, low = fn.hash_halves(F.col("_hash"))
        differing = (
            hashed.groupBy("_range")
            .agg(F.sum("_side").alias("_n"), F.sum(high * F.col("_side")).alias("_h"), F.sum(low * F.col("_side")).alias("_w"))
            .filter((F.col("_n") != 0) | (F.col("_h") != 0) | (F.col("_w") != 0))
        )
        sides = hashed.join(differing.select("_range"), ["_range"], "left_semi")
    return (
        sides.select(*keys, fn.row_digest(columns).alias("row_digest"), "_side")
        .groupBy(*keys, "row_digest")
        .agg(F.count_if(F.col("_side") == 1).alias("n_left"), F.count_if(F.col("_side") == -1).alias("n_right"))
        .filter(F.col("n_left") != F.col("n_right"))
    )


_ENTRY = T.StructType(
    [
        T.StructField("row_count", T.LongType()),
        T.StructField("pk", T.StringType()),
        T.StructField("pk_distinct", T.LongType()),
        T.StructField("pk_nulls", T.LongType()),
    ]
)
MANIFEST_JSON = T.StructType(
    [
        T.StructField("generated", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("tables", T.MapType(T.StringType(), _ENTRY)),
    ]
)


def read_manifest_json(spark, path: str) -> DataFrame:
    """A stored JSON manifest (``tables`` maps a name to its counts) as manifest rows."""
    return (
        spark.read.schema(MANIFEST_JSON)
        .json(path, multiLine=True)
        .select(F.explode("tables").alias("table_name", "_e"))
        .select(
            "table_name",
            F.col("_e.row_count").alias("row_count"),
            F.col("_e.pk_distinct").alias("key_distinct"),
            F.col("_e.pk_nulls").alias("key_nulls"),
            F.lit(None).cast("timestamp_ntz").alias("max_ts"),
        )
    )


def manifest_document(rows: DataFrame, source: str, generated: str, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Manifest rows folded into one JSON-ready row; there is one entry per table."""
    names = F.create_map(*[F.lit(x) for t, k in keys.items() for x in (t, "+".join(k))])
    entry = F.struct(
        F.col("table_name"),
        F.struct(
            F.col("row_count"),
            names[F.col("table_name")].alias("pk"),
            F.col("key_distinct").alias("pk_distinct"),
            F.col("key_nulls").alias("pk_nulls"),
        ),
    )
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("tables")).select(
        F.lit(generated).alias("generated"), F.lit(source).alias("source"), "tables"
    )
