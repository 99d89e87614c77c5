"""Typed header-CSV scans, audit columns, layer scans and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import cast_failed, row_digest
from .registry import INGESTION_DATE, INGESTION_TS, TYPES_BY_PREFIX, TableSpec, declared_types

CORRUPT = "_corrupt_record"
#: Where a row stood in what was landed; sorts as the lines did.
SOURCE_LINE = "source_line"
AUDIT_COLUMNS = (INGESTION_TS, INGESTION_DATE, "source_file", "batch_id", "env")


def header_schema(spark: SparkSession, path: str, types: Mapping[str, str]) -> T.StructType:
    """Schema from the header line only: declared types where known, then those of a name's prefix, text elsewhere.

    Reads one line, where type inference would read the whole input and could
    give another answer for each batch.
    """
    header = spark.read.option("header", True).csv(path).columns
    by_name = {name.lower(): data_type for name, data_type in types.items()}

    def type_of(name: str) -> str:
        by_prefix = (t for prefix, t in TYPES_BY_PREFIX.items() if name.upper().startswith(prefix))
        return by_name.get(name.lower()) or next(by_prefix, "string")

    return T.StructType.fromDDL(", ".join(f"`{name.replace('`', '``')}` {type_of(name)}" for name in header))


def read_csv(spark: SparkSession, path: str, types: Mapping[str, str] | None = None, *,
             schema: T.StructType | None = None, infer: bool = False, keep_corrupt: bool = True) -> DataFrame:
    """Header CSV with known types. A cell that does not parse is NULL and the
    line is kept in ``_corrupt_record``. ``infer=True`` is for exploration."""
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    schema = schema or header_schema(spark, path, types or {})
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # every file's header must name these columns, in this order
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def with_source_line(df: DataFrame, name: str = SOURCE_LINE) -> DataFrame:
    """``df``, a scan of files, with each row's place in them: file, start of its block, place in the block's scan.

    Blocks of a file are read in order of their start and one task reads a block from its first row to its last, so these places sort
    as the rows stand in the files, whichever way the scan is split. Files sort by name. To be taken right
    on the scan, before anything is shuffled; nothing is read twice for it.
    """
    own = df.metadataColumn("_metadata")
    return df.withColumn(name, F.struct(own["file_name"].alias("file"), own["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("place")))


def utc(moment: datetime | str) -> datetime:
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def tag_audit(df: DataFrame, *, ingestion_ts: datetime | str, batch_id: str, env: str,
              source_file: str | Column | None = None) -> DataFrame:
    """Add the five audit columns. The date is the UTC date of the timestamp.

    Without ``source_file`` each row carries the name of the file it came from.
    """
    moment = utc(ingestion_ts)
    if source_file is None:
        source_file = F.col("_metadata.file_name")
    return df.withColumns(
        {
            INGESTION_TS: F.lit(moment.isoformat()).cast("timestamp"),
            INGESTION_DATE: F.lit(moment.date().isoformat()).cast("date"),
            "source_file": source_file if isinstance(source_file, Column) else F.lit(source_file),
            "batch_id": F.lit(batch_id),
            "env": F.lit(env),
        }
    )


def scan_source(spark: SparkSession, landing_dir: str, spec: TableSpec, *, ingestion_ts: datetime | str,
                batch_id: str, env: str) -> DataFrame:
    """One landed file (or folder of files) of a batch, typed, with its rows' places and tagged."""
    df = with_source_line(read_csv(spark, f"{landing_dir}/{spec.file_name}", declared_types(spec)))
    return tag_audit(df, ingestion_ts=ingestion_ts, batch_id=batch_id, env=env, source_file=spec.file_name)


def scan_layer(spark: SparkSession, path: str, *, batch_ids: Sequence[str] | None = None,
               since: str | None = None) -> DataFrame:
    """Layer table by path; batch and date filters prune its partition folders.

    Batch names are read as the text they are, also where they look like numbers.
    """
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == "batch_id" else f for f in found.fields]
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    if since is not None:
        df = df.filter(F.col(INGESTION_DATE) >= F.lit(since).cast("date"))
    if batch_ids is not None:
        df = df.filter(F.col("batch_id").isin(*batch_ids))
    return df


def sample_limit(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``; reproducible, and each task keeps at most ``n``."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def stratified_sample(df: DataFrame, key: str, stratum: str, fractions: Mapping[object, float] | float,
                      seed: int = 42) -> DataFrame:
    """Rows whose hashed key falls under their stratum's fraction; a pure filter.

    The first eight hex digits of ``md5(seed|key)`` are uniform and stay the
    same for a key in every run and engine, so each stratum keeps its share.
    ``fractions`` is one share for every stratum or a share per value; rows of
    a stratum without a share are left out.
    """
    def mark(fraction: float) -> str:
        return format(min(int(round(fraction * 16**8)), 16**8), "09x")

    ticket = F.concat(F.lit("0"), F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), 1, 8))
    if isinstance(fractions, Mapping):
        bound = F.lit(mark(0.0))
        for value, fraction in fractions.items():
            bound = F.when(F.col(stratum).eqNullSafe(F.lit(value)), F.lit(mark(fraction))).otherwise(bound)
    else:
        bound = F.lit(mark(fractions))
    return df.filter(ticket < bound)


def stratified_sample_exact(df: DataFrame, key: str, stratum: str, fractions: Mapping[object, float] | float, seed: int = 42) -> DataFrame:
    """As ``stratified_sample``, but of a stratum's n rows exactly floor(n fraction + 0.5): those with the smallest hashes of their keys.

    Rows are first counted by stratum and the first four digits of the hash. All rows below the digits at which a stratum's share is
    reached are taken, and of the rows with those digits, one in 65,536, the smallest; only these are ranked, so no
    stratum is gathered. Rows of one key follow a digest of all columns; NULL is a stratum like any other.
    """
    ticket = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    if isinstance(fractions, Mapping):
        share = F.lit(0.0)
        for value, fraction in fractions.items():
            share = F.when(F.col("_stratum").eqNullSafe(F.lit(value)), F.lit(float(fraction))).otherwise(share)
    else:
        share = F.lit(float(fractions))
    rows = df.withColumns({"_ticket": ticket, "_head": F.substring(ticket, 1, 4), "_stratum": F.col(stratum)})
    counts = rows.groupBy("_stratum", "_head").agg(F.count(F.lit(1)).alias("_n"))
    whole, ahead = Window.partitionBy("_stratum"), Window.partitionBy("_stratum").orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.floor(F.sum("_n").over(whole) * share + 0.5)
    cuts = counts.select("_stratum", "_head", "_n", wanted.alias("_wanted"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead")).filter(
        (F.col("_ahead") < F.col("_wanted")) & (F.col("_ahead") + F.col("_n") >= F.col("_wanted")))
    cuts = cuts.select(F.col("_stratum").alias("_of"), F.col("_head").alias("_cut"), (F.col("_wanted") - F.col("_ahead")).alias("_left"))
    near = rows.join(cuts, F.col("_stratum").eqNullSafe(F.col("_of"))).filter(F.col("_head") <= F.col("_cut"))
    below = near.filter(F.col("_head") < F.col("_cut"))
    order = Window.partitionBy("_of").orderBy("_ticket", key, row_digest(df.columns))
    edge = near.filter(F.col("_head") == F.col("_cut")).withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= F.col("_left"))
    return below.select(*df.columns).unionByName(edge.select(*df.columns))


# --- schema drift ---------------------------------------------------------------------------------


def compare_schemas(expected: Mapping[str, str] | T.StructType,
                    arriving: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """(column, expected type, arriving type, status) per column of either side.

    Statuses: ``same``, ``retyped``, ``missing`` (expected, not arriving), ``unexpected``.
    """
    if isinstance(expected, T.StructType):
        expected = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in arriving.fields}

    def status(name: str) -> str:
        if name not in have:
            return "missing"
        if name not in expected:
            return "unexpected"
        return "same" if have[name] == expected[name] else "retyped"

    return [(n, expected.get(n), have.get(n), status(n)) for n in dict.fromkeys([*expected, *have])]


def schema_drift(df: DataFrame, expected: Mapping[str, str] | T.StructType) -> DataFrame:
    """``compare_schemas`` with counts: values present, and values that would not convert.

    All columns are counted in one pass over the arriving data.
    """
    counts, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, (name, want, have, status) in enumerate(compare_schemas(expected, df.schema)):
        present = unconvertible = F.lit(0)
        if have is not None:
            counts.append(F.count(F.col(name)).alias(f"_n{i}"))
            present = F.col(f"_n{i}")
        if status == "retyped":
            counts.append(F.count_if(cast_failed(name, want)).alias(f"_b{i}"))
            unconvertible = F.col(f"_b{i}")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(want).cast("string").alias("expected_type"),
                F.lit(have).cast("string").alias("arriving_type"),
                F.lit(status).alias("status"),
                present.cast("bigint").alias("present_values"),
                unconvertible.cast("bigint").alias("unconvertible_values"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def require_no_drift(expected: Mapping[str, str] | T.StructType, arriving: T.StructType, name: str) -> None:
    """Refuse a write whose columns differ from the table's; looks at schemas only."""
    drift = [row for row in compare_schemas(expected, arriving) if row[3] != "same"]
    if drift:
        raise ValueError(f"{name}: schema drift before write: {drift}")
