"""Writers. Published tables change version in one metadata step, after their gates.

A published table is an external Parquet table. Each run writes a new directory
next to the old one, the gates read that staged directory, and only then does
``ALTER TABLE ... SET LOCATION`` point readers at it. A job that dies at any
earlier point leaves the last good version in place. Staged directories are
written tables in the warehouse, so no step depends on executor-local state.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as fn
from ..operators import quality as q
from ..operators import scd2
from ..operators.upsert import accepted_updates, signed_changes, upsert_parts

GateList = Callable[[DataFrame], Sequence[q.Gate]]

_PARTITIONS_PER_STATEMENT = 500
_CLOSES_MISSING = "sedimenta.closes_missing"
_VERSION, _REFLECTS = "sedimenta.version", "sedimenta.reflects"
_SAFE_PARTITION = re.compile(r"[A-Za-z0-9_.\-]+")


@dataclass(frozen=True)
class Buckets:
    """Bucketing of a published table: joins and group-bys on ``keys`` read it unshuffled."""

    keys: tuple[str, ...]
    count: int


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _new_location(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name.split('.')[-1]}/v_{uuid.uuid4().hex}"


def shared_work_dir(spark: SparkSession, root: str) -> str:
    """Folder for intermediate tables: the cluster's shared checkpoint folder if it names one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{root.rstrip('/')}/_work"
    return f"{base.rstrip('/')}/work_{uuid.uuid4().hex}"


# --- plain writers --------------------------------------------------------------------------------


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` contains."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON result as part files, one per task."""
    df.write.mode("overwrite").json(path)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition_by: Sequence[str] = (), buckets: Buckets | None = None) -> None:
    """External table with fixed columns, created only if it does not exist."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if buckets:
        keys = ", ".join(f"`{k}`" for k in buckets.keys)
        ddl += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets.count} BUCKETS"
    spark.sql(f"{ddl} LOCATION '{location}'")


# --- stage, gate, swap ----------------------------------------------------------------------------


def _check_columns(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    have = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
    got = {f.name.lower(): f.dataType for f in df.schema.fields}
    if have != got:
        drift = sorted({c for c, _ in set(have.items()) ^ set(got.items())})
        raise ValueError(f"{name}: schema evolution is off; differing columns: {drift}")
    return df.select(*spark.table(name).columns)


def _stored_layout(spark: SparkSession, name: str) -> tuple[list[str], Buckets | None]:
    """(partition columns, bucketing) a published table was created with."""
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").collect()}
    if "Num Buckets" not in detail:
        return partitions, None
    keys = tuple(k.strip(" `") for k in detail["Bucket Columns"].strip("[]").split(","))
    return partitions, Buckets(keys, int(detail["Num Buckets"]))


@contextmanager
def _staged(spark: SparkSession, df: DataFrame, name: str, location: str, partition_by: Sequence[str] = (),
            buckets: Buckets | None = None, clustered: bool = False):
    """Write ``df`` to ``location`` and yield it as read back from there.

    ``clustered`` says that ``df`` already has few buckets per task, so it need
    not be shuffled to keep the number of files down.
    """
    if buckets is None:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(location)
        yield spark.read.schema(df.schema).parquet(location)
        return
    handle = f"{name.replace('.', '_')}__staged_{uuid.uuid4().hex[:12]}"
    writer = (
        (df if clustered else df.repartition(buckets.count, *buckets.keys))
        .write.format("parquet")
        .bucketBy(buckets.count, *buckets.keys)
        .sortBy(*buckets.keys)
        .option("path", location)
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(handle)
    try:
        yield spark.table(handle)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS `{handle}`")  # external: the files stay


def publish(spark: SparkSession, name: str, df: DataFrame, root: str, *, gates: GateList | None = None,
            buckets: Buckets | None = None, clustered: bool = False) -> dict[str, int]:
    """Replace a table's content with ``df`` (or create the table), if the gates pass."""
    exists = spark.catalog.tableExists(name)
    if exists:
        df = _check_columns(spark, name, df)
        partitions, stored = _stored_layout(spark, name)
        if partitions:
            raise ValueError(f"{name} is partitioned by {partitions}; publish its partitions")
        if buckets is not None and buckets != stored:
            raise ValueError(f"{name} was created with {stored}, not {buckets}")
        clustered, buckets = clustered and buckets is not None, stored
    location = _new_location(root, name)
    with _staged(spark, df, name, location, buckets=buckets, clustered=clustered) as staged:
        counts = q.enforce(gates(staged)) if gates else {}
        schema = staged.schema
    if exists:
        _note_change(spark, name)
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        create_table(spark, name, schema, location, buckets=buckets)
    return counts


def publish_partitions(spark: SparkSession, name: str, df: DataFrame, partition_by: str, root: str, *,
                       gates: GateList | None = None, last: str | None = None, rebalance: bool = False,
                       emptied: Sequence[str] = ()) -> dict[str, int]:
    """Replace only the partitions that ``df`` contains; the others are not read or written.

    Each partition changes in one metadata step; new ones are added many to a statement. ``last`` names the partition
    to switch after all others. ``emptied`` names partitions that the run covers: one that ``df`` has no row of is removed, after all
    others have been switched. ``rebalance`` gathers the rows of a partition
    before they are written, into as many even tasks as its size calls for;
    without it every task writes a file into every partition it meets.
    """
    if not isinstance(df.schema[partition_by].dataType, T.StringType):
        raise TypeError(f"partition column {partition_by} must be a string")
    exists = spark.catalog.tableExists(name)
    if exists:
        df = _check_columns(spark, name, df)
        if _stored_layout(spark, name) != ([partition_by], None):
            raise ValueError(f"{name} is not partitioned by {partition_by} alone")
    if rebalance:
        df = df.hint("rebalance", partition_by)
    location = _new_location(root, name)
    with _staged(spark, df, name, location, [partition_by]) as staged:
        counts = q.enforce(gates(staged)) if gates else {}
        values = [r[0] for r in staged.select(partition_by).distinct().collect()]  # one row per partition
        schema = staged.schema
    unsafe = [v for v in values if v is None or not _SAFE_PARTITION.fullmatch(v)]
    if unsafe:
        raise ValueError(f"{name}: partition values must be plain names, got {unsafe[:5]}")
    if not exists:
        create_table(spark, name, schema, f"{location}_base", [partition_by])
    else:
        _note_change(spark, name)
    known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {_quoted(name)}").collect()}  # one row per partition

    def at(value: str) -> str:
        return f"PARTITION (`{partition_by}` = '{value}')"

    added = [v for v in sorted(values) if v not in known and v != last]
    for begin in range(0, len(added), _PARTITIONS_PER_STATEMENT):
        some = " ".join(f"{at(v)} LOCATION '{location}/{partition_by}={v}'" for v in added[begin: begin + _PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD IF NOT EXISTS {some}")
    for value in sorted((v for v in values if v in known or v == last), key=lambda v: (v == last, v)):
        where = f"'{location}/{partition_by}={value}'"
        if value in known:
            spark.sql(f"ALTER TABLE {_quoted(name)} {at(value)} SET LOCATION {where}")
        else:
            spark.sql(f"ALTER TABLE {_quoted(name)} ADD {at(value)} LOCATION {where}")
    for value in sorted((set(emptied) & known) - set(values)):
        spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS {at(value)}")  # external: the files stay
    spark.catalog.refreshTable(name)
    return counts


# --- upserts --------------------------------------------------------------------------------------


def key_gates(name: str, keys: Sequence[str]) -> GateList:
    return lambda staged: [
        q.Gate(f"{name}_unique", q.duplicate_keys(staged, keys)),
        q.Gate(f"{name}_key_not_null", q.null_keys(staged, keys)),
    ]


def publish_upsert(spark: SparkSession, name: str, updates: DataFrame, keys: Sequence[str], root: str, *,
                   order: Sequence[str] | None = None, gates: GateList | None = None,
                   buckets: Buckets | None = None, partition_by: str | None = None, changes: Sequence[str] = ()) -> dict[str, int]:
    """Upsert ``updates`` into a published table, creating it on the first run.

    The updates are computed once, into the shared work folder, for their gates, the pruning and the write all read them. They
    must be unique on non-NULL ``keys``; the rows that stay were
    gated when they came and share no key with them. With ``order`` a late batch
    cannot replace newer rows: which updates take effect is decided once too.
    With ``partition_by``, a string column that is a function of the key,
    only the partitions the updates fall into are read, joined and rewritten;
    an interrupted run is completed by running it again.

    With ``changes`` these columns of the rows replaced and added are kept beside the tables, as a step from one version of the
    table to the next (``changes_since``).
    """
    if partition_by is not None and buckets is not None:
        raise ValueError("a table is laid out in key ranges or in buckets, not both")
    target = spark.table(name) if spark.catalog.tableExists(name) else None
    if target is not None and set(target.columns) != set(updates.columns):
        raise ValueError(f"{name}: schema evolution is off; differing columns: {sorted(set(target.columns) ^ set(updates.columns))}")
    work = shared_work_dir(spark, root)
    try:
        updates.write.parquet(f"{work}/updates")
        updates = spark.read.schema(updates.schema).parquet(f"{work}/updates")
        counts = q.enforce(key_gates(name, keys)(updates))
        if target is not None and partition_by is not None:
            target = touched_partitions(target, updates, partition_by)
        kept = None
        if target is not None and order is not None:
            accepted = accepted_updates(target, updates, keys, order)
            accepted.write.parquet(f"{work}/accepted")
            updates = spark.read.schema(accepted.schema).parquet(f"{work}/accepted")
            if partition_by is not None:
                target = touched_partitions(spark.table(name), updates, partition_by)
        if target is not None:
            kept, updates = upsert_parts(target, updates, keys)
        if not changes:
            return counts | _publish_merged(spark, name, kept, updates, root, gates, buckets, partition_by)
        old, new = table_version(spark, name) or _FIRST, uuid.uuid4().hex
        changed = signed_changes(target, updates, keys, [c for c in changes if c in updates.columns])
        changed.write.parquet(f"{_changes_dir(root, name)}/{old}__{new}")
        counts |= _publish_merged(spark, name, kept, updates, root, gates, buckets, partition_by)
        _set_version(spark, name, new)
        return counts
    finally:
        drop_work_dir(spark, work)


# A table whose changes are kept has a version of its own, set when a publish has ended; while one is under way it has none that
# anything could have been built from. So whatever is interrupted, or written without keeping changes, breaks the chain of versions.
_FIRST, _CHANGING = "none", "changing"


def _changes_dir(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_changes/{name.split('.')[-1]}"


def table_version(spark: SparkSession, name: str) -> str | None:
    """The version of a published table whose changes are kept."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").filter(F.col("key") == _VERSION).collect()
    return found[0]["value"] if found else None


def _set_version(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('{_VERSION}' = '{version}')")


def _note_change(spark: SparkSession, name: str) -> None:
    if table_version(spark, name) is not None:
        _set_version(spark, name, _CHANGING)


def changes_since(spark: SparkSession, name: str, root: str, version: str) -> tuple[list[str], str] | None:
    """Folders of the signed changes that lead from a version of a table to its present one, and that one; None if they are not all known.

    The rows of a folder have the columns asked for when they were kept, and ``sign``.
    """
    present = table_version(spark, name)
    if present is None or present == _CHANGING or version == _CHANGING:
        return None
    top = spark._jvm.org.apache.hadoop.fs.Path(_changes_dir(root, name))
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    steps: dict[str, list[tuple[str, str]]] = {}
    for status in system.listStatus(top) if system.exists(top) else []:  # one folder per upsert
        path = status.getPath().toString()
        old, _, new = path.rsplit("/", 1)[1].partition("__")
        steps.setdefault(old, []).append((new, path))
    found: list[str] = []
    while version != present:
        following = steps.get(version, [])
        if len(following) != 1:  # two: an upsert was interrupted after it had kept its changes
            return None
        version, path = following[0]
        found.append(path)
    return found, present


def reflects(spark: SparkSession, name: str) -> str | None:
    """The version of its source that a derived table was last brought up to."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").filter(F.col("key") == _REFLECTS).collect()
    return found[0]["value"] or None if found else None


def note_reflects(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('{_REFLECTS}' = '{version}')")


def forget_changes(spark: SparkSession, name: str, root: str) -> None:
    """Drop the kept changes of a table, once all that is built from it is up to date."""
    drop_folders(spark, f"{_changes_dir(root, name)}/*__*")


def touched_partitions(target: DataFrame, updates: DataFrame, partition_by: str) -> DataFrame:
    """Rows of the partitions that ``updates`` fall into; the scan prunes the others at run time, when it knows them.

    The values go to the executors as a semi-join, never to the driver's plan. They are broadcast, which pruning at run time
    needs: one short name for each folder that the update will write.
    """
    # Pruning at run time is planned only behind a condition that looks selective; every value meets this one.
    values = updates.select(partition_by).filter(F.col(partition_by) >= "").distinct()
    return target.join(F.broadcast(values), [partition_by], "left_semi").select(*target.columns)


def _publish_merged(spark: SparkSession, name: str, kept: DataFrame | None, updates: DataFrame, root: str, gates: GateList | None,
                    buckets: Buckets | None, partition_by: str | None) -> dict[str, int]:
    if buckets is not None:
        # Rows kept from the target are read bucket by bucket; with the updates
        # laid out alike, each task writes one bucket and nothing else moves.
        updates = updates.repartition(buckets.count, *buckets.keys)
    merged = updates if kept is None else kept.unionByName(updates)
    if partition_by is not None:
        return publish_partitions(spark, name, merged, partition_by, root, gates=gates, rebalance=True)
    return publish(spark, name, merged, root, gates=gates, buckets=buckets, clustered=True)


def remove_superseded(spark: SparkSession, names: Sequence[str], root: str, older_than_s: float) -> list[str]:
    """Delete version folders of published tables that no table or partition refers to and that are older than an age.

    What is live comes from the catalog: the table's own location and every file the session would read for it, so key
    ranges and closed slices that live in old folders stay. The age must exceed the longest run and the longest query. Folders
    without data files are left. Returns the folders removed.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf, now = spark._jsc.hadoopConfiguration(), time.time()
    removed = []
    for name in names:
        spark.catalog.refreshTable(name)
        detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").collect()}
        live = {part for path in [*spark.table(name).inputFiles(), detail["Location"]] for part in path.split("/") if part.startswith("v_")}
        base = hadoop.Path(f"{root.rstrip('/')}/{name.split('.')[-1]}")
        system = base.getFileSystem(conf)
        for status in system.listStatus(base) if system.exists(base) else []:
            folder = status.getPath()
            version = folder.getName().removesuffix("_base")
            aged = now - status.getModificationTime() / 1000 > older_than_s
            if version.startswith("v_") and version not in live and aged and system.getContentSummary(folder).getFileCount():
                system.delete(folder, True)
                removed.append(folder.toString())
    return removed


@dataclass(frozen=True)
class Layout:
    """How a published table is laid out: bucketed on its key, or cut into ranges of a numeric key.

    Buckets spare later joins a shuffle; ranges spare an upsert from rewriting
    key ranges it does not touch. ``range_width`` keys share a partition.
    """

    buckets: Buckets | None = None
    range_key: str | None = None
    range_width: int = 0
    column: str = "key_range"

    def apply(self, df: DataFrame) -> DataFrame:
        if self.range_key is None:
            return df
        key = f"`{self.range_key}`"
        number = F.expr(f"({key} - pmod({key}, {self.range_width})) DIV {self.range_width}")  # exact for large keys
        return df.withColumn(self.column, F.concat(F.lit("r"), number.cast("string")))

    @property
    def partition_by(self) -> str | None:
        return self.column if self.range_key else None


def drop_folders(spark: SparkSession, pattern: str, keep: str = "") -> None:
    """Remove the folders that a glob pattern matches, but for those whose path holds ``keep``."""
    found = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.globStatus(found) or []:
        if not keep or keep not in f"{status.getPath().toString()}/":
            system.delete(status.getPath(), True)


def drop_work_dir(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table made under ``shared_work_dir``; anything else is refused."""
    if not path.rsplit("/", 1)[-1].startswith("work_"):
        raise ValueError(f"not a work folder: {path}")
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


# --- versioned dimensions -------------------------------------------------------------------------


def dimension_gates(src: DataFrame, spec: scd2.DimensionSpec = scd2.DIM_APPLICANT, *, absences: bool = False) -> GateList:
    """Exactly one current version per source entity, and sound intervals (with gaps where ``absences`` were closed)."""
    return lambda staged: [
        q.Gate("one_current_too_many", q.multiple_current(staged, spec), code=q.MULTIPLE_CURRENT),
        q.Gate("one_current_none", q.no_current(staged, src, spec), code=q.NO_CURRENT),
        q.Gate("intervals", scd2.interval_violations(staged, spec, absences=absences)),
    ]


def closes_missing(spark: SparkSession, name: str) -> bool:
    """Whether a run has ever closed entities of this dimension because they were missing; their histories may have gaps."""
    found = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").filter(F.col("key") == _CLOSES_MISSING).collect()
    return bool(found) and found[0]["value"] == "true"


def _note_closing(spark: SparkSession, name: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('{_CLOSES_MISSING}' = 'true')")


def _require_sound(src: DataFrame, current: DataFrame | None, spec: scd2.DimensionSpec) -> None:
    """Source keys present and unique; the stored versions a run reads all say whether they are current."""
    per_key = src.groupBy(spec.key).agg(F.count(F.lit(1)).alias("n"))
    gates = [
        q.Gate("source_unique", per_key.filter(F.col(spec.key).isNotNull() & (F.col("n") > 1)), code=q.MULTIPLE_CURRENT),
        q.Gate("source_key_not_null", per_key.filter(F.col(spec.key).isNull())),
    ]
    if current is not None:
        gates.append(q.Gate("state_known", scd2.unknown_state(current, spec)))
    q.enforce(gates)


@contextmanager
def _narrow_source(spark: SparkSession, src: DataFrame, root: str, spec: scd2.DimensionSpec):
    """The source columns a dimension reads, written once: its gates and the join do not each run the plan behind it."""
    work = shared_work_dir(spark, root)
    narrow = src.select(*spec.source_columns)
    try:
        narrow.write.parquet(work)
        yield spark.read.schema(narrow.schema).parquet(work)
    finally:
        drop_work_dir(spark, work)


def publish_dimension(spark: SparkSession, name: str, src: DataFrame, as_of: str | datetime, root: str,
                      spec: scd2.DimensionSpec = scd2.DIM_APPLICANT, *, close_missing: bool = False,
                      buckets: Buckets | None = None) -> dict[str, int]:
    """Apply a source to a dimension and publish it whole, in one atomic step."""
    exists = spark.catalog.tableExists(name)
    with _narrow_source(spark, src, root, spec) as src:
        _require_sound(src, spark.table(name) if exists else None, spec)
        if exists:
            if close_missing:
                _note_closing(spark, name)
            rows = scd2.apply_scd2(spark.table(name), src, as_of, spec, close_missing=close_missing)
        else:
            rows = scd2.first_versions(src, as_of, spec)
        gates = dimension_gates(src, spec, absences=exists and closes_missing(spark, name))
        # A bucketed dimension is joined and passed through bucket by bucket.
        return publish(spark, name, rows, root, gates=gates, buckets=buckets, clustered=exists)


def publish_dimension_sliced(spark: SparkSession, name: str, src: DataFrame, as_of: str | datetime, root: str,
                             spec: scd2.DimensionSpec = scd2.DIM_APPLICANT, *,
                             close_missing: bool = False) -> dict[str, int]:
    """Apply a source at a cost that follows current rows, not all history.

    The table is partitioned into ``current`` and one closed slice per
    ``as_of``; older closed slices are neither read nor written. The closed
    slice is published first, so a run that dies between the two steps leaves
    extra closed rows but exactly one current row per entity. Its new content
    is what it already held plus this run's closures, unique on (entity,
    start), so running again at the same ``as_of`` repairs it.
    """
    closed_slice = f"closed_{fn.instant_label(as_of)}"
    exists = spark.catalog.tableExists(name)
    with _narrow_source(spark, src, root, spec) as src:
        if exists:
            dim = spark.table(name)
            _require_sound(src, dim.filter(F.col(scd2.SLICE_COLUMN) == scd2.CURRENT_SLICE), spec)
            if close_missing:
                _note_closing(spark, name)
            rows = scd2.version_changes(dim, src, as_of, spec, close_missing=close_missing)
        else:
            _require_sound(src, None, spec)
            rows = scd2.first_versions(src, as_of, spec)
        slice_of = F.when(F.col(spec.current), F.lit(scd2.CURRENT_SLICE)).otherwise(F.lit(closed_slice))
        rows = rows.withColumn(scd2.SLICE_COLUMN, slice_of)
        slices = {r[0] for r in spark.sql(f"SHOW PARTITIONS {_quoted(name)}").collect()} if exists else set()
        if f"{scd2.SLICE_COLUMN}={closed_slice}" in slices:
            held = dim.filter(F.col(scd2.SLICE_COLUMN) == closed_slice)
            closing = rows.filter(~F.col(spec.current)).select(spec.key, spec.start)
            rows = rows.unionByName(held.join(closing, [spec.key, spec.start], "left_anti"))

        def checks(staged: DataFrame) -> list[q.Gate]:
            closed = staged.filter(~F.col(spec.current))
            return [
                q.Gate("one_current_too_many", q.multiple_current(staged, spec), code=q.MULTIPLE_CURRENT),
                q.Gate("one_current_none", q.no_current(staged, src, spec), code=q.NO_CURRENT),
                q.Gate("closed_unique", q.duplicate_keys(closed, [spec.key, spec.start])),
                q.Gate("closed_interval", closed.filter(~(F.col(spec.end) > F.col(spec.start)))),
            ]

        # Where every current row closes, no current row is left to replace the slice.
        return publish_partitions(spark, name, rows, scd2.SLICE_COLUMN, root, gates=checks, last=scd2.CURRENT_SLICE,
                                  emptied=[scd2.CURRENT_SLICE] if exists else [])
