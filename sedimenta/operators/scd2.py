"""Type-2 dimension history: expire, insert, apply, join, and interval checks.

A version is valid on the half-open interval ``[start_date, end_date)``; an
open version has a NULL ``end_date``. One ``as_of`` closes the old version and
opens the new one, so consecutive versions touch without a gap.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fn

# The four attributes whose change opens a new applicant version.
TRACKED_ATTRIBUTES = ("name_income_type", "name_education_type", "name_family_status", "cnt_children")


@dataclass(frozen=True)
class DimensionSpec:
    """Shape of a versioned dimension. ``carried`` is stored but not compared."""

    key: str = "applicant_id"
    tracked: tuple[str, ...] = TRACKED_ATTRIBUTES
    carried: tuple[str, ...] = ("SK_ID_CURR",)
    surrogate: str = "applicant_sk"
    start: str = "start_date"
    end: str = "end_date"
    current: str = "is_current"

    @property
    def source_columns(self) -> list[str]:
        return [self.key, *self.carried, *self.tracked]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, *self.source_columns, self.start, self.end, self.current]


DIM_APPLICANT = DimensionSpec()


# A sliced dimension is partitioned by this column: one slice of current rows, and closed ones per run.
SLICE_COLUMN, CURRENT_SLICE = "version_slice", "current"


def current_rows(dim: DataFrame, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Current versions; of a sliced dimension only the current slice is read."""
    rows = dim.filter(F.col(spec.current))
    return rows.filter(F.col(SLICE_COLUMN) == CURRENT_SLICE) if SLICE_COLUMN in dim.columns else rows


def _sides(dim: DataFrame, src: DataFrame, spec: DimensionSpec) -> tuple[DataFrame, DataFrame]:
    return current_rows(dim, spec).alias("cur"), src.select(*spec.source_columns).alias("src")


def _same_key(spec: DimensionSpec) -> Column:
    return F.col(f"cur.{spec.key}") == F.col(f"src.{spec.key}")


def changed_rows(dim: DataFrame, src: DataFrame, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Key of every matched pair with the NULL-safe verdict ``changed``."""
    cur, new = _sides(dim, src, spec)
    return cur.join(new, _same_key(spec), "inner").select(
        F.col(f"cur.{spec.key}").alias(spec.key), fn.any_changed("cur", "src", list(spec.tracked)).alias("changed")
    )


def expiring_versions(dim: DataFrame, src: DataFrame, as_of: str | datetime,
                      spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Current versions that a run at ``as_of`` closes, as they will be stored."""
    cur, new = _sides(dim, src, spec)
    closed = {spec.end: fn.instant(as_of), spec.current: F.lit(False)}
    return (
        cur.join(new, _same_key(spec), "inner")
        .filter(fn.any_changed("cur", "src", list(spec.tracked)))
        .select(*[closed.get(c, F.col(f"cur.{c}")).alias(c) for c in spec.columns])
    )


def opening_versions(dim: DataFrame, src: DataFrame, as_of: str | datetime,
                     spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """New version of every source key that has no current row in ``dim``.

    Run on a dimension whose changed versions are already closed, this covers
    brand-new and just-expired keys alike.
    """
    cur, new = _sides(dim, src, spec)
    opened = _opened("src", as_of, spec)
    return new.join(cur, _same_key(spec), "left_anti").select(*[opened[c].alias(c) for c in spec.columns])


def _opened(side: str, as_of: str | datetime, spec: DimensionSpec) -> dict[str, Column]:
    at = fn.instant(as_of)
    return {
        **{c: F.col(f"{side}.{c}") for c in spec.source_columns},
        spec.surrogate: fn.version_key(F.col(f"{side}.{spec.key}"), at),
        spec.start: at,
        spec.end: F.lit(None).cast("timestamp_ntz"),
        spec.current: F.lit(True),
    }


def version_changes(dim: DataFrame, src: DataFrame, as_of: str | datetime, spec: DimensionSpec = DIM_APPLICANT,
                    *, close_missing: bool = False) -> DataFrame:
    """Every current row of ``dim`` after a run, plus the versions that run closed.

    One full-outer join of current rows to the source; each pair emits one or
    two rows. Presence is carried by marker columns, never read off attributes.
    ``src`` must be unique on its key; closed history is not touched or read.
    """
    cur = current_rows(dim, spec).withColumn("_here", F.lit(True)).alias("cur")
    new = src.select(*spec.source_columns, F.lit(True).alias("_there")).alias("src")
    known = F.coalesce(F.col("cur._here"), F.lit(False))
    offered = F.coalesce(F.col("src._there"), F.lit(False))
    changed = known & offered & fn.any_changed("cur", "src", list(spec.tracked))
    closes = (changed | (known & ~offered)) if close_missing else changed
    opens = offered & (~known | changed)

    stored = F.struct(
        *[
            F.when(closes, fn.instant(as_of)).otherwise(F.col(f"cur.{c}")).alias(c)
            if c == spec.end
            else (~closes).alias(c)
            if c == spec.current
            else F.col(f"cur.{c}").alias(c)
            for c in spec.columns
        ]
    )
    opened_cols = _opened("src", as_of, spec)
    opened = F.struct(*[opened_cols[c].alias(c) for c in spec.columns])
    emitted = F.array_compact(F.array(F.when(known, stored), F.when(opens, opened)))
    return cur.join(new, _same_key(spec), "full_outer").select(F.inline(emitted))


def apply_scd2(dim: DataFrame, src: DataFrame, as_of: str | datetime, spec: DimensionSpec = DIM_APPLICANT,
               *, close_missing: bool = False) -> DataFrame:
    """The whole dimension after a run at ``as_of``; history passes through unshuffled.

    A version whose state is NULL counts as history here; the publishing runs refuse such a dimension.
    """
    history = dim.filter(F.col(spec.current).isNull() | ~F.col(spec.current)).select(*spec.columns)
    return history.unionByName(version_changes(dim, src, as_of, spec, close_missing=close_missing))


def first_versions(src: DataFrame, as_of: str | datetime, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """First load: every source key opens one version."""
    opened = _opened("src", as_of, spec)
    return src.alias("src").select(*[opened[c].alias(c) for c in spec.columns])


# --- several versions in one run ------------------------------------------------------------------


def version_chains(statements: DataFrame, at: str, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Every version that a set of statements makes: each says what an entity's attributes are from its moment ``at`` on.

    Of an entity's statements in order of time only those that differ from the one before (NULL-safe) open a version, and a version
    ends where the next begins. Statements of one entity at one moment that agree in the tracked attributes are one; they must
    not contradict each other (``contradictions``). An entity's statements, one per load at most, are ordered in one task.
    """
    told = statements.select(*spec.source_columns, F.col(at).cast("timestamp_ntz").alias("_at"))
    made = _made(spec)
    return _chained(told, [spec.key], spec).select(*[made.get(c, F.col(c)).alias(c) for c in spec.columns])


def _chained(told: DataFrame, by: Sequence[str], spec: DimensionSpec, passing: Column | None = None) -> DataFrame:
    """Statements that differ from the one before among those with the same ``by``, and in ``_end`` the moment of the next such one;
    rows that are ``passing`` stay."""
    order = Window.partitionBy(*by).orderBy("_at", *[F.col(c).asc_nulls_first() for c in (*spec.tracked, *spec.carried)])
    said = F.struct(*[F.struct(F.col(c)) for c in spec.tracked])  # a struct of structs compares NULL-safely
    differs = ~F.col("_told").eqNullSafe(F.col("_before"))
    points = told.withColumn("_told", said).withColumn("_before", F.lag("_told").over(order)).filter(differs if passing is None else passing | differs)
    return points.withColumn("_end", F.lead("_at").over(Window.partitionBy(*by).orderBy("_at")))


def _made(spec: DimensionSpec) -> dict[str, Column]:
    return {
        spec.surrogate: fn.version_key(F.col(spec.key), F.col("_at")),
        spec.start: F.col("_at"),
        spec.end: F.col("_end"),
        spec.current: F.col("_end").isNull(),
    }


def contradictions(statements: DataFrame, at: str, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Entities and moments for which statements disagree, or that lack an entity or a moment."""
    told = F.struct(*[F.struct(F.col(c)) for c in spec.tracked])
    return (
        statements.groupBy(spec.key, F.col(at).alias("at"))
        .agg(F.min(told).alias("_least"), F.max(told).alias("_most"))
        .filter(~F.col("_least").eqNullSafe(F.col("_most")) | F.col(spec.key).isNull() | F.col("at").isNull())
        .select(spec.key, "at")
    )


def late_entities(known: DataFrame, arrivals: DataFrame, at: str, known_at: str, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Keys with an arrival that is not after all that is known of them; ``known`` has a key and a moment."""
    first = arrivals.groupBy(spec.key).agg(F.min(F.col(at).cast("timestamp_ntz")).alias("_first"))
    last = known.groupBy(spec.key).agg(F.max(F.col(known_at).cast("timestamp_ntz")).alias("_last"))
    return first.join(last, [spec.key]).filter(F.col("_first") <= F.col("_last")).select(spec.key)


def apply_arrivals(dim: DataFrame, arrivals: DataFrame, at: str, earlier: DataFrame | None = None,
                   spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """The whole dimension after any number of arrivals per entity, each with a moment of its own.

    Arrivals that are after all their entity has told before continue its chain, as one run of ``apply_scd2`` per moment would, in
    one pass: the current version stands for what was told before. Other entities pass through.
    A late arrival cuts into stored versions, and which neighbour opens again after it depends on statements that opened
    none because they changed nothing. So ``earlier`` holds all statements made before these arrivals (bronze keeps them), with the same
    columns; they are read for entities with a late arrival, which are rebuilt. Any order of arrival then gives the same
    dimension. Without ``earlier`` there must be no late arrival; ``late_entities`` tells. Entities closed because their source no longer
    offered them are not for this operator.
    """
    if earlier is not None:
        return _with_late(dim, arrivals, at, earlier, spec)
    told = arrivals.select(*spec.source_columns, F.col(at).cast("timestamp_ntz").alias("_told_at"))
    touched = told.select(spec.key).distinct()
    history = dim.filter(F.col(spec.current).isNull() | ~F.col(spec.current)).select(*spec.columns)
    current = current_rows(dim, spec)
    untouched = current.join(touched, [spec.key], "left_anti").select(*spec.columns)
    standing = current.join(touched, [spec.key], "left_semi").select(*spec.source_columns, F.col(spec.start).alias("_told_at"))
    return history.unionByName(untouched).unionByName(version_chains(standing.unionByName(told), "_told_at", spec))


_HISTORY, _STANDING, _EARLIER, _ARRIVAL = range(4)


def _with_late(dim: DataFrame, arrivals: DataFrame, at: str, earlier: DataFrame, spec: DimensionSpec) -> DataFrame:
    """``apply_arrivals`` with the statements made before.

    Versions and statements of an entity are brought together once, each input is read once, and what becomes of a row is decided
    there; so a task holds two sorts of its share instead of one for each join of the parts.
    """
    key = F.col(spec.key)
    past = F.col(spec.current).isNull() | ~F.col(spec.current)
    present = F.col(SLICE_COLUMN) == CURRENT_SLICE if SLICE_COLUMN in dim.columns else F.lit(True)
    stored = F.struct(*[F.col(c) for c in spec.columns])
    versions = dim.filter(past | present).select(*spec.source_columns, F.col(spec.start).cast("timestamp_ntz").alias("_at"), F.when(past, _HISTORY).otherwise(_STANDING).alias("_kind"), stored.alias("_stored"))
    nothing = F.lit(None).cast(versions.schema["_stored"].dataType)

    def said(rows: DataFrame, kind: int) -> DataFrame:
        return rows.select(*spec.source_columns, F.col(at).cast("timestamp_ntz").alias("_at"), F.lit(kind).alias("_kind"), nothing.alias("_stored"))

    rows = versions.unionByName(said(earlier, _EARLIER)).unionByName(said(arrivals, _ARRIVAL))
    kind = F.col("_kind")
    # Versions without an entity pass through; they need not meet.
    rows = rows.withColumn("_apart", F.when(key.isNull() & (kind <= _STANDING), F.xxhash64("_stored")).otherwise(F.lit(0).cast("bigint")))
    entity = Window.partitionBy(spec.key, "_apart")
    first, last = F.min(F.when(kind == _ARRIVAL, F.col("_at"))).over(entity), F.max(F.when(kind == _EARLIER, F.col("_at"))).over(entity)
    rows = rows.withColumns({"_first": first, "_last": last, "_touched": F.bool_or(kind == _ARRIVAL).over(entity) & key.isNotNull()})
    late = F.coalesce(F.col("_first") <= F.col("_last"), F.lit(False)) & key.isNotNull()
    passes = ~F.col("_late") & ((kind == _HISTORY) | ((kind == _STANDING) & ~F.col("_touched")))
    tells = (kind == _ARRIVAL) | ((kind == _EARLIER) & F.col("_late")) | ((kind == _STANDING) & F.col("_touched") & ~F.col("_late"))
    rows = rows.withColumn("_late", late).withColumn("_passes", passes).filter(F.col("_passes") | tells).drop("_first", "_last", "_touched", "_late", "_kind")
    made = _made(spec)
    out = _chained(rows, [spec.key, "_apart", "_passes"], spec, F.col("_passes"))
    return out.select(*[F.when(F.col("_passes"), F.col(f"_stored.{c}")).otherwise(made.get(c, F.col(c))).alias(c) for c in spec.columns])


def join_current(fact: DataFrame, dim: DataFrame, attributes: Sequence[str], spec: DimensionSpec = DIM_APPLICANT,
                 how: str = "left") -> DataFrame:
    """Fact rows with attributes of the current version of their entity."""
    return fact.join(current_rows(dim, spec).select(spec.key, *attributes), [spec.key], how)


def join_as_of(fact: DataFrame, dim: DataFrame, at: str, attributes: Sequence[str],
               spec: DimensionSpec = DIM_APPLICANT, how: str = "left", period: str | None = None) -> DataFrame:
    """Fact rows with attributes of the version valid at their own time ``at``.

    The entity key keeps this an equi-join, and the fact side of a hot key is
    split at run time. A key has one version per load at most, so the range
    test sees few candidates; where histories run to thousands of versions,
    ``period`` ('day', 'month', ...) also equates the calendar period, and a
    fact row meets only the versions that were open in its own period.
    """
    fact_side, versions = fact.alias("f"), dim.select(spec.key, spec.start, spec.end, *attributes)
    on = F.col(f"f.{spec.key}") == F.col(f"v.{spec.key}")
    if period is not None:
        # Periods are taken from the fact itself, so a long-open version is
        # repeated only for periods in which its own entity has facts.
        wanted = fact.select(spec.key, F.date_trunc(period, at).cast("timestamp_ntz").alias("_period")).distinct()
        step = F.expr(f"interval 1 {period}")
        versions = (
            wanted.alias("w")
            .join(versions.alias("d"), F.col(f"w.{spec.key}") == F.col(f"d.{spec.key}"), "inner")
            .filter(
                (F.col(f"d.{spec.start}") < F.col("w._period") + step)
                & (F.col(f"d.{spec.end}").isNull() | (F.col(f"d.{spec.end}") > F.col("w._period")))
            )
            .select("w._period", "d.*")
        )
        on = on & (F.date_trunc(period, F.col(f"f.{at}")).cast("timestamp_ntz") == F.col("v._period"))
    valid = (F.col(f"v.{spec.start}") <= F.col(f"f.{at}")) & (
        F.col(f"v.{spec.end}").isNull() | (F.col(f"f.{at}") < F.col(f"v.{spec.end}"))
    )
    joined = fact_side.join(versions.alias("v"), on & valid, how)
    return joined.select("f.*", *[F.col(f"v.{c}").alias(c) for c in attributes])


def interval_violations(dim: DataFrame, spec: DimensionSpec = DIM_APPLICANT, *, absences: bool = False) -> DataFrame:
    """Entities whose versions, taken in order of their start, do not form one gap-free chain with one open end.

    With ``absences`` an entity may have been closed because its source no longer offered it: then no version need be open, and
    the next version may start later than the one before it ended, but never earlier. The comparison is exact; an entity's versions,
    one per load at most, are ordered in one task.
    """
    start, end = F.col(spec.start), F.col(spec.end)
    order = Window.partitionBy(spec.key).orderBy(start.asc_nulls_first(), end.asc_nulls_last())
    versions = dim.select(spec.key, spec.start, spec.end, spec.current).withColumn("_next", F.lead(start).over(order)).withColumn(
        "_followed", F.lead(F.lit(True), 1, False).over(order))
    if absences:
        broken = F.col("_followed") & ~F.coalesce(end <= F.col("_next"), F.lit(False))
    else:
        broken = F.when(F.col("_followed"), ~end.eqNullSafe(F.col("_next"))).otherwise(end.isNotNull())
    found = versions.groupBy(spec.key).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(end.isNull()).alias("open_versions"),
        F.count_if(start.isNull() | F.coalesce(end <= start, F.lit(False))).alias("empty_intervals"),
        F.count_if(~F.col(spec.current).eqNullSafe(end.isNull())).alias("flag_mismatches"),
        F.bool_or(broken).alias("broken_chain"),
    )
    open_ends = F.col("open_versions") > 1 if absences else F.col("open_versions") != 1
    return found.filter(open_ends | (F.col("empty_intervals") > 0) | (F.col("flag_mismatches") > 0) | F.col("broken_chain"))


def unknown_state(dim: DataFrame, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Versions that do not say whether they are current; a run can neither keep nor close them."""
    return dim.filter(F.col(spec.current).isNull()).select(spec.key)
