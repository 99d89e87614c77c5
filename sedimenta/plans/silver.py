"""Silver plan: what happens to a bronze table, in order, driven by its registry entry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import cleanse
from ..operators.quality import Gate, sentinel_leaks, with_failed_rules
from ..sources.files import CORRUPT, SOURCE_LINE
from ..sources.registry import INGESTION_TS, TableSpec

FAILED = "failed_rules"


def conform(rows: DataFrame, spec: TableSpec, *, ts: str = INGESTION_TS, drop_raw: bool = True,
            flag_suffix: str | None = "_IS_SENTINEL", casts: Mapping[str, str] | None = None) -> DataFrame:
    """Casts -> sentinels and masks -> version columns; row-wise, no shuffle."""
    df = cleanse.with_casts(rows, spec.casts if casts is None else casts)
    if spec.masked or spec.sentinels:
        df = cleanse.mask_columns(df, spec.masked, spec.sentinels, drop_raw=drop_raw, flag_suffix=flag_suffix)
    return cleanse.with_version_columns(df, ts) if spec.versioned else df


def clean(bronze: DataFrame, spec: TableSpec, *, order: Sequence[str] = (INGESTION_TS,),
          tiebreak: Sequence[str] | None = None, **options) -> DataFrame:
    """A silver table from bronze: the latest row per key, conformed. Of rows of one moment the last to arrive counts."""
    latest = cleanse.latest_per_key(bronze, spec.keys, order, tiebreak, types=options.get("casts") or spec.casts)
    return conform(latest.drop(SOURCE_LINE), spec, ts=order[0], **options)


def judged(bronze: DataFrame, spec: TableSpec, *, order: Sequence[str] = (INGESTION_TS,), **options) -> DataFrame:
    """``bronze`` as it came, with ``failed_rules``: names of the rules each arrival breaks.

    Cast rules look at the arriving text and domain rules at the conformed row. Only what the rules read is computed.
    """
    cast_rules = cleanse.failed_cast_rules(bronze, options.get("casts") or spec.casts)
    if CORRUPT in bronze.columns:
        cast_rules["unparsed_line"] = f"`{CORRUPT}` IS NOT NULL"
    tagged = with_failed_rules(bronze, cast_rules, "_cast_failures").withColumn("_arrived", F.struct(*bronze.columns))
    out = conform(tagged, spec, ts=order[0], **options)
    domain = {name: predicate for name, (column, predicate) in spec.rules.items() if column in out.columns}
    out = with_failed_rules(out, domain, "_domain_failures")
    return out.select("_arrived.*", F.concat("_cast_failures", "_domain_failures").alias(FAILED))


def prepare(bronze: DataFrame, spec: TableSpec, *, order: Sequence[str] = (INGESTION_TS,),
            tiebreak: Sequence[str] | None = None, **options) -> DataFrame:
    """The latest good row per key and every bad arrival, conformed, with ``failed_rules``.

    Rules come before ranking: a bad arrival never hides an earlier good row, so a rebuild over all batches and a build batch
    by batch give the same tables. Masked columns are hashed before a row is diverted, so quarantine holds no raw
    sensitive value.
    """
    good, bad = prepared(bronze, spec, order=order, tiebreak=tiebreak, **options)
    return good.unionByName(bad)


def prepared(bronze: DataFrame, spec: TableSpec, *, order: Sequence[str] = (INGESTION_TS,),
             tiebreak: Sequence[str] | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """``prepare`` as (good rows, one per key; bad arrivals), each with ``failed_rules``."""
    rows = judged(bronze, spec, order=order, **options)
    good = cleanse.latest_per_key(rows.filter(~is_bad()), spec.keys, order, tiebreak, types=options.get("casts") or spec.casts)
    # The unparsed line is unmasked, and a place in a file is of use in bronze only.
    return tuple(conform(side.drop(CORRUPT, SOURCE_LINE), spec, ts=order[0], **options) for side in (good, rows.filter(is_bad())))


def keyless(bronze: DataFrame, spec: TableSpec, **options) -> DataFrame:
    """Rows with an incomplete key, conformed and marked for quarantine.

    They are split off before dedup, which would merge them into one row.
    """
    _, missing = cleanse.split_null_keys(bronze, spec.keys)
    return conform(missing.drop(CORRUPT, SOURCE_LINE), spec, **options).withColumn(FAILED, F.array(F.lit("key_missing")))


def keyed(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    return cleanse.split_null_keys(bronze, spec.keys)[0]


def mask_gates(staged: DataFrame, spec: TableSpec) -> list[Gate]:
    """No sentinel digest and no raw sensitive column in what is about to be published."""
    if not spec.masked:
        return []
    raw = [c for c in spec.masked if c in staged.columns]
    exposed = staged.filter(F.lit(bool(raw)))
    return [
        Gate(f"{spec.silver}_sentinel_leak", sentinel_leaks(staged, spec.sentinels)),
        Gate(f"{spec.silver}_raw_column", exposed),
    ]


def is_bad() -> Column:
    return F.size(FAILED) > 0
