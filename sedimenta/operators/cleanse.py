"""Row- and key-level cleansing: dedup, casts, sentinels, masking, staging views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as fn

# What tells which of two rows of one moment arrived later.
ARRIVAL = ("batch_id", "source_line")
_UNORDERABLE = (T.MapType, T.VariantType)
_INEXACT_TEXT = (T.FloatType, T.DoubleType)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("ingestion_ts",),
    tiebreak: Sequence[str] | None = None,
    *,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """The latest row per key, by ``order`` and then ``tiebreak``, all descending.

    Without ``tiebreak`` the arrival breaks ties, where the rows still know it: the later batch, then the later line. After
    that every other sortable column does, so rows still tied are identical and the result is reproducible. Columns named in
    ``types`` rank as values of that type first, so that "249.0" comes after "99.0". The ranking filter is
    planned as a group limit on both sides of the shuffle: a key that holds a
    third of the table sends one row per map task, not all of its rows.
    """
    if tiebreak is None:
        used = {*keys, *order}
        sortable = [f.name for f in df.schema.fields if f.name not in used and not isinstance(f.dataType, _UNORDERABLE)]
        arrival = [c for c in ARRIVAL if c in sortable]
        tiebreak = [*arrival, *(c for c in sortable if c not in arrival)]
    typed = {c: fn.typed(c, t) for c, t in (types or {}).items()}
    ranking = [x.desc_nulls_last() for c in (*order, *tiebreak) for x in ([typed[c]] if c in typed else []) + [F.col(c)]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def with_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Apply casts to the columns present; text that does not parse becomes NULL."""
    present = {c: t for c, t in casts.items() if c in df.columns}
    return df.withColumns({c: fn.typed(c, t) for c, t in present.items()}) if present else df


def failed_cast_rules(df: DataFrame, casts: Mapping[str, str]) -> dict[str, str]:
    """Quarantine rules that hold for rows a later ``with_casts`` would blank."""
    return {
        f"bad_{c}": f"`{c}` IS NOT NULL AND try_cast(`{c}` AS {t}) IS NULL"
        for c, t in casts.items()
        if c in df.columns
    }


def null_sentinels(df: DataFrame, sentinels: Mapping[str, object], flag_suffix: str | None = None) -> DataFrame:
    """Sentinel -> NULL per column, with an optional flag column taken first."""
    present = {c: s for c, s in sentinels.items() if c in df.columns}
    out = {c: fn.null_if(c, s) for c, s in present.items()}
    if flag_suffix:
        out.update({f"{c}{flag_suffix}": fn.is_sentinel(c, s) for c, s in present.items()})
    return df.withColumns(out) if out else df


def mask_columns(
    df: DataFrame,
    masked: Sequence[str],
    sentinels: Mapping[str, object] | None = None,
    *,
    suffix: str = "_MASKED",
    flag_suffix: str | None = None,
    drop_raw: bool = True,
) -> DataFrame:
    """Null sentinels, then hash what remains, then drop the raw columns.

    The three steps are one operator so that no caller can hash a sentinel:
    its fixed digest would give away who carries it. Floating-point columns are
    refused, their text form is not stable enough to be an identity.
    """
    sentinels = dict(sentinels or {})
    present = [c for c in masked if c in df.columns]
    inexact = [c for c in present if isinstance(df.schema[c].dataType, _INEXACT_TEXT)]
    if inexact:
        raise TypeError(f"cast to an integer, decimal or string before masking: {inexact}")
    clean = {c: fn.null_if(c, sentinels[c]) if c in sentinels else F.col(c) for c in present}
    flags = {
        f"{c}{flag_suffix}": fn.is_sentinel(c, s) for c, s in sentinels.items() if flag_suffix and c in df.columns
    }
    others = {c: fn.null_if(c, s) for c, s in sentinels.items() if c in df.columns and c not in clean}
    raw = {} if drop_raw else clean
    out = df.withColumns({**others, **raw, **{f"{c}{suffix}": fn.sha256_text(v) for c, v in clean.items()}, **flags})
    return out.drop(*present) if drop_raw else out


def with_version_columns(df: DataFrame, ts: str = "ingestion_ts") -> DataFrame:
    """Open validity interval stamped on a silver row; history itself lives in gold."""
    return df.withColumns(
        {
            "is_current": F.lit(True),
            "start_date": F.to_date(ts),
            "end_date": F.lit(None).cast("date"),
        }
    )


def snapshot(df: DataFrame, keys: Sequence[str], order: Sequence[str], period: str = "MONTHS_BALANCE",
             value: int = 0, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Rows of one period only, deduplicated; the filter reaches the scan."""
    return latest_per_key(df.filter(F.col(period) == value), keys, order, tiebreak)


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows with a NULL in the key).

    A NULL key never matches in an upsert and would be inserted again each run.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return df.filter(complete), df.filter(~complete)


def stage_application(application: DataFrame, key: str = "SK_ID_CURR", attributes: Mapping[str, str] | None = None,
                      carried: Sequence[str] = ("ingestion_ts", "ingestion_date")) -> DataFrame:
    """Staging view: key duplicated as ``applicant_id``, attributes renamed, NULL keys dropped."""
    attributes = attributes if attributes is not None else {
        "NAME_INCOME_TYPE": "name_income_type",
        "NAME_EDUCATION_TYPE": "name_education_type",
        "NAME_FAMILY_STATUS": "name_family_status",
        "CNT_CHILDREN": "cnt_children",
    }
    return application.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("applicant_id"),
        F.col(key),
        *[F.col(source).alias(name) for source, name in attributes.items()],
        *[F.col(c) for c in carried if c in application.columns],
    )
