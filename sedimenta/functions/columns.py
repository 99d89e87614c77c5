"""Column expressions shared by every layer. No Python UDF anywhere.

Functions accept a column name or a ``Column``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed values.
NULL_KEY_TOKEN = "-1"
KEY_SEPARATOR = "|"
VERSION_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def typed(value: ColumnLike, data_type: str) -> Column:
    """Cast that yields NULL for text that does not parse, also under ANSI mode."""
    return as_column(value).try_cast(data_type)


def cast_failed(value: ColumnLike, data_type: str) -> Column:
    """True where a present value has no reading as ``data_type``."""
    value = as_column(value)
    return value.isNotNull() & value.try_cast(data_type).isNull()


def null_if(value: ColumnLike, sentinel) -> Column:
    return F.nullif(as_column(value), F.lit(sentinel))


def is_sentinel(value: ColumnLike, sentinel) -> Column:
    """Flag for a sentinel; NULL input is not a sentinel, so never NULL itself."""
    return as_column(value).eqNullSafe(F.lit(sentinel))


def sha256_text(value: ColumnLike) -> Column:
    """Lower-case hex SHA-256 of the text of a value; NULL stays NULL."""
    return F.sha2(as_column(value).cast("string"), 256)


def surrogate_key(*keys: ColumnLike, null_token: str = NULL_KEY_TOKEN, binary: bool = False) -> Column:
    """Hashed surrogate of one or several key columns: 64 hex digits, or the 32 bytes they spell."""
    parts = [F.coalesce(as_column(k).cast("string"), F.lit(null_token)) for k in keys]
    text = parts[0] if len(parts) == 1 else F.concat_ws(KEY_SEPARATOR, *parts)
    digest = F.sha2(text, 256)
    return F.unhex(digest) if binary else digest


def version_key(key: ColumnLike, as_of: Column, null_token: str = NULL_KEY_TOKEN) -> Column:
    """Surrogate of one version of an entity: entity key plus the version's start."""
    return F.sha2(
        F.concat_ws(
            KEY_SEPARATOR,
            F.coalesce(as_column(key).cast("string"), F.lit(null_token)),
            F.date_format(as_of, VERSION_TIMESTAMP_FORMAT),
        ),
        256,
    )


def any_changed(left: str, right: str, columns: list[str]) -> Column:
    """NULL-safe "at least one column differs" between two aliased frames.

    Total over the four NULL / non-NULL cells, so the result is never NULL.
    """
    changed = F.lit(False)
    for name in columns:
        changed = changed | ~F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return changed


def row_digest(columns: list[str]) -> Column:
    """MD5 over a whole row, unambiguous for NULLs and for separators in values.

    Each value is written as ``length:text`` and NULL as ``N``, so ``(1, NULL,
    'a')`` and ``(1, 'a', NULL)`` differ, and so do ``('a|b', 'c')`` and
    ``('a', 'b|c')``.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def hash_halves(value: Column) -> tuple[Column, Column]:
    """A 64-bit hash as two 32-bit numbers, whose sums over many rows stay within BIGINT."""
    return F.shiftrightunsigned(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))


def utc_naive(moment: datetime) -> datetime:
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


def instant(value: str | datetime) -> Column:
    """Zone-free timestamp literal; an aware ``datetime`` is taken in UTC."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return F.lit(utc_naive(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def instant_label(value: str | datetime) -> str:
    """Digits of an instant at fixed width, so labels sort by time."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return utc_naive(moment).strftime("%Y%m%d%H%M%S%f")
