"""Keyed upserts as pure functions; publishing the result is the sink's job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fn


def upsert_parts(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 order: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(target rows that stay, updates that take effect); their union is the upserted table.

    Both are anti-joins against key (and order) columns only. When the update
    keys are small the engine broadcasts them and the target is not shuffled at
    all; when they are not, a target bucketed on the key is read in place and
    only the updates move.
    """
    if set(target.columns) != set(updates.columns):
        missing = sorted(set(target.columns) ^ set(updates.columns))
        raise ValueError(f"upsert needs equal columns; differing: {missing}")
    if order is None:
        return target.join(updates.select(*keys), list(keys), "left_anti").select(*target.columns), updates

    accepted = accepted_updates(target, updates, keys, order)
    return target.join(accepted.select(*keys), list(keys), "left_anti").select(*target.columns), accepted


def accepted_updates(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Updates that no newer row of the target stands against.

    Reads only keys and order columns of the target. Once these are known, the target rows they replace are those with
    their keys, without any comparison of ranks on the wide side.
    """

    def same_key(a: str, b: str) -> Column:
        return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])

    stored = target.select(*keys, F.struct(*order).alias("_rank"))  # structs compare NULLs as lowest
    rank = F.struct(*[F.col(f"u.{c}") for c in order])
    return updates.alias("u").join(stored.alias("m"), same_key("u", "m") & (F.col("m._rank") > rank), "left_anti")


def signed_changes(target: DataFrame | None, accepted: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """What an upsert changes, as rows with a ``sign``: -1 for each target row that is replaced, 1 for each update that takes effect.

    Sums of any measure over a table change by the signed sum over these rows, so what is kept of such sums needs no other row.
    """
    added = accepted.select(*columns, F.lit(1).alias("sign"))
    if target is None:
        return added
    return target.join(accepted.select(*keys), list(keys), "left_semi").select(*columns, F.lit(-1).alias("sign")).unionByName(added)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows are replaced, unmatched rows are inserted, the rest is kept.

    ``updates`` must be unique on non-NULL keys (``latest_per_key`` and
    ``split_null_keys`` first; the publishing sink gates it).
    """
    kept, incoming = upsert_parts(target, updates, keys)
    return kept.unionByName(incoming)


def upsert_latest(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                  order: Sequence[str] = ("ingestion_ts",)) -> DataFrame:
    """Upsert in which an older update never replaces a newer row.

    For replays and late batches. An update as old as the stored row replaces
    it, so a corrected replay of the same batch takes effect; a NULL order is
    older than any other.
    """
    kept, incoming = upsert_parts(target, updates, keys, order)
    return kept.unionByName(incoming)


def lookup_rows(df: DataFrame, code: str, id_name: str, code_name: str,
                descriptions: Mapping[str, str] | None = None, description_name: str | None = None) -> DataFrame:
    """Type-1 lookup: one row per distinct code with a stable hashed id."""
    rows = (
        df.select(F.col(code).alias(code_name))
        .filter(F.col(code_name).isNotNull())
        .distinct()
        .select(fn.sha256_text(code_name).alias(id_name), code_name)
    )
    if description_name is None:
        return rows
    text = F.col(code_name)
    if descriptions:
        known = F.create_map(*[F.lit(x) for pair in descriptions.items() for x in pair])
        text = F.coalesce(known[F.col(code_name)], text)
    return rows.withColumn(description_name, text)
