"""Exact dedup: rows grouped by a 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.work import ROW, chosen_rows, stage, stored, with_row_number

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def without_white_space(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = content_hash,
                 normalise: Callable[[Column], Column] = without_white_space) -> DataFrame:
    """One row per row of ``docs``: ``_row``, the id, keep_id, group_size, kept, text_sha256 of the normalised text.

    Texts are equal when their normalised bytes are; NULL counts as empty. Of equal texts the row with the most code points stays,
    then the smallest id (NULL ids last); of rows that agree in both, one stays. Only the id and the text are read, so other
    columns and their names do not matter. An empty table gives an empty result.

    The distinct (hash, bytes) pairs are formed with map-side combination, so a large group of copies moves one text per task. A
    hash with several texts is split by the texts themselves. The groups are written before the rows are joined to them, so a hot
    group is split by the adaptive skew join. ``docs`` must be a stored table (see ``with_row_number``).
    """
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = with_row_number(docs.select(F.col(id_col).alias("_id"), F.col(text_col))).select(
        ROW, "_id", text.alias("_text"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("_length"))
    rows = rows.withColumn("_hash", digest(F.col("_text")))
    members = stage(rows.select(ROW, "_id", "_hash", "_length", F.sha2("_text", 256).alias("text_sha256")))
    mixed = stage(rows.groupBy("_hash", "_text").agg(F.lit(1).alias("_one")).groupBy("_hash").agg(F.count("*").alias("_texts"))
                  .filter("_texts > 1").select("_hash"))
    if mixed.isEmpty():
        members = members.withColumn("_text", F.lit(""))
    else:
        apart = rows.join(mixed, "_hash", "left_semi").select(ROW, "_text")
        members = stage(members.join(apart, ROW, "left").fillna("", ["_text"]))
    best = F.min(F.struct((-F.col("_length")).alias("l"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col(ROW).alias("r")))
    groups = stage(members.groupBy("_hash", "_text").agg(best.alias("_best"), F.count("*").alias("group_size")))
    return members.join(groups, ["_hash", "_text"]).select(
        ROW, F.col("_id").alias(id_col), F.col("_best.i").alias("keep_id"), "group_size",
        (F.col(ROW) == F.col("_best.r")).alias("kept"), "text_sha256")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = stored(docs)
    return chosen_rows(docs, exact_groups(docs, id_col, text_col).filter("kept"))
