"""Sets of integer keys as bitmaps: what is missing on one side is found without moving rows of the other.

Keys fall into blocks of 32,768; a task sends one bitmap of 4 KiB per block it has keys of, however many rows have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import orphans

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
BLOCK = 32_768
_BYTES = BLOCK // 8
#: Keys a block must hold on average for its bitmap to be smaller than they are.
DENSE = 256


def blocks(df: DataFrame, key: str) -> DataFrame:
    """(block, bits) of the non-NULL values of an integer column."""
    value = F.col(key).cast("bigint")
    rows = df.filter(value.isNotNull()).select(value.alias("_value")).select(F.expr(f"(_value - pmod(_value, {BLOCK})) DIV {BLOCK}").alias("block"), F.expr(f"pmod(_value, {BLOCK})").alias("bit"))
    return rows.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _byte(bits: Column, i: Column) -> Column:
    return F.conv(F.hex(F.substring(bits, i + 1, F.lit(1))), 16, 10).cast("int")


def keys_missing(left: DataFrame, right: DataFrame) -> DataFrame:
    """``key`` of every key of the first table of blocks that the second lacks."""
    both = left.join(right.select("block", F.col("bits").alias("other")), ["block"], "left").filter(~F.col("bits").eqNullSafe(F.col("other")))
    rest = F.transform(F.sequence(F.lit(0), F.lit(_BYTES - 1)), lambda i: F.struct(
        i.alias("at"), _byte(F.col("bits"), i).bitwiseAND(F.bitwise_not(F.coalesce(_byte(F.col("other"), i), F.lit(0)))).alias("rest")))
    found = both.select("block", F.explode(F.filter(rest, lambda x: x["rest"] != 0)).alias("x"))
    bit = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda b: F.getbit(F.col("x.rest"), b) == 1)
    return found.select("block", "x.at", F.explode(bit).alias("b")).select((F.col("block") * BLOCK + F.col("at") * 8 + F.col("b")).alias("key"))


def dense(df: DataFrame, key: str) -> bool:
    """Whether bitmaps of a column's keys are smaller than the keys themselves, by sketched counts of one pass."""
    if not isinstance(df.schema[key].dataType, _INTEGERS):
        return False
    value = F.col(key).cast("bigint")
    keys, used = df.agg(F.approx_count_distinct(value), F.approx_count_distinct(F.expr(f"(`{key}` - pmod(`{key}`, {BLOCK})) DIV {BLOCK}"))).first()
    return keys >= DENSE * used


def orphans_by_blocks(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """What ``quality.orphans`` gives. Bitmaps are compared in place of keys, and child rows are counted for missing keys only.

    So the child is read twice and shuffles a bitmap per task and block, then its orphans. The keys must be integers that lie close together, as
    numbered ones do (``dense``); others are compared key by key. Both ways are exact.
    """
    if not dense(child, child_key) or not isinstance(parent.schema[parent_key].dataType, _INTEGERS):
        return orphans(child, child_key, parent, parent_key)
    missing = keys_missing(blocks(child, child_key), blocks(parent, parent_key))
    rows = child.select(F.col(child_key).alias("key")).join(missing.withColumn("key", F.col("key").cast(child.schema[child_key].dataType)), ["key"], "left_semi")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("child_rows"))
