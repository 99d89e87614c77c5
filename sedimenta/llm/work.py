"""Shared-folder tables and row numbers for jobs that read an intermediate result more than once."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROW = "_row"
#: Bits for the place of a row in its file.
FILE_ROWS = 40
#: Rows whose flags are one bitmap, as a power of two; ``bitmap_construct_agg`` makes them of this size.
FLAG_BITS = 15


def work_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return base.rstrip("/") if base else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Readers no longer depend on the tasks that made it, so a lost executor costs a re-read only, and every reader sees the same
    rows.
    """
    path = f"{work_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself where it only selects and filters columns of Parquet files, else ``df`` staged."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic():
        node = node.children().head()
    if node.nodeName() == "LogicalRelation":
        try:
            if "row_index" in df.select(df.metadataColumn("_metadata").alias("m")).schema["m"].dataType.names:
                return df
        except AnalysisException:
            pass
    return stage(df)


def with_row_number(df: DataFrame, name: str = ROW) -> DataFrame:
    """``df`` with a unique number per row in ``name``: its file, numbered by path, and its place in the file.

    Every read of the same files gives the same numbers, however a scan is split over tasks. What is no plain read of Parquet files
    is staged first, so a caller that numbers such a frame twice must call ``stored`` itself.
    """
    df = stored(df)
    path, place, file = (f"_{x}_{uuid.uuid4().hex}" for x in ("path", "place", "file"))
    own = df.metadataColumn("_metadata")
    paths = sorted(r[0] for r in df.select(own["file_path"]).distinct().collect())  # the scan's own file list is larger
    files = df.sparkSession.createDataFrame([(x, i) for i, x in enumerate(paths)], f"{path} string, {file} long")
    numbered = df.withColumns({path: own["file_path"], place: own["row_index"]}).join(F.broadcast(files), path)
    return numbered.withColumn(name, F.shiftleft(F.col(file), FILE_ROWS) + F.col(place)).drop(path, place, file)


def flagged(rows: DataFrame, chosen: DataFrame, name: str) -> DataFrame:
    """``rows`` (with row numbers) and, in the boolean column ``name``, whether the row's number is in ``chosen._row``.

    The numbers are sent to the tasks as a bit per row, so rows stay where their scan reads them, however many are chosen.
    """
    block, place = F.shiftright(F.col(ROW), FLAG_BITS), F.col(ROW).bitwiseAND((1 << FLAG_BITS) - 1)
    bits = stage(chosen.groupBy(block.alias("_flag_block")).agg(F.bitmap_construct_agg(place).alias("_flag_bits")))
    byte = F.conv(F.hex(F.substring("_flag_bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    flag = F.coalesce(F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    return rows.withColumn("_flag_block", block).join(F.broadcast(bits), "_flag_block", "left").withColumn(name, flag).drop("_flag_block", "_flag_bits")


def chosen_rows(df: DataFrame, chosen: DataFrame, copies: str | None = None) -> DataFrame:
    """The rows of ``df`` (see ``stored``) whose number is in ``chosen._row``, with all columns of ``df``, whatever their names; with
    ``copies`` each as often as that column of ``chosen`` says."""
    row, times = f"_row_{uuid.uuid4().hex}", f"_times_{uuid.uuid4().hex}"
    numbered = with_row_number(df, row)
    if copies is None:
        return numbered.join(chosen.select(F.col(ROW).alias(row)), row, "left_semi").select(df.columns)
    some = chosen.filter(F.col(copies) > 0).select(F.col(ROW).alias(row), F.col(copies).cast("int").alias(times))
    return numbered.join(some, row).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(df.columns)


def ranked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` with their place (from 0) in their group in ``_index`` and the group's size in ``_total``.

    Rows are sorted by ranges whose bounds may fall inside a group, so no task holds a large one. Keys are not NULL; ``order`` ends
    in a unique column.
    """
    by = [*keys, *order]
    placed = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()))
    ranges = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    group = Window.partitionBy(*keys)
    ahead = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = stage(ranges.select(*keys, "_part", "_first", ahead.alias("_ahead"), F.sum("_n").over(group).alias("_total")))
    found = placed.join(ranges, [*keys, "_part"]).withColumn("_index", F.col("_place") - F.col("_first") + F.col("_ahead"))
    return found.select(*rows.columns, "_index", "_total")
