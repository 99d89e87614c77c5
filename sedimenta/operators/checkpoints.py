"""Intermediate results that several steps read, kept where every executor can read them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def held(df: DataFrame) -> DataFrame:
    """``df`` computed once into the cluster's checkpoint folder, or below the warehouse where the session names none."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint(eager=True)
