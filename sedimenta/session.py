"""Session settings the library is designed around.

On a cluster the session belongs to the platform: nothing here is applied to a
session that already exists. ``local_session`` is for tests and the benchmark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key at run time. Forced, because an added shuffle is
    # cheaper than one task that holds a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A replay replaces the partitions it produces and no others.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int = 8, app: str = "sedimenta", memory: str = "8g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
