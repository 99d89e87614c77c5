"""As-of joins by one sort of facts and versions: for entities whose histories, or facts, are too many for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .checkpoints import held
from .scd2 import DIM_APPLICANT, DimensionSpec


def join_as_of(fact: DataFrame, dim: DataFrame, at: str, attributes: Sequence[str], spec: DimensionSpec = DIM_APPLICANT,
               how: str = "left") -> DataFrame:
    """Fact rows with attributes of the version valid at their own time ``at``, as ``scd2.join_as_of`` gives them.

    Facts and versions are sorted together by (entity, time) over ranges whose borders may fall inside an entity, so neither a long history
    nor a hot fact key stays in one task, and no fact is compared with more than one version: it takes the last version before it,
    if that has not ended. Where a range begins inside an entity, the last version of the ranges before is carried over; that can be so for
    the first and the last entity of a range only, so what is carried is two rows per range. Versions must be sound
    (``scd2.interval_violations``). A fact without entity or time has no version. ``how`` is left or inner.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"as-of join must be left or inner, not {how}")
    version = F.struct(F.col(spec.start).alias("start"), F.col(spec.end).alias("end"), *[F.col(c).alias(f"a{i}") for i, c in enumerate(attributes)])
    versions = dim.select(F.col(spec.key).alias("_key"), F.col(spec.start).alias("_time"), F.lit(0).alias("_kind"), version.alias("_version"))
    facts = fact.select(F.col(spec.key).alias("_key"), F.col(at).alias("_time"), F.lit(1).alias("_kind"), F.struct(*fact.columns).alias("_fact"))
    both = versions.unionByName(facts, allowMissingColumns=True)
    # The tie-break splits equal facts, too; versions stand before facts of their moment.
    order = ["_key", "_time", "_kind", F.xxhash64("_fact")]
    rows = held(both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))

    so_far = Window.partitionBy("_part", "_key").orderBy("_time", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far)).filter(F.col("_kind") == 1)

    ends = rows.groupBy("_part").agg(F.min("_key").alias("least"), F.max("_key").alias("most"))
    spanning = ends.select(F.explode(F.array("least", "most")).alias("_key")).filter("_key IS NOT NULL").distinct()
    last = rows.join(spanning, ["_key"], "left_semi").groupBy("_key", "_part").agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_time"))).alias("_last"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).filter("_carried IS NOT NULL").select("_key", "_part", "_carried")

    found = F.coalesce("_found", "_carried")
    time = F.col("_time")
    valid = F.col("_v.start").isNotNull() & (F.col("_v.start") <= time) & (F.col("_v.end").isNull() | (time < F.col("_v.end")))
    joined = inside.join(carried, ["_key", "_part"], "left").withColumn("_v", found).withColumn("_valid", F.coalesce(valid, F.lit(False)))
    if how == "inner":
        joined = joined.filter("_valid")
    return joined.select("_fact.*", *[F.when(F.col("_valid"), F.col(f"_v.a{i}")).alias(c) for i, c in enumerate(attributes)])
