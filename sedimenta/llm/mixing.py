"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sedimenta.llm.work import ROW, chosen_rows, stage, stored, with_row_number

WORD = "[^\\x20\\x09-\\x0D]+"
#: Start of the cumulative rounding. Any value in [0, 1) is right; this one is far from multiples of simple rates.
OFFSET = 0.3819660112501051


def word_count(text: Column) -> Column:
    """Words of a text (NULL: 0): the places where a word begins."""
    return F.coalesce(F.regexp_count(text, F.lit("(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D]")), F.lit(0)).cast("long")


def numbered_sources(sizes: DataFrame) -> DataFrame:
    """(_source, _rank): sources by code point, NULL last, from 0. UTF-8 byte order is code point order."""
    ordered = sizes.select("_source").distinct().orderBy(F.col("_source").asc_nulls_last())
    schema = T.StructType([T.StructField("_source", sizes.schema["_source"].dataType), T.StructField("_rank", T.LongType())])
    return sizes.sparkSession.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[1])), schema)


def shared_targets(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """Adds ``target`` to (.., _weight, source_size): ``share`` of all words by weight, at most ``cap`` times a source's size.

    What a capped source cannot take is shared again by weight among the rest until none is above its cap: each round settles
    the sources above their cap and recomputes the level of the others, two scalars at a time.
    """
    total = sources.agg(F.sum("source_size").alias("s"), F.sum("_weight").alias("w")).first()
    budget, level = share * float(total["s"] or 0), 0.0
    full = F.col("source_size") * float(cap)
    weights, settled = float(total["w"] or 0), 0.0
    while weights > 0:
        level = (budget - settled) / weights
        over = full < F.col("_weight") * level
        x = sources.agg(F.sum(F.when(over, full).otherwise(0.0)).alias("c"), F.sum(F.when(over, 0.0).otherwise(F.col("_weight").cast("double"))).alias("w")).first()
        if x["w"] == weights:
            break
        settled, weights = x["c"], x["w"]
    target = F.least(full, F.col("_weight") * level) if weights > 0 else full
    return sources.withColumn("target", target.cast("double"))


def balanced_rates(cells: DataFrame, sources: DataFrame, cap: float, tolerance: float = 1e-12, most: int = 60) -> DataFrame:
    """(_source, _tilt): the dual solution of entropy balancing under one word constraint per source.

    Minimises the relative entropy of the rates r to their priors q, weighted by words, subject to ``sum(r * size) = target`` per
    source and ``0 <= r <= cap``. The solution is the exponentially tilted ``r = min(cap, q * exp(tilt))``; the dual
    ``sum(size * q * exp(tilt)) - tilt * target`` is convex and separable. Each Newton iteration is one aggregation of the cells
    (source, prior) to a gradient and a curvature per source; the tilts seen bracket the solution, and a step that leaves the
    bracket (the cap flattens the dual) halves it. A source without words or with target 0 has rate 0 (tilt NULL). A target that
    the priors and the cap cannot reach leaves every row with a prior above 0 at the cap.
    """
    state = stage(sources.select("_source", "target", F.when(F.col("target") > 0, F.lit(0.0)).alias("_tilt"), F.lit(-40.0).alias("_low"), F.lit(40.0).alias("_high")))
    for _ in range(most):
        at = cells.alias("c").join(state.alias("s"), F.col("c._source").eqNullSafe(F.col("s._source"))).select(
            "s.*", "_mass", (F.col("_prior") * F.exp("_tilt")).alias("_rate"))
        step = at.groupBy(*state.columns).agg(
            F.sum(F.col("_mass") * F.least("_rate", F.lit(float(cap)))).alias("_got"),
            F.sum(F.when(F.col("_rate") < cap, F.col("_mass") * F.col("_rate")).otherwise(0.0)).alias("_curve"))
        gap = F.col("_got") - F.col("target")
        near = F.abs(gap) <= tolerance * F.col("target")
        step = step.withColumn("_low", F.when(gap < 0, F.col("_tilt")).otherwise(F.col("_low"))).withColumn(
            "_high", F.when(gap > 0, F.col("_tilt")).otherwise(F.col("_high")))
        newton = F.when(F.col("_curve") > 0, F.col("_tilt") - gap / F.col("_curve"))
        inside = (newton > F.col("_low")) & (newton < F.col("_high"))
        following = F.when(near, F.col("_tilt")).when(inside, newton).otherwise((F.col("_low") + F.col("_high")) / 2)
        state = stage(step.select("_source", "target", following.alias("_tilt"), "_low", "_high", (~near & (F.col("_high") - F.col("_low") > 1e-14)).alias("_open")))
        if state.filter("_open").isEmpty():
            break
        state = state.drop("_open")
    return state.select("_source", "_tilt")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2),
        share: float = 1.5, cap: float = 2.0, prior: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``_row``, the id, size, source_size, target, copies, taken.

    Sources in code point order (NULL is one source, last) weigh ``weights``, repeating. ``prior`` is a document's wanted rate
    before balancing (1 by default; NULL or negative counts as 0). Rates become whole copies by cumulative rounding along the
    documents of a source in order of size, prior, id (NULL last) and row: a source's taken words then miss the sum of its rates by no more than its
    largest document, whatever its number of rows, and a document gets its rate rounded down or up. Reruns agree. NULL and
    wordless texts have size 0. An empty table gives an empty result. Only id, text and source are read.

    The order is a sort by ranges, whose bounds fall inside large (source, size, prior) cells too, down to the row: a row's number in
    its cell is its place in its range and the rows of the cell in ranges before. No task sorts a source. ``docs`` must be a stored
    table.
    """
    q = F.lit(1.0) if prior is None else F.greatest(F.coalesce(prior.cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = with_row_number(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(text_col), q.alias("_prior"))).select(
        ROW, "_id", "_source", "_prior", word_count(F.col(text_col)).alias("size"))
    rows = stage(rows)
    cells = stage(rows.groupBy("_source", "_prior").agg(F.sum("size").cast("double").alias("_mass")))
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ranks = numbered_sources(sizes)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = sizes.alias("a").join(ranks.alias("b"), F.col("a._source").eqNullSafe(F.col("b._source"))).select("a._source", "source_size", weight.alias("_weight"))
    sources = stage(shared_targets(stage(sources), share, cap))
    rates = balanced_rates(cells, sources, cap)
    known = stage(sources.alias("a").join(rates.alias("b"), F.col("a._source").eqNullSafe(F.col("b._source"))).select(
        "a._source", "source_size", "target", "_tilt"))

    cell = ["_source", "size", "_prior"]
    order = [*cell, F.col("_id").asc_nulls_last(), ROW]
    placed = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()))
    ranges = placed.groupBy(*cell, "_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    ahead = Window.partitionBy(*cell).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stage(ranges.withColumn("_ahead", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))))
    cells = ranges.groupBy(*cell).agg(F.sum("_rows").alias("_rows")).alias("c").join(known.alias("k"), F.col("c._source").eqNullSafe(F.col("k._source"))).select(
        "c._source", "size", "_prior", "_rows", "source_size", "target",
        F.least(F.lit(float(cap)), F.coalesce(F.col("_prior") * F.exp("_tilt"), F.lit(0.0))).alias("_rate"))
    before = Window.partitionBy("_source").orderBy("size", "_prior").rowsBetween(Window.unboundedPreceding, -1)
    cells = stage(cells.withColumn("_before", F.coalesce(F.sum(F.col("_rate") * F.col("_rows")).over(before), F.lit(0.0))))
    equal = lambda a, b, keys: functools.reduce(operator.and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in keys])
    ranges = stage(ranges.alias("b").join(cells.alias("c"), equal("b", "c", cell)).select(
        *[f"b.{c}" for c in cell], "_part", "_first", "_ahead", "source_size", "target", "_rate", "_before"))
    placed = placed.alias("p").join(ranges.alias("b"), equal("p", "b", [*cell, "_part"])).select(
        ROW, "_id", "p.size", "source_size", "target", "_rate", "_before", (F.col("_place") - F.col("_first") + F.col("_ahead")).alias("_index"))
    upto = lambda n: F.floor(F.col("_before") + F.col("_rate") * n + OFFSET)
    copies = F.when(F.col("size") == 0, F.least(F.lit(1), upto(F.col("_index") + 1) - upto(F.col("_index")))).otherwise(
        upto(F.col("_index") + 1) - upto(F.col("_index")))
    return placed.select(ROW, F.col("_id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"), "target",
                         F.least(copies, F.lit(int(cap))).cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    docs = stored(docs)
    return chosen_rows(docs, mix(docs, id_col, text_col, source_col), "copies")
