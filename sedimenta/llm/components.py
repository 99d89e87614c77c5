"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.work import stage


def _stars(edges: DataFrame) -> bool:
    """Whether every node either has one smaller neighbour and no larger one, or larger ones only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, label) of every node in ``edges`` (columns a, b): the label is the smallest node it is connected with.

    Alternating large and small stars: every node hooks its larger neighbours, then its smaller ones, to the smallest it knows, until
    all edges lead to the smallest node of their component. The number of rounds grows with the logarithm of the longest path.
    Minima are combined before they are shuffled and each round's edges are written, so a node with very many edges is no
    single task's work and nothing is collected.
    """
    edges = stage(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most):
        if _stars(edges):
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = stage(large)
        down = stage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        edges = stage(small.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
