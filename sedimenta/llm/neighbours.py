"""Approximate nearest neighbours by shifted space-filling curves.

Several random projections of the vectors are laid on shifted grids and ordered along Hilbert curves. Vectors near each other are near
each other on some of the curves, so a query is compared with a window of rows around its place on every curve, and the findings of all
windows are merged and ranked by the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sedimenta.llm.work import stage

#: Rows of a block of a curve, and queries compared with a block in one task.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 8192
#: Scores this near to the last place are all kept until they are computed again one by one.
SLACK = 1e-9


@dataclass(frozen=True)
class Curves:
    """``axes``: curve, projected dimension, dimension. ``edges``: the grid's cuts, curve, projected dimension, cut. ``shift``: of the grid."""

    axes: np.ndarray
    edges: np.ndarray
    shift: np.ndarray
    bits: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The place of each row on each curve."""
        cells = 1 << (self.bits - 1)
        out = np.empty((len(unit), len(self.axes)), np.int64)
        for c, axes in enumerate(self.axes):
            at = unit @ axes.T
            for d in range(len(axes)):
                # Equal shares of the sample between cuts, then between 0 and 1 where the grid is twice as wide as the data.
                at[:, d] = np.interp(at[:, d], self.edges[c, d], np.linspace(0, cells - 1e-9, self.edges.shape[2]))
            out[:, c] = hilbert((at + self.shift[c] * cells).astype(np.int64), self.bits)
        return out


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points with ``bits`` bits a coordinate, by Skilling's transposed form."""
    x = points.T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b) & 1
    return key


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(_id, _vec, _asks) of the rows that take part: id not NULL; vector neither NULL, empty nor zero, all components finite."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec"), "_asks")
    good = F.col("_id").isNotNull() & F.col("_vec").isNotNull() & F.forall(
        "_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("_vec", lambda x: x != 0)
    return rows.filter(F.coalesce(good, F.lit(False)))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit(rows: DataFrame, curves: int, dims: int, bits: int, sample: int, seed: int) -> Curves | None:
    """Random axes and shifts; the cuts of the grids from at most ``sample`` vectors, the first by a hash of the id."""
    taken = rows.orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_vec").toArrow().column(0)
    if not len(taken):
        return None
    unit = _unit(_matrix(taken))
    rng = np.random.default_rng(seed)
    dims = min(dims, unit.shape[1])
    axes = np.stack([np.linalg.qr(rng.normal(size=(unit.shape[1], dims)))[0].T for _ in range(curves)])
    cuts = np.linspace(0, 1, 2 ** (bits - 1) * 4 + 1)
    edges = np.stack([np.quantile(unit @ a.T, cuts, axis=0).T for a in axes])
    edges += np.arange(edges.shape[2]) * 1e-12  # cuts must rise
    return Curves(axes, edges, rng.uniform(0, 1, (curves, dims)), bits)


def _placed(curves: Curves):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = curves.keys(_unit(_matrix(batch.column(2))))
                n = len(curves.axes)
                again = pa.array(np.repeat(np.arange(batch.num_rows), n))
                yield pa.record_batch([batch.column(0).take(again), batch.column(1).take(again), batch.column(2).take(again),
                                       pa.array(np.tile(np.arange(n, dtype=np.int32), batch.num_rows)), pa.array(keys.reshape(-1))],
                                      names=["_id", "_asks", "_vec", "_curve", "_key"])

    return placed


def _best(k: int, window: int):
    """Of a block's rows, those nearest to each query whose window they lie in."""

    def best(rows: pa.Table, asks: pa.Table) -> pa.Table:
        if not (rows.num_rows and asks.num_rows):
            return pa.table({"_query": rows.column("_id").slice(0, 0), "_id": rows.column("_id").slice(0, 0), "_score": pa.array([], pa.float64())})
        x, q = _unit(_matrix(rows.column("_vec"))), _unit(_matrix(asks.column("_vec")))
        place, at = np.asarray(rows.column("_place")), np.asarray(asks.column("_place"))
        who, found = [], []
        for begin in range(0, len(q), 1024):
            part = slice(begin, begin + 1024)
            score = q[part] @ x.T
            score[np.abs(at[part, None] - place[None, :]) > window] = -np.inf
            if score.shape[1] > k:
                last = np.partition(score, -k, axis=1)[:, -k:].min(axis=1, keepdims=True)
                keep = (score >= last - SLACK) & (score > -np.inf)
            else:
                keep = score > -np.inf
            a, b = np.nonzero(keep)
            who.append(a + begin)
            found.append(b)
        who, found = np.concatenate(who), np.concatenate(found)
        exact = np.concatenate([(q[who[i: i + 65536]] * x[found[i: i + 65536]]).sum(axis=1) for i in range(0, len(who), 65536)] or [np.zeros(0)])
        return pa.table({"_query": asks.column("_id").take(pa.array(who)), "_id": rows.column("_id").take(pa.array(found)), "_score": pa.array(exact)})

    return best


def search(vectors: DataFrame, asks: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", curves: int = 16, dims: int = 8,
           bits: int = 5, window_share: float = 0.1, sample: int = 10_000, seed: int = 11) -> DataFrame:
    """(query_id, rank, id, score): for each row that ``asks`` is true for, its ``k`` nearest found among all other rows.

    Nearness is the cosine in double precision on the original vectors; ties go to the smaller id. Rows as in ``usable`` take
    part. Of equal vectors the ``k + 1`` smallest ids stand as candidates, which is enough for every list, and one stands for all
    queries with that vector; so a vector that a third of the rows share costs no more than another. A repeated id is one row
    if its vector is the same. Fewer than ``k`` candidates give shorter lists, an empty table none. Vectors of each length
    are a space of their own, searched one after another (a table has few lengths): a cosine is between vectors of one length.

    A window holds ``window_share`` of the rows of a curve, half on either side. Without structure in the vectors the share that has
    to be seen for a given recall does not fall with their number; with it, a smaller share does. The curves are cut into blocks of
    ``BLOCK_ROWS`` rows, and blocks many queries fall on are given several tasks.
    """
    flagged = vectors.select(F.col(id_col), F.col(vec_col), F.coalesce(asks, F.lit(False)).alias("_asks"))
    rows = stage(usable(flagged, id_col, vec_col).dropDuplicates(["_id", "_vec"]))
    lengths = [r[0] for r in rows.groupBy(F.size("_vec")).count().orderBy("count").collect()]  # one row per length
    spaces = [rows if len(lengths) < 2 else rows.filter(F.size("_vec") == n) for n in lengths] or [rows]
    return reduce(DataFrame.unionByName, [_search(space, k, id_col, curves, dims, bits, window_share, sample, seed) for space in spaces])


def _search(rows: DataFrame, k: int, id_col: str, curves: int, dims: int, bits: int, window_share: float, sample: int, seed: int) -> DataFrame:
    """``search`` among staged rows with vectors of one length."""
    same = Window.partitionBy("_vec").orderBy("_id")
    ranked = rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1)
    candidates = stage(ranked.groupBy("_vec").agg(F.sort_array(F.collect_list("_id")).alias("_ids")).select(F.col("_ids")[0].alias("_id"), "_ids", "_vec"))
    asking = stage(rows.filter("_asks").alias("r").join(candidates.alias("c"), F.col("r._vec") == F.col("c._vec")).select(F.col("r._id").alias("query_id"), F.col("c._id").alias("_query")))
    heads = candidates.join(asking.select(F.col("_query").alias("_id")).distinct().withColumn("_asks", F.lit(True)), "_id", "left").select(
        "_id", F.coalesce("_asks", F.lit(False)).alias("_asks"), "_vec")
    heads = stage(heads)
    n = heads.count()
    index = fit(heads, curves, dims, bits, sample, seed)
    kinds = {f.name: f.dataType for f in heads.schema}
    schema = T.StructType([T.StructField("_id", kinds["_id"]), T.StructField("_asks", T.BooleanType()), T.StructField("_vec", kinds["_vec"]),
                           T.StructField("_curve", T.IntegerType()), T.StructField("_key", T.LongType())])
    out = T.StructType([T.StructField("_query", kinds["_id"]), T.StructField("_id", kinds["_id"]), T.StructField("_score", T.DoubleType())])
    if index is None:
        found = rows.sparkSession.createDataFrame([], out)
    else:
        placed = heads.mapInArrow(_placed(index), schema)
        # Sorted along the curves over ranges of keys; a row's place is the rows of the ranges before plus its place in its own.
        ranges = stage(placed.repartitionByRange("_curve", "_key", "_id").sortWithinPartitions("_curve", "_key", "_id").withColumn("_at", F.monotonically_increasing_id()))
        part = F.shiftright("_at", 33)
        counts = ranges.groupBy("_curve", part.alias("_part")).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
        ahead = Window.partitionBy("_curve").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = stage(counts.withColumn("_ahead", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))))
        rows_at = ranges.withColumn("_part", part).join(offsets, ["_curve", "_part"]).select(
            "_curve", "_id", "_asks", "_vec", (F.col("_at") - F.col("_first") + F.col("_ahead")).alias("_place"))
        rows_at = stage(rows_at)
        window = max(int(np.ceil(window_share * n / 2)), 4 * k)
        share = max(1, -(-(2 * window + BLOCK_ROWS) // BLOCK_QUERIES))
        block = F.floor(F.col("_place") / BLOCK_ROWS)
        left = rows_at.select("_curve", block.alias("_block"), F.explode(F.sequence(F.lit(0), F.lit(share - 1))).alias("_share"), "_id", "_vec", "_place")
        right = rows_at.filter("_asks").select(
            "_curve", F.explode(F.sequence(F.floor(F.greatest(F.col("_place") - window, F.lit(0)) / BLOCK_ROWS), F.floor(F.least(F.col("_place") + window, F.lit(n - 1)) / BLOCK_ROWS))).alias("_block"),
            F.pmod(F.xxhash64("_id"), F.lit(share)).cast("int").alias("_share"), "_id", "_vec", "_place")
        key = ["_curve", "_block", "_share"]
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_best(k + 1, window), out)
    # A row found on several curves has the same score each time: it is computed row by row from the same numbers.
    found = found.groupBy("_query", "_id").agg(F.max("_score").alias("_score"))
    top = found.withColumn("_n", F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("_score"), "_id"))).filter(F.col("_n") <= k + 1)
    lists = stage(top.join(candidates.select("_id", "_ids"), "_id").select("_query", F.explode("_ids").alias("_id"), "_score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return asking.join(lists, "_query").filter(F.col("query_id") != F.col("_id")).select("query_id", F.col("_id").alias(id_col), F.col("_score").alias("score")).withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
