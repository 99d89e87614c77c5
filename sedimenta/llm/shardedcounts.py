"""Counts of all documents, joined back to the documents that need them, without a row per document and n-gram.

A block is about a partition of the stored documents. Each block sends the distinct keys it holds to shards of the key space, once, with
its counts from the documents to learn from. A shard sums the counts of all blocks, works out a value per key, and sends every block
the values of its own keys; there they meet the block's texts. What moves grows with the distinct keys per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.textscan import mixed, pack, summed, unpack
from sedimenta.llm.work import ROW, stage

#: Rows of a file whose block is stored together, as a power of two.
STRETCH = 9
PACKED = "_shard long, _block long, _kind int, keys binary, counts binary"
VALUES = "_block long, _kind int, keys binary, vals binary"


def in_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` (with row numbers) with its block in ``_block``: the partition of the scan as it is split now. Blocks are stored by
    stretches of rows, so later reads find the same ones, however they are split."""
    stretch = F.shiftright(F.col(ROW), STRETCH)
    blocks = docs.select(stretch.alias("_stretch"), F.spark_partition_id().cast("long").alias("_part")).groupBy("_stretch").agg(F.min("_part").alias("_block"))
    return docs.withColumn("_stretch", stretch).join(F.broadcast(stage(blocks)), "_stretch").drop("_stretch")


def packed_counts(docs: DataFrame, columns: list[str], counted: Callable[[dict], Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]], shards: int) -> DataFrame:
    """Rows (_shard, _block, _kind, keys, counts) of ``docs`` with their blocks: ``counted`` gets the columns of a block's rows that
    follow each other in a task, and yields (kind, keys, counts, what to shard by)."""
    rows = docs.select("_block", *columns)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[tuple[int, list[list]]]:
            for batch in batches:
                block = np.asarray(batch.column(0))
                cut = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
                for begin, end in zip(cut, cut[1:]):
                    if end > begin:
                        columns = batch.slice(begin, end - begin).columns[1:]
                        yield int(block[begin]), [(c.cast(pa.binary()) if pa.types.is_string(c.type) else c).to_pylist() for c in columns]

        for block, run in groupby(runs(), lambda x: x[0]):
            for kind, keys, counts, near in counted(columns for _, columns in run):
                shard = (mixed(near.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in range(shards):
                    part = order[cut[s]: cut[s + 1]]
                    if len(part):
                        yield pa.record_batch([pa.array([s * 2 + kind], pa.int64()), pa.array([block], pa.int64()), pa.array([kind], pa.int32()),
                                               pa.array([pack(keys[part], rising=True)], pa.binary()), pa.array([pack(counts[part].astype(np.uint32))], pa.binary())],
                                              names=["_shard", "_block", "_kind", "keys", "counts"])

    return rows.mapInArrow(packed, PACKED)


def joined(column: pa.ChunkedArray, dtype: type, rising: bool = False) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *(unpack(x, dtype, rising) for x in column.to_pylist())])


def shard_counts(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a shard in order, with their counts over all blocks."""
    return summed(joined(rows.column("keys"), np.uint64, rising=True), joined(rows.column("counts"), np.uint32).astype(np.int64))


def values_per_block(packed: DataFrame, value: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Rows (_block, _kind, keys, vals): for each block the ``value(kind, keys, counts)`` of its keys."""

    def valued(rows: pa.Table) -> pa.Table:
        kind = rows.column("_kind")[0].as_py()
        keys, counts = shard_counts(rows)
        found = value(kind, keys, counts)
        own = rows.column("keys").to_pylist()
        return pa.table({"_block": rows.column("_block"), "_kind": rows.column("_kind"), "keys": rows.column("keys"),
                         "vals": pa.array([pack(found[np.searchsorted(keys, unpack(k, np.uint64, rising=True))]) for k in own], pa.binary())})

    return packed.groupBy("_shard").applyInArrow(valued, VALUES)


def dictionaries(values: pa.Table, kinds: list[tuple[int, type]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind the keys and values that came to a block."""
    out = []
    kind = np.asarray(values.column("_kind")) if values.num_rows else np.empty(0, int)
    for wanted, dtype in kinds:
        rows = values.take(pa.array(np.flatnonzero(kind == wanted)))
        out.append((joined(rows.column("keys"), np.uint64, rising=True), joined(rows.column("vals"), dtype)))
    return out


def shards_for(docs: DataFrame) -> int:
    """As many shards as the documents have blocks, so that a shard holds about as much as a block."""
    return max(2, docs.select(F.lit(1)).rdd.getNumPartitions())


def staged_counts(*args, **kwargs) -> DataFrame:
    return stage(packed_counts(*args, **kwargs))
