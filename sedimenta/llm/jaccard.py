"""N-gram Jaccard join: documents linked by the overlap of their sets of word n-grams, as a blocked sparse matrix product.

Rows of the matrix are distinct sets, columns n-grams. A pair can only reach the bound if it shares one of the first columns of each row, in
any order common to all rows; so only these columns are multiplied, rare ones first, and the overlap of the pairs that meet there is
then accumulated over whole rows. Sizes that rule a pair out discard it before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.components import connected
from sedimenta.llm.textscan import TOGETHER, gathered, mixed, pack, unpack, word_hashes
from sedimenta.llm.work import ROW, chosen_rows, stage, stored, with_row_number

#: Counters of n-grams by hash; they only choose an order of columns, any order gives the same links.
SKETCH_BITS, SKETCH_CHUNKS, FAN_IN = 22, 16, 256
#: Blocks of columns whose sizes bound an overlap.
BLOCKS = 256
#: Rounds in which a row is compared with one other, at most, before all rows meet that share a column and no component.
ROUNDS = 8


def shingle_sets(texts: list[bytes], width: int, salt: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word n-grams (A-Z in lower case); fewer words than ``width`` are one n-gram,
    no words none."""
    factors = mixed(np.arange(1, width + 2, dtype=np.uint64) + np.uint64(1000 * salt)) | np.uint64(1)
    for part in gathered([len(t) for t in texts], TOGETHER):
        some = [t.lower().split() for t in texts[part]]
        flat = word_hashes([w for ws in some for w in ws])
        sums = np.zeros(max(0, len(flat) - width + 1), np.uint64)
        for j in range(width):
            sums += flat[j: len(flat) - width + 1 + j] * factors[j]
        sums = mixed(sums)
        at = 0
        for ws in some:
            n = len(ws)
            if n >= width:
                yield np.unique(sums[at: at + n - width + 1])
            elif n:
                yield mixed((flat[at: at + n] * factors[:n]).sum(dtype=np.uint64, keepdims=True) + factors[width:] * np.uint64(n))
            else:
                yield np.empty(0, np.uint64)
            at += n


def sketch_of(rows: DataFrame, width: int, salt: int) -> np.ndarray:
    """For each of 2**SKETCH_BITS buckets of n-gram hashes, how common it is, in steps of a fourth root of 2. Of fixed size.

    Partial sketches are added ``FAN_IN`` at a time, in as many levels as the number of partitions needs.
    """
    size = 1 << SKETCH_BITS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(size, np.uint32), 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
            for found in shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), width, salt):
                np.add.at(total, (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if total.any():
            yield pa.record_batch([pa.array([part] * SKETCH_CHUNKS, pa.int64()), pa.array(range(SKETCH_CHUNKS), pa.int32()),
                                   pa.array([pack(x) for x in np.split(total, SKETCH_CHUNKS)], pa.binary())], names=["part", "chunk", "counts"])

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(size // SKETCH_CHUNKS, np.uint64)
        for x in table.column("counts").to_pylist():
            total += unpack(x, np.uint32)
        return pa.table({"part": table.column("part").slice(0, 1), "chunk": table.column("chunk").slice(0, 1),
                         "counts": pa.array([pack(np.minimum(total, 2**32 - 1).astype(np.uint32))], pa.binary())})

    kind = "part long, chunk int, counts binary"
    left = max(1, rows.select(F.lit(1)).rdd.getNumPartitions())
    parts = rows.select(F.spark_partition_id().cast("long").alias("part"), "_text").mapInArrow(partial, kind)
    while True:
        left = -(-left // FAN_IN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "chunk").applyInArrow(added, kind)
        if left == 1:
            break
    total = np.zeros((SKETCH_CHUNKS, size // SKETCH_CHUNKS), np.uint32)
    for r in parts.collect():  # SKETCH_CHUNKS rows
        total[r["chunk"]] = unpack(bytes(r["counts"]), np.uint32)
    return np.minimum(4 * np.log2(np.maximum(total.reshape(-1), 1)), 255).astype(np.uint8)


def _described(width: int, salt: int, num: int, den: int, sketch):
    """Per row: size of its set, two hashes of the set, the first columns of its row (rare buckets first, then by hash), sizes of its blocks."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = sketch.value
        for batch in batches:
            n, first, second, heads, blocks = [], [], [], [], []
            for found in shingle_sets(batch.column(2).cast(pa.binary()).to_pylist(), width, salt):
                size = len(found)
                n.append(size)
                first.append(mixed(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                second.append(mixed(found ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).astype(np.int64))
                head = size - -(-num * size // den) + 1 if size else 0
                order = np.lexsort((found, common[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                heads.append(found[order[:head]].view(np.int64))
                blocks.append(pack(np.minimum(np.bincount((found % np.uint64(BLOCKS)).astype(np.int64), minlength=BLOCKS), 255).astype(np.uint8)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(np.array(first, np.int64)), pa.array(np.array(second, np.int64)),
                                   pa.array(heads, pa.list_(pa.int64())), pa.array(blocks, pa.binary())], names=[ROW, "_id", "n", "_set", "_set2", "_head", "_blocks"])

    return described


def _packed_sets(width: int, salt: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [pack(s, rising=True) for s in shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), width, salt)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["_set", "_columns"])

    return packed


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to pairs with both rows of the matrix the number of columns they share."""
    held: dict[bytes, np.ndarray] = {}

    def row(data: bytes) -> np.ndarray:
        if data not in held:
            if len(held) >= 256:
                held.clear()
            held[data] = unpack(data, np.uint64, rising=True)
        return held[data]

    for batch in batches:
        shared = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = row(x), row(y)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            shared.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()))
        yield pa.record_batch([*(batch.column(i) for i in (0, 1, 4, 5)), pa.array(shared, pa.int64())], names=["a", "b", "na", "nb", "shared"])


def _bounded(num: int, den: int):
    """Keeps the pairs whose block sizes allow enough overlap: two rows share no more columns of a block than either has there."""

    def sizes(column: pa.Array) -> np.ndarray:
        held = np.stack([unpack(x, np.uint8) for x in column.to_pylist()]).astype(np.int64)
        held[held == 255] = 1 << 40  # 255 and more
        return held

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                most = np.minimum(sizes(some.column(4)), sizes(some.column(5))).sum(axis=1)
                total = np.asarray(some.column(2)) + np.asarray(some.column(3))
                yield some.filter(pa.array(most * (den + num) >= num * total)).select(["a", "b", "na", "nb"])

    return bounded


def links_of(pairs: DataFrame, classes: DataFrame, rows: DataFrame, width: int, salt: int, num: int, den: int) -> DataFrame:
    """Of pairs (a, b, na, nb) those whose overlap reaches the bound: ``den * shared >= num * joint``.

    The sizes of ``BLOCKS`` blocks of columns rule most pairs out; of the others both rows are made again from their texts.
    """
    blocks = classes.select("_set", "_blocks")
    left, right = blocks.toDF("a", "x"), blocks.toDF("b", "y")
    open_pairs = stage(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "x", "y").mapInArrow(_bounded(num, den), "a long, b long, na long, nb long"))
    if open_pairs.isEmpty():
        return open_pairs.select("a", "b")
    wanted = open_pairs.select(F.explode(F.array("a", "b")).alias("_set")).distinct()
    at = stage(wanted.join(classes.select("_set", F.col("_best.r").alias("_at")), "_set"))
    sets = stage(rows.join(at, rows[ROW] == at["_at"]).select("_set", "_text").mapInArrow(_packed_sets(width, salt), "_set long, _columns binary"))
    left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
    counted = open_pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "na", "nb").mapInArrow(_overlaps, "a long, b long, na long, nb long, shared long")
    return stage(counted.filter(F.col("shared") * (den + num) >= num * (F.col("na") + F.col("nb"))).select("a", "b"))


def _sized_all(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that their sizes allow."""
    return pairs.filter(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)


def partners(num: int, den: int):
    """For a post (a column at place ``_at`` of a row of ``n``): the largest row that can link with this one if it is the first column they
    share. None of the columns before it is in the other row, so at most ``n - _at`` are."""
    return F.floor(((F.col("n") - F.col("_at")) * (num + den) - F.col("n") * num) / F.lit(num)).cast("long")


def without_repeats(posts: DataFrame) -> DataFrame:
    """Posts (_set, _at, _column, ..) without the columns whose rows all share an earlier column.

    Every pair that meets in such a column meets in the earlier one too; a passage that many documents share is then met
    in a few columns instead of all of its n-grams. Tried are the column that most rows have just before and the one that most begin
    with; whether all rows have it is counted. All rows have their columns in one order, so what a column gives way to comes
    before it, and a first one stays.
    """
    own = Window.partitionBy("_set").orderBy("_at")
    placed = stage(posts.withColumn("_before", F.lag("_column").over(own)).withColumn("_first", F.first("_column").over(own)))
    tried = placed.select("_column", F.explode(F.array_distinct(F.array("_before", "_first"))).alias("_earlier")).filter("_earlier is not null and _earlier != _column")
    tried = tried.groupBy("_column", "_earlier").agg(F.count("*").alias("_both")).join(placed.groupBy("_column").agg(F.count("*").alias("_rows")), "_column")
    # Only a column that at least half of the rows name can be in all of them often enough to be worth the count.
    likely = stage(tried.filter("2 * _both >= _rows").select("_column", "_earlier", "_rows"))
    pairs = placed.select("_set", "_column").join(likely, "_column").join(placed.select("_set", F.col("_column").alias("_earlier")), ["_set", "_earlier"])
    needless = pairs.groupBy("_column", "_earlier", "_rows").agg(F.count("*").alias("_shared")).filter("_shared = _rows").select("_column").distinct()
    return placed.drop("_before", "_first").join(stage(needless), "_column", "left_anti")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 4, den: int = 5, salt: int = 0) -> DataFrame:
    """Per row of ``docs``: _row, the id, n_shingles, component_id (smallest id reachable by links, NULL ids last), first (whether
    this row stands for its component).

    Two documents link when their sets' intersection is at least num/den of their union. Words are runs of other than ASCII white
    space, A-Z in lower case. NULL, empty and wordless texts have no n-grams, link with nothing and are components of
    their own. Sets are of 64-bit hashes of n-grams; no link is lost or made but by a collision inside a pair's two sets.

    Documents with equal sets are one row of the matrix. Columns that several rows share are joined in two steps. First, in some rounds,
    each row is compared with one other: of the rows that stand for its columns, those with the fewest rarer columns, the one it meets most
    often. Near copies fall into components by that. Then rows that share a column but no component meet, all that can link by
    what follows it. Rows of one component need not meet again, so a large group of near copies costs its size and not its
    square. ``docs`` must be a stored table.
    """
    spark = docs.sparkSession
    rows = with_row_number(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))).select(ROW, "_id", "_text")
    sketch = spark.sparkContext.broadcast(sketch_of(rows, width, salt))
    id_type = rows.schema["_id"].dataType.simpleString()
    described = stage(rows.mapInArrow(_described(width, salt, num, den, sketch), f"{ROW} long, _id {id_type}, n long, _set long, _set2 long, _head array<long>, _blocks binary"))
    best = F.min(F.struct(F.col("_id").isNull().alias("z"), F.col("_id").alias("i"), F.col(ROW).alias("r")))
    classes = stage(described.filter("n > 0").groupBy("_set").agg(best.alias("_best"), F.min("n").alias("n"), F.max("n").alias("_n2"), F.min("_set2").alias("_s"), F.max("_set2").alias("_s2"), F.any_value("_blocks").alias("_blocks")))
    if not classes.filter("n != _n2 or _s != _s2").isEmpty():  # two sets with one hash
        return groups(docs, id_col, text_col, width, num, den, salt + 1)

    posts = described.filter("n > 0").select("_set", F.posexplode("_head").alias("_at", "_column"))
    columns = stage(posts.groupBy("_column").agg(F.min("_set").alias("_least"), F.max("_set").alias("_most")).filter("_least != _most").select("_column"))
    posts = without_repeats(posts.join(columns, "_column").distinct()).join(classes.select("_set", "n"), "_set")
    posts = stage(posts.select("_column", "_set", "n", "_at", partners(num, den).alias("_with")))
    met = links = stage(posts.sparkSession.createDataFrame([], "a long, b long"))
    labels = stage(links.toDF("node", "label"))
    for k in range(ROUNDS + 1):
        placed = posts.join(labels.withColumnRenamed("node", "_set"), "_set", "left").withColumn("_part", F.coalesce("label", "_set")).drop("label")
        several = placed.groupBy("_column").agg(F.min("_part").alias("x"), F.max("_part").alias("y")).filter("x != y").select("_column")
        placed = stage(placed.join(several, "_column"))
        if k == ROUNDS or placed.isEmpty() or (k and not _crowded(placed)):
            break
        first = stage(_with_one(placed, k).join(met, ["a", "b"], "left_anti"))
        more = links_of(first, classes, rows, width, salt, num, den)
        met = stage(met.union(first.select("a", "b")))
        if more.isEmpty():
            break
        links = stage(links.union(more))
        labels = stage(connected(links))
    if not placed.isEmpty():
        more = links_of(_across(placed, met, num, den), classes, rows, width, salt, num, den)
        labels = stage(connected(links.union(more))) if not more.isEmpty() else labels

    known = classes.select("_set", "_best").join(labels.withColumnRenamed("node", "_set"), "_set", "left").select("_set", "_best", F.coalesce("label", "_set").alias("_part"))
    known = stage(known)
    smallest = known.groupBy("_part").agg(F.min("_best").alias("_first"))
    found = stage(known.join(smallest, "_part").select("_set", "_first"))
    linked = described.select(ROW, "_id", "n", F.when(F.col("n") > 0, F.col("_set")).alias("_set")).join(found, "_set", "left")
    return linked.select(ROW, F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("_first.i")).otherwise(F.col("_id")).alias("component_id"),
                         F.coalesce(F.col("_first.r") == F.col(ROW), F.lit(True)).alias("first"))


def _crowded(placed: DataFrame) -> bool:
    """Whether parts would meet more often than there are rows to compare with one other; only says if another round is worth it."""
    parts = placed.filter("_with >= n").groupBy("_column").agg(F.count_distinct("_part").alias("k")).agg(F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("meet"))
    return (parts.first()["meet"] or 0) > placed.count()


def _with_one(placed: DataFrame, k: int) -> DataFrame:
    """Pairs (a, b, na, nb) of each row with one of another part: of the rows that stand for its columns, the one it meets most often.

    A row stands for a column if few of its own come before it there: it has little of its own, so other copies are closer to it than to
    one another. Which of several it is depends on the round ``k``.
    """
    one = placed.groupBy("_column").agg(F.min(F.struct("_at", F.xxhash64("_set", F.lit(k)).alias("h"), "_set", "n", "_with", "_part")).alias("o"))
    met = placed.join(one, "_column").filter((F.col("_part") != F.col("o._part")) & (F.col("_with") >= F.col("o.n")) & (F.col("o._with") >= F.col("n")))
    shared = met.groupBy(F.col("_set").alias("x"), F.col("o._set").alias("y"), F.col("n").alias("nx"), F.col("o.n").alias("ny")).agg(F.count("*").alias("c"))
    best = shared.groupBy("x", "nx").agg(F.max(F.struct("c", F.xxhash64("y", F.lit(k)).alias("h"), "y", "ny")).alias("o")).select("x", "nx", "o.y", "o.ny")
    larger = F.col("x") > F.col("y")
    return best.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"), F.when(larger, F.col("nx")).otherwise(F.col("ny")).alias("na"),
                       F.when(larger, F.col("ny")).otherwise(F.col("nx")).alias("nb")).distinct()


def _across(placed: DataFrame, met: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs of rows that share a column but no part, without those that have met before.

    A pair that links does so by what follows the first column it shares, so rows meet only in columns from which on each has enough
    for the other's size (``partners``); in others that they share they need not.
    """
    # Parts that meet in a column, then their rows; the sizes that a part has and admits there rule out most.
    size = placed.select("_part", "_set").distinct().groupBy("_part").agg((F.count("*") == 1).alias("alone"))
    parts = stage(placed.groupBy("_column", "_part").agg(F.min("n").alias("lo"), F.max("_with").alias("hi")).join(size, "_part"))
    meet = parts.alias("p").join(parts.alias("q"), (F.col("p._column") == F.col("q._column")) & (F.col("p._part") < F.col("q._part")) &
                                 (F.col("p.hi") >= F.col("q.lo")) & (F.col("q.hi") >= F.col("p.lo")))
    alone = F.col("p.alone") & F.col("q.alone")
    meet = stage(meet.select(F.when(~alone, F.col("p._column")).alias("_column"), F.col("p._part").alias("_pa"), F.col("q._part").alias("_pb"),
                             *[F.when(alone, F.col(x)).alias(y) for x, y in (("p.lo", "na"), ("q.lo", "nb"))],
                             *[F.when(~alone, F.col(f"q.{x}")).alias(x) for x in ("lo", "hi")]).distinct())
    # A part of one row is named after it, so two of them are the pair itself, in however many columns they meet.
    single = meet.filter("_column is null").select(F.col("_pa").alias("a"), F.col("_pb").alias("b"), "na", "nb")
    left = placed.select("_column", F.col("_part").alias("_pa"), F.col("_set").alias("a"), F.col("n").alias("na"), F.col("_with").alias("wa")).alias("l")
    right = placed.select("_column", F.col("_part").alias("_pb"), F.col("_set").alias("b"), F.col("n").alias("nb"), F.col("_with").alias("wb")).alias("r")
    several = meet.filter("_column is not null").select("_column", "_pa", "_pb", "lo", "hi").alias("m")
    rest = several.join(left, (F.col("m._column") == F.col("l._column")) & (F.col("m._pa") == F.col("l._pa")) & (F.col("wa") >= F.col("lo")) & (F.col("hi") >= F.col("na")))
    rest = rest.select("m._column", "_pb", "a", "na", "wa").alias("x")
    rest = rest.join(right, (F.col("x._column") == F.col("r._column")) & (F.col("x._pb") == F.col("r._pb")) & (F.col("wa") >= F.col("nb")) & (F.col("wb") >= F.col("na"))).select("a", "b", "na", "nb")
    cross = _sized_all(single.union(rest), num, den).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.when(F.col("a") > F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
        F.when(F.col("a") > F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb")).distinct()
    return stage(cross.join(met, ["a", "b"], "left_anti"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with all their columns."""
    docs = stored(docs)
    return chosen_rows(docs, groups(docs, id_col, text_col, width, num, den).filter("first"))
