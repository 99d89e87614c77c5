"""Document fingerprints by Order MinHash.

Every k-mer of a text is numbered by its occurrence, so that repetitions count. For each of several hash functions the few
smallest (k-mer, occurrence) pairs are selected, put back in the order they have in the text, and hashed as one tuple. Two
texts agree in an entry of the signature when they share both the selected k-mers and their order, so the share of equal
entries falls with edit distance, not with changes of the set of k-mers alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from sedimenta.llm.textscan import mixed
from sedimenta.llm.work import stage, stored

#: Code points taken up at a time, and about how many different k-mers have their occurrences counted at a time.
SEGMENT = 500_000
#: Columns of the matrix of hash values, and what is added to four pairs per wanted one that are expected at the first attempt.
COLUMNS, EXPECTED = 1_024, 6
#: The largest hash value.
MOST = 2**32 - 1
BASE, FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Bits of a k-mer's hash; the rest of 64 holds a place in a segment.
KMER_BITS = 45
#: Rows that leave a task together.
TOGETHER = 2_000


@dataclass
class Found:
    """Pairs of a text that may be among the smallest: hash function, value, place in the text and k-mer."""

    limit: int
    function: np.ndarray
    value: np.ndarray
    place: np.ndarray
    kmer: np.ndarray

    def before(self, place: int) -> "Found":
        some = self.place < place
        return Found(self.limit, self.function[some], self.value[some], self.place[some], self.kmer[some])


class Sketcher:
    """Signatures of ``hashes`` entries; each entry stands for ``tuples`` k-mers of ``width`` code points."""

    def __init__(self, width: int = 8, tuples: int = 2, hashes: int = 64):
        if min(width, tuples, hashes) < 1 or hashes > 1024 or tuples > 100:
            raise ValueError("width, tuples and hashes are at least 1; tuples at most 100 and hashes at most 1024")
        self.width, self.tuples, self.hashes = width, tuples, hashes
        seeds = mixed(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * BASE).astype(np.uint32)[:, None]
        self.factors, self.turns = seeds[:hashes] | np.uint32(1), seeds[hashes:]
        self.values = np.empty((hashes, COLUMNS), np.uint32)

    def kmers(self, text: str, begin: int, end: int) -> np.ndarray:
        """Hashes of the k-mers that start in [begin, end), of KMER_BITS bits; a text shorter than a k-mer is one itself."""
        width = min(self.width, len(text))
        part = np.frombuffer(text[begin: end + width - 1].encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        size, found, have, left = 1, None, 0, width
        while left:  # hashes of 1, 2, 4, ... code points, put together to the width
            power = np.uint64(pow(int(FOLD), size, 2**64))
            if left & 1:
                found = part if found is None else found[:len(part) - have] * power + part[have:]
                have += size
            left >>= 1
            if left:
                part = part[:-size] * power + part[size:]
                size *= 2
        return mixed(found[:end - begin] + np.uint64(width)) >> np.uint64(64 - KMER_BITS)

    def pairs(self, text: str, first: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(hash of k-mer and occurrence, k-mer, place) for all k-mers that start at ``first`` or later.

        A long text is taken up in segments, once for each class of k-mers, so what is held does not grow with the text: neither
        a very common k-mer nor many different ones.
        """
        n = self.size(text)
        classes = -(-n // SEGMENT)
        for own in range(classes):
            seen, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
            for begin in range(0, n, SEGMENT):
                kmer = self.kmers(text, begin, min(n, begin + SEGMENT))
                place = np.arange(begin, begin + len(kmer))
                if classes > 1:
                    some = kmer % np.uint64(classes) == own
                    kmer, place = kmer[some], place[some]
                    if not len(kmer):
                        continue
                packed = np.sort(kmer << np.uint64(64 - KMER_BITS) | np.arange(len(kmer), dtype=np.uint64))
                value, order = packed >> np.uint64(64 - KMER_BITS), (packed & np.uint64(2**(64 - KMER_BITS) - 1)).astype(np.int64)
                start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
                size = np.diff(np.concatenate([start, [len(value)]]))
                occurrence = np.arange(len(value)) - np.repeat(start, size)
                if classes > 1:
                    distinct = value[start]
                    at = np.searchsorted(seen, distinct)
                    known = at < len(seen)
                    known[known] = seen[at[known]] == distinct[known]
                    earlier = np.zeros(len(distinct), np.int64)
                    earlier[known] = counts[at[known]]
                    occurrence += np.repeat(earlier, size)
                    counts[at[known]] += size[known]
                    seen, counts = np.insert(seen, at[~known], distinct[~known]), np.insert(counts, at[~known], size[~known])
                pair = np.empty(len(kmer), np.uint32)
                pair[order] = ((value + occurrence.astype(np.uint64) * BASE) * FOLD) >> np.uint64(32)
                late = np.searchsorted(place, first)
                yield pair[late:], kmer[late:], place[late:]

    def found(self, text: str, limit: int, first: int = 0) -> Found:
        """Pairs from ``first`` on whose value under a hash function is at most ``limit``."""
        parts: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.uint64))]
        bound = np.uint32(limit)
        for pair, kmer, place in self.pairs(text, first):
            for begin in range(0, len(pair), COLUMNS):
                some = pair[begin: begin + COLUMNS]
                value = self.values[:, :len(some)] if len(some) == COLUMNS else np.empty((self.hashes, len(some)), np.uint32)
                np.bitwise_xor(some, self.turns, out=value)
                np.multiply(value, self.factors, out=value)
                at = np.flatnonzero(value <= bound)
                function = at // len(some)
                column = at - function * len(some)
                parts.append((function, value.reshape(-1)[at], place[begin:][column], kmer[begin:][column]))
        parts = parts[1:] if len(parts) > 1 else parts
        return Found(limit, *(x[0] if len(x) == 1 else np.concatenate(x) for x in zip(*parts)))

    def limit(self, n: int) -> int:
        return min(MOST, (EXPECTED + 4 * self.tuples) * 2**32 // max(n, 1))

    def selected(self, found: Found, n: int) -> np.ndarray | None:
        """The signature, or None where ``found`` holds too few pairs of a text of ``n`` k-mers."""
        wanted = min(self.tuples, n)
        counts = np.bincount(found.function, minlength=self.hashes)
        if found.limit < MOST and counts.min() < wanted:
            return None
        packed = np.sort(found.function.astype(np.uint64) << np.uint64(54) | found.value.astype(np.uint64) << np.uint64(22) | np.arange(len(found.value), dtype=np.uint64))
        order = (packed & np.uint64(2**22 - 1)).astype(np.int64)
        start = np.cumsum(counts) - counts
        chosen = order[start[:, None] + np.arange(wanted)]
        in_text = np.argsort(found.place[chosen], axis=1, kind="stable")
        kmers = np.take_along_axis(found.kmer[chosen], in_text, axis=1)
        entry = np.full(self.hashes, np.uint64(wanted))
        for j in range(wanted):
            entry = mixed(entry * FOLD + kmers[:, j])
        return (entry >> np.uint64(32)).astype(np.uint32)

    def size(self, text: str) -> int:
        """The number of k-mers of a text."""
        return max(len(text) - self.width + 1, min(1, len(text)))

    def sketch(self, text: str, shared: Found | None = None, same: int = 0) -> tuple[np.ndarray, Found]:
        """The signature of ``text``. The first ``same`` k-mers are those of another text, whose ``shared`` pairs are used again.

        The empty text has a signature of zeros.
        """
        n = self.size(text)
        if not n:
            return np.zeros(self.hashes, np.uint32), self.found("", MOST)
        limit = shared.limit if shared else self.limit(n)
        while True:
            if shared and same and shared.limit == limit:
                head, tail = shared.before(same), self.found(text, limit, same)
                found = Found(limit, *(np.concatenate([getattr(head, x), getattr(tail, x)]) for x in ("function", "value", "place", "kmer")))
            else:
                found = self.found(text, limit)
            entries = self.selected(found, n)
            if entries is not None:
                return entries, found
            limit = min(MOST, 4 * limit)


def equal_entries(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def likeness(a: Column, b: Column, hashes: int = 64) -> Column:
    """The share of equal entries of two fingerprints in hexadecimal; 1 for equal texts, 0 where nothing is shared."""
    entry = lambda x, i: F.substring(x, i * 8 + 1, 8)
    equal = F.filter(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: entry(a, i) == entry(b, i))
    return F.size(equal) / F.lit(float(hashes))


def fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", width: int = 8, tuples: int = 2, hashes: int = 64) -> DataFrame:
    """``docs`` with the signature of each whole text in ``out``: 8 hexadecimal digits per entry; a column of that name is replaced.

    NULL counts as empty, and the empty text has zeros only. Nothing is shuffled; equal texts have equal fingerprints.
    """
    sketcher = Sketcher(width, tuples, hashes)

    @F.pandas_udf(T.StringType())
    def digits(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: sketcher.sketch(x)[0].astype(">u4").tobytes().hex())

    return docs.withColumn(out, digits(F.coalesce(F.col(text_col), F.lit(""))))


def edited(text: str, following: str) -> tuple[str, int]:
    """``text`` with its last third replaced by as much of the beginning of ``following``, and the number of code points kept."""
    third = len(text) // 3
    kept = len(text) - third
    return text[:kept] + following[:third], kept


ROWS = T.StructType([
    T.StructField("_kind", T.IntegerType()), T.StructField("_part", T.IntegerType()), T.StructField("_text", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.BinaryType()),
    T.StructField("edited_fingerprint", T.BinaryType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
])
WHOLE, FIRST, LAST = 0, 1, 2


class _Reader:
    """Rows of a task in order: each is compared with its edited text and with the row after it."""

    def __init__(self, sketcher: Sketcher):
        self.sketcher = sketcher

    def against(self, text: str, entries: np.ndarray, found: Found, following: str, next_entries: np.ndarray) -> tuple:
        changed, kept = edited(text, following)
        if changed == text:
            own = entries
        else:
            own, _ = self.sketcher.sketch(changed, found, max(0, kept - self.sketcher.width + 1))
        return (len(text), hashlib.sha256(changed.encode()).hexdigest(), entries.astype(">u4").tobytes(), own.astype(">u4").tobytes(),
                equal_entries(entries, own), equal_entries(entries, next_entries))

    def rows(self, part: int, texts: Iterable[tuple[object, str]]) -> Iterator[tuple]:
        held = None
        for key, text in texts:
            entries, found = self.sketcher.sketch(text)
            if held is None:
                yield None, FIRST, part, text, *(None,) * 6
            else:
                yield held[0], WHOLE, part, None, *self.against(*held[1:], text, entries)
            held = key, text, entries, found
        if held is not None:
            yield held[0], LAST, part, held[1], *(None,) * 6


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= TOGETHER:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*held), schema.types)], schema=schema)


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 8, tuples: int = 2, hashes: int = 64) -> DataFrame:
    """Per row of ``docs``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A text is edited by replacing its last third (rounded down) by the beginning of the next text in descending order of id, as much
    as there is; after the last comes the first. NULL texts count as empty; NULL ids come last; rows of one id are in order of a hash of
    their texts. The likeness of two empty texts is 1. Only id and text are read, so other columns and their names do not matter;
    an empty table gives an empty result.

    The texts move once, into ranges of ids that may split an id's rows. A task compares each row with the one after it; what is left
    at the borders of ranges, one row per task, is joined to the first text of the next range.
    """
    sketcher = Sketcher(width, tuples, hashes)
    docs = stored(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
    own = docs.metadataColumn("_metadata")
    text = F.coalesce("_text", F.lit(""))
    rows = docs.select("_id", text.alias("_text"), F.xxhash64(text).alias("_hash"), F.xxhash64(own["file_path"]).alias("_file"), own["row_index"].alias("_place"))
    order = [F.col("_id").desc_nulls_last(), F.col("_hash"), F.col("_file"), F.col("_place")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_text")
    schema = T.StructType([ranges.schema["_id"], *ROWS.fields])
    arrow = pa.schema([("_id", to_arrow_type(ranges.schema["_id"].dataType)), *((f.name, to_arrow_type(f.dataType)) for f in ROWS.fields)])

    def in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((key.as_py(), text.as_py()) for batch in batches for key, text in zip(batch.column(0), batch.column(1)))
        return _batches(_Reader(sketcher).rows(TaskContext.get().partitionId(), texts), arrow)

    done = stage(ranges.mapInArrow(in_range, schema))
    firsts = done.filter(F.col("_kind") == FIRST).select(F.col("_part").alias("_next"), F.col("_text").alias("_following"))
    parts = done.filter(F.col("_kind") == FIRST).select("_part")
    after = parts.select("_part", F.coalesce(F.lead("_part").over(Window.orderBy("_part")), F.min("_part").over(Window.partitionBy())).alias("_next"))
    lasts = done.filter(F.col("_kind") == LAST).select("_id", "_part", "_text").join(after, "_part").join(firsts, "_next").select("_id", "_text", "_following")

    def at_border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(sketcher)

        def compared() -> Iterator[tuple]:
            for batch in batches:
                for key, text, following in zip(*batch.columns):
                    text, following = text.as_py(), following.as_py()
                    found = sketcher.sketch(text)
                    yield key.as_py(), WHOLE, 0, None, *reader.against(text, *found, following, sketcher.sketch(following)[0])

        return _batches(compared(), arrow)

    whole = done.filter(F.col("_kind") == WHOLE).unionByName(lasts.mapInArrow(at_border, schema))
    digits = [F.lower(F.hex(x)).alias(x) for x in ("fingerprint", "edited_fingerprint")]
    return whole.select(F.col("_id").alias(id_col), "n_chars", "edited_sha256", *digits, "near_edited", "near_next")
