"""Importance resampling towards a target distribution of hashed word n-grams.

The distinct words of a block of texts, each between two delimiters, form an Aho-Corasick automaton whose entries carry the
word's CRC-32 and length. A scan of the block emits these payloads in order; the CRC of a run of words follows from the payloads of
its words alone, without the run's bytes, and its remainder is the run's bucket. Buckets are counted over the raw and the target
texts, and every document is weighed by the log ratio of the two smoothed distributions. Gumbel noise on the weights turns "the
largest" into a draw without replacement.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.work import ranked, stage, with_row_number

#: Bytes of texts scanned with one automaton.
BLOCK = 1_000_000
DELIMITER = b" "
#: What is kept of a byte: digits, letters in lower case and every byte of a character outside ASCII; others are delimiters.
_KEPT = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else DELIMITER[0] for x in range(256))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_BYTE = _crc_table()


class CrcShift:
    """CRCs of what they were of, followed by any number of zero bytes: a linear map, kept as tables for 1, 2, 4, ... bytes."""

    def __init__(self):
        column = [(np.uint32(0xFF) & np.arange(256, dtype=np.uint32)) << np.uint32(8 * i) for i in range(4)]
        self.tables = [[_BYTE[c & np.uint32(0xFF)] ^ (c >> np.uint32(8)) for c in column]]

    def _apply(self, table: list[np.ndarray], crc: np.ndarray) -> np.ndarray:
        found = table[0][crc & np.uint32(0xFF)]
        for i in range(1, 4):
            found = found ^ table[i][(crc >> np.uint32(8 * i)) & np.uint32(0xFF)]
        return found

    def __call__(self, crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        crc, bit = crc.copy(), 0
        most = int(zeros.max()) if len(zeros) else 0
        while most >> bit:
            if bit == len(self.tables):
                self.tables.append([self._apply(self.tables[-1], column) for column in self.tables[-1]])
            some = (zeros >> bit) & 1 == 1
            crc[some] = self._apply(self.tables[bit], crc[some])
            bit += 1
        return crc

    def joined(self, crc: np.ndarray, following: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The CRC of two strings, the second of ``length`` bytes, from those of each."""
        return self(crc, length) ^ following


_SPACE = np.uint32(zlib.crc32(b" "))


def normalised(text: str) -> bytes:
    """A text in UTF-8 with A-Z in lower case and a delimiter for every byte that is in no word."""
    return text.encode().translate(_KEPT)


def automaton(words: Iterable[bytes]) -> ahocorasick.Automaton:
    """Matches each word between two delimiters; an entry is the word's CRC-32 and, above it, its length."""
    found = ahocorasick.Automaton()
    edge = DELIMITER.decode()
    for word in words:
        found.add_word(edge + word.decode("latin-1") + edge, zlib.crc32(word) | len(word) << 32)
    found.make_automaton()
    return found


def payloads(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, CRC, length) of each word of normalised bytes in order. A word ends at the delimiter after it."""
    words = set(data.split(DELIMITER)) - {b""}
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64)
    text = (DELIMITER + data + DELIMITER).decode("latin-1")
    flat = np.fromiter(chain.from_iterable(automaton(words).iter(text)), np.int64)
    entry = flat[1::2]
    return flat[::2] - 1, (entry & 0xFFFFFFFF).astype(np.uint32), entry >> 32


def _parts(texts: Iterable[str]) -> Iterator[tuple[int, bytes]]:
    """(number of the text, normalised bytes), a long text cut at delimiters into parts of about BLOCK bytes."""
    for i, text in enumerate(texts):
        begin = 0
        while len(text) - begin > BLOCK:
            end = begin + BLOCK
            data = normalised(text[begin:end])
            cut = data.rfind(DELIMITER) + 1
            while not cut and end < len(text):  # a word longer than a block
                more = normalised(text[end: end + BLOCK])
                cut = more.find(DELIMITER) + 1
                data, end, cut = data + more, end + BLOCK, cut and len(data) + cut
            if not cut:
                yield i, data
                begin = len(text)
                break
            yield i, data[:cut]
            # What stands after the cut is taken up again; it is whole characters, as a delimiter is one byte.
            begin = min(end, len(text)) - len(data[cut:].decode())
        if begin < len(text) or not text:
            yield i, normalised(text[begin:])


def buckets_of(texts: Iterable[str], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of every run of 1 to ``longest`` consecutive words, some blocks of texts at a time."""
    shift = CrcShift()
    held: list[tuple[int, bytes]] = []
    size = 0
    last_text, carried = -1, (np.empty(0, np.uint32), np.empty(0, np.int64))

    def scanned(some: list[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nonlocal last_text, carried
        ends = np.cumsum([len(data) + 1 for _, data in some])
        end, crc, length = payloads(DELIMITER.join(data for _, data in some))
        owner = np.fromiter((i for i, _ in some), np.int64, len(some))[np.searchsorted(ends, end, side="left")]
        if len(carried[0]) and some[0][0] == last_text:  # words of the same text before this block
            before = len(carried[0])
            crc, length = np.concatenate([carried[0], crc]), np.concatenate([carried[1], length])
            owner = np.concatenate([np.full(before, last_text), owner])
        else:
            before = 0
        run = crc
        for n in range(1, longest + 1):
            if n > 1:
                run = shift.joined(shift.joined(run[:-1], np.full(max(0, len(run) - 1), _SPACE), np.ones(max(0, len(run) - 1), np.int64)), crc[n - 1:], length[n - 1:])
            new = slice(max(0, before - n + 1), None)
            same = owner[: len(run)][new] == owner[n - 1:][new]
            yield owner[n - 1:][new][same], (run[new][same] % np.uint32(buckets)).astype(np.int64)
            if len(run) < 2:
                break
        last_text = some[-1][0]
        own = owner == last_text
        keep = max(0, longest - 1)
        carried = (crc[own][-keep:], length[own][-keep:]) if keep else carried

    for part in _parts(texts):
        held.append(part)
        size += len(part[1])
        if size >= BLOCK:
            yield from scanned(held)
            held, size = [], 0
    if held:
        yield from scanned(held)


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs in the column ``_text``. A task sends one row per bucket it has; the driver gets ``buckets`` at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket in buckets_of((x.as_py() for x in batch.column(0)), longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    found = texts.select(F.coalesce("_text", F.lit("")).alias("_text")).mapInArrow(counted, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + b) / ((s + 1)(T + b)))) of each of b buckets with s of S features in raw and t of T in target texts."""
    buckets, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_raw + buckets) / ((s + 1.0) * (all_target + buckets)))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def noise(key: object, seed: int) -> int:
    """floor(1000 g) of standard Gumbel noise that the id alone decides; a NULL id counts as the empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, _words, n_features, weight (sum of the gains of its features) and score (weight and noise)."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    buckets = len(gain)
    names = ["_words", "n_features", "weight", "score"]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            totals = np.zeros((3, n), np.int64)  # words, features, weight
            last = -1
            for i, (text, bucket) in enumerate(buckets_of((x.as_py() for x in batch.column(1)), longest, buckets)):
                np.add.at(totals[1], text, 1)
                np.add.at(totals[2], text, gain[bucket])
            # Runs of 2 to k words are as many as the number of words allows.
            totals[0] = _words(totals[1], longest)
            score = totals[2] + np.fromiter((noise(x.as_py(), seed) for x in batch.column(0)), np.int64, n)
            yield pa.record_batch([batch.column(0), *(pa.array(x, pa.int64()) for x in (*totals, score))], names=["_id", *names])

    schema = T.StructType([rows.schema["_id"], *(T.StructField(x, T.LongType()) for x in names)])
    return rows.mapInArrow(weighed, schema)


def _words(features: np.ndarray, longest: int) -> np.ndarray:
    """The number of words of a text from its number of runs of 1 to ``longest`` words."""
    words = np.zeros_like(features)
    few = np.array([sum(max(0, w - n + 1) for n in range(1, longest + 1)) for w in range(longest + 1)])
    short = features < few[-1]
    words[short] = np.searchsorted(few, features[short])
    words[~short] = (features[~short] - few[-1]) // longest + longest
    return words


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, share: tuple[int, int] = (10, 100), least_words: int = 20,
             seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_features, weight, score, rank (1, 2, ... among the drawn rows; NULL for the others).

    Words are what is left between characters of ASCII that are no letter or digit, with A-Z in lower case. Of the N documents with
    at least ``least_words`` words the floor(N share) with the highest scores are drawn, ties to the smaller id (NULL last), then
    to the smaller number of features; rows that agree in all columns are interchangeable. NULL texts have no words. With no
    target text, or no document, all buckets have the same target probability. Only id and text are read, so other columns and their
    names do not matter; an empty table gives an empty result.

    Counting sends one row per task and bucket; the driver holds ``buckets`` numbers. Ranks come from ranges of narrow rows, so
    nothing is ordered in one task.
    """
    raw = bucket_counts(docs.select(F.col(text_col).alias("_text")), longest, buckets)
    wanted = bucket_counts(target.select(F.col(text_col).alias("_text")), longest, buckets)
    scored = stage(weigh(docs, gains(raw, wanted), longest, seed, id_col, text_col))
    enough = F.col("_words") >= least_words
    drawn = scored.filter(enough).count() * share[0] // share[1]
    order = with_row_number(scored.filter(enough)).withColumns({"_down": -F.col("score"), "_no_id": F.col("_id").isNull()})
    placed = ranked(order, [], ["_down", "_no_id", "_id", "n_features", "_row"])
    rank = F.when(F.col("_index") < drawn, F.col("_index") + 1)
    columns = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    return placed.select(*columns, rank.cast("long").alias("rank")).unionByName(scored.filter(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))
