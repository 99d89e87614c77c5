"""Toxicity of texts that may hide their words: a noisy channel is decoded first, the restored text is scored.

Writers are taken to have passed plain words through a channel that swaps letters for look-alikes, repeats them and sets spaces or marks
between them. What a token may stand for is a lattice of characters; the Viterbi path under a character trigram model restores it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.textscan import gathered, pack, runs, unpack
from sedimenta.llm.work import ROW, flagged, stage, with_row_number

#: Look-alikes and the letters they can stand for.
LOOK_ALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "¢": "c"}
SEPARATORS = frozenset(".-_*~^'`,/\\ ")
#: Cost in nats of a swapped letter, a removed separator, a removed repetition.
SWAP, REMOVE, REPEAT = 0.7, 0.2, 0.3
#: Characters decoded at a time, and how far windows of a longer token or run overlap: more than any hidden word is long.
WINDOW, OVERLAP = 200, 60
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?=[.,;:!?\"')\]]*(?!\S))")
#: How every spaced run ends; cheaper to look for than its beginning.
SPACED_END = re.compile(r"[ \t]\S[ \t]\S(?=[.,;:!?\"')\]]*(?!\S))")
#: A look-alike, a separator or a repeated letter: without one a token stands for itself alone.
HIDDEN = re.compile(r"[0-9@$!|+(€£¥¢.\-_*~^'`,/\\]|([^\W\d_])\1")
#: Marks around a word that hide nothing of it.
AROUND = ".,;:!?\"'()[]{}<>*#%&|-_~"
ENDS = ".,;:!?\"'()[]{}<>*#%&$|-_~"
BITS = 20
#: Parts that the counts of all buckets are sent in, and how many tasks' counts are added up at a time.
CHUNKS, FAN_IN = 16, 256
MEMO = 400_000
#: Bytes of words that are looked up together, and parts of words whose buckets are found at a time.
TOGETHER, PARTS = 3_000_000, 1 << 16
#: Lengths of the beginnings and ends of words that are features.
EDGES = (3, 4, 5, 6)


@dataclass
class CharacterModel:
    """Interpolated character trigrams over words set between spaces."""

    counts: dict[str, int]
    pairs: dict[str, int] = field(init=False)
    heads: dict[str, int] = field(init=False)
    singles: dict[str, int] = field(init=False)

    def __post_init__(self):
        self.pairs, self.heads, self.singles = Counter(), Counter(), Counter()
        for gram, n in self.counts.items():
            self.heads[gram[:2]] += n
            self.pairs[gram[1:]] += n
            self.singles[gram[2]] += n
        self.middles = Counter()
        for gram, n in self.pairs.items():
            self.middles[gram[0]] += n
        self.total = sum(self.singles.values())
        self.memo: dict[str, float] = {}

    def cost(self, before: str, c: str) -> float:
        """-log of the probability of ``c`` after two characters."""
        key = before + c
        value = self.memo.get(key)
        if value is None:
            one = (self.singles.get(c, 0) + 0.5) / (self.total + 0.5 * (len(self.singles) + 1))
            two = (self.pairs.get(key[1:], 0) + 3 * one) / (self.middles.get(key[1], 0) + 3)
            value = -math.log((self.counts.get(key, 0) + 3 * two) / (self.heads.get(before, 0) + 3))
            if len(self.memo) > 500_000:
                self.memo.clear()
            self.memo[key] = value
        return value


def restore(token: str, model: CharacterModel) -> str:
    """The likeliest plain text of a token (lower case); spaced letters can become several words."""
    best: dict[str, tuple[float, str]] = {"  ": (0.0, "")}
    previous = ""
    for c in token:
        following: dict[str, tuple[float, str]] = {}
        if c != previous and c.isalpha() and previous not in SEPARATORS:  # one way on from each state
            for state, (cost, out) in best.items():
                gram = state + c
                price = model.memo.get(gram)
                cost += model.cost(state, c) if price is None else price
                held = following.get(gram[1:])
                if held is None or cost < held[0]:
                    following[gram[1:]] = (cost, out + c)
            best, previous = following, c
            continue

        def reach(state: str, cost: float, out: str) -> None:
            if state not in following or cost < following[state][0]:
                following[state] = (cost, out)

        letters = [(c, 0.0)] if c.isalpha() else [(x, SWAP) for x in LOOK_ALIKES.get(c, "")]
        for state, (cost, out) in best.items():
            for letter, price in letters:
                reach(state[1] + letter, cost + price + model.cost(state, letter), out + letter)
                if previous in SEPARATORS and previous and out and out[-1] != " ":
                    spaced = state[1] + " "
                    reach(" " + letter, cost + price + model.cost(state, " ") + model.cost(spaced, letter), out + " " + letter)
            if c in SEPARATORS:
                reach(state, cost + (0.0 if c == " " else REMOVE), out)
            elif c == previous and out:
                reach(state, cost + REPEAT, out)
            elif not letters:
                reach(state[1] + c, cost + 8.0, out + c)
        best = following
        previous = c
    return min((cost + model.cost(state, " "), out) for state, (cost, out) in best.items())[1]


def plain_words(tokens: set[str]) -> set[str]:
    """Tokens without marks at their ends."""
    return {w.strip(ENDS) for w in tokens}


def words_of(text: str, model: CharacterModel, memo: dict[str, tuple[str, ...]]) -> set[str]:
    """The distinct words of a text and what hidden ones restore to."""
    lower = text.lower()
    tokens = set(lower.split())
    new = tokens.difference(memo)
    tokens -= new
    found = set(chain.from_iterable(map(memo.__getitem__, tokens)))
    for t in new:
        bare = t.strip(AROUND)
        words = (t.strip(ENDS), *(restored_words(bare, model) if HIDDEN.search(bare) else ()))
        if len(t) <= WINDOW:
            if len(memo) >= MEMO:
                memo.clear()
            memo[t] = words
        found.update(words)
    for run in SPACED.findall(lower) if SPACED_END.search(lower) else ():
        found.update(restored_words(run, model))
    found.discard("")
    return found


def restored_words(token: str, model: CharacterModel) -> tuple[str, ...]:
    """The words that a token or a spaced run restores to, each part of it as one too. What is longer than ``WINDOW`` is decoded in
    windows, each of which overlaps the next."""
    found: dict[str, None] = {}
    for begin in range(0, max(1, len(token) - OVERLAP), WINDOW - OVERLAP):
        words = restore(token[begin: begin + WINDOW], model).split()
        found.update(dict.fromkeys([*words, "".join(words)]))
    return tuple(found)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_BYTE = _byte_table()
#: What a CRC holds, before it is inverted at its end, of nothing and of the mark ahead of a word.
_NONE, _HEAD = np.uint32(0xFFFFFFFF), np.uint32(~zlib.crc32(b"^") & 0xFFFFFFFF)


def _advanced(crc: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRCs (not yet inverted) carried on over ``data[begin:end]``, each over its own bytes."""
    crc, size, some = crc.copy(), end - begin, np.arange(len(crc))
    for j in range(int(size.max(initial=0))):
        if (size[some] <= j).any():
            some = some[size[some] > j]
        now = crc[some]
        crc[some] = _BYTE[(now ^ data[begin[some] + j]).astype(np.uint8)] ^ (now >> np.uint32(8))
    return crc


def _ended(crc: np.ndarray, mark: bytes = b"") -> np.ndarray:
    for x in mark:
        crc = _BYTE[(crc ^ np.uint32(x)).astype(np.uint8)] ^ (crc >> np.uint32(8))
    return (~crc >> np.uint32(32 - BITS)).astype(np.int32)


def buckets_of(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Per part of each word, in order: the number of the word, and in a row the buckets of the part, its beginnings and its ends
    (-1: none). A long word has overlapping parts, any other is one part."""
    if not len(words):
        return np.empty(0, np.int64), np.empty((0, 1 + 2 * len(EDGES)), np.int32)
    words = words.cast(pa.string())
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where characters begin
    first = np.searchsorted(at, offsets)
    length = np.diff(first)
    n = np.maximum(1, -(-(length - 32) // 32))
    owners = np.repeat(np.arange(len(words)), n)
    skipped = 32 * (np.arange(len(owners)) - np.repeat(np.cumsum(n) - n, n))
    found = np.full((len(owners), 1 + 2 * len(EDGES)), -1, np.int32)
    for run in runs(len(owners), PARTS):
        owner, own = owners[run], found[run]
        begin = first[owner] + skipped[run]
        size = np.minimum(64, length[owner] - skipped[run])
        end = begin + size
        head, done = np.full(len(owner), _HEAD), begin.copy()
        for i, edge in enumerate(EDGES):
            some = np.flatnonzero(size > edge)
            head[some] = _advanced(head[some], data, at[done[some]], at[begin[some] + edge])
            done[some] = begin[some] + edge
            tail = _advanced(np.full(len(some), _NONE), data, at[end[some] - edge], at[end[some]])
            own[some, 1 + 2 * i], own[some, 2 + 2 * i] = _ended(head[some]), _ended(tail, b"$")
        own[:, 0] = _ended(_advanced(head, data, at[done], at[end]), b"$")
    return owners, found


def features(word: str) -> list[int]:
    """Buckets of a word, its beginnings and its ends; of a long one those of overlapping parts."""
    return [x for x in buckets_of(pa.array([word]))[1].ravel().tolist() if x >= 0]


def together(texts: pa.StringArray) -> Iterator[tuple[slice, np.ndarray, pa.DictionaryArray]]:
    """Texts of words set apart by a space, some at a time: which, whose each word is (from 0), the words."""
    for some in gathered(pc.binary_length(texts).to_pylist(), TOGETHER):
        apart = pc.split_pattern(texts.slice(some.start, some.stop - some.start), " ")
        kept = pc.not_equal(apart.flatten(), "")  # the one word of a text without words
        whose = pc.list_parent_indices(apart).filter(kept).to_numpy(zero_copy_only=False)
        yield some, whose.astype(np.int64), apart.flatten().filter(kept).dictionary_encode()


@dataclass(frozen=True)
class ToxicityModel:
    """Evidence of each bucket (a lower bound of its log odds), weights of a text's strongest words, the character model.

    2**BITS buckets and the distinct character trigrams of the training texts' words.
    """

    evidence: np.ndarray
    weights: np.ndarray
    trigrams: dict[str, int]


def strongest(texts: pa.StringArray, evidence: np.ndarray) -> np.ndarray:
    """Per text of distinct words set apart by a space: evidence of its three strongest words (0 where there are fewer), and the
    number of strong ones, damped."""
    found, known = np.zeros((len(texts), 4)), np.append(evidence, evidence.dtype.type(0))  # last: where a part has no bucket
    for some, whose, words in together(texts):
        of_word, (owner, buckets) = np.zeros(len(words.dictionary), evidence.dtype), buckets_of(words.dictionary)
        np.maximum.at(of_word, owner, known[buckets].max(axis=1))
        values = of_word[words.indices.to_numpy()]
        held = np.flatnonzero(values > 0)
        held = held[np.lexsort((-values[held], whose[held]))]
        text, value = whose[held], values[held].astype(np.float64)
        place = np.arange(len(held)) - np.searchsorted(text, text)
        top = place < 3
        own = found[some]
        own[text[top], place[top]] = value[top]
        own[:, 3] = [math.log1p(n) for n in np.bincount(text[value > 3], minlength=len(own)).tolist()]
    return found


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Per row of ``docs``: _id, _text (NULL: empty), label (0, 1; NULL where there is none or no text), half (of the labelled ids by their hash).

    An id that is labelled several times has its largest label, and a text that comes several times with one id is labelled once. Labels are sent to the texts as a bit per row, so no text moves."""
    rows = with_row_number(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
    key = F.col("_id").cast("string")
    given = labels.select(F.col(id_col).cast("string").alias("_key"), F.col(label_col).cast("int").alias("label")).filter("_key is not null and label in (0, 1)").groupBy("_key").agg(F.max("label").alias("label"))
    known = rows.filter("_text is not null").select(ROW, key.alias("_key"), F.xxhash64("_text").alias("_same")).join(given, "_key")
    known = stage(known.groupBy("_key", "label", "_same").agg(F.min(ROW).alias(ROW)).select(ROW, "label"))
    rows = flagged(flagged(rows, known.filter("label = 1"), "_toxic"), known.filter("label = 0"), "_clean")
    label = F.when(F.col("_toxic"), 1).when(F.col("_clean"), 0)
    return rows.select("_id", F.coalesce("_text", F.lit("")).alias("_text"), label.cast("int").alias("label"), F.pmod(F.xxhash64(key, F.lit("half")), F.lit(2)).cast("int").alias("half"))


def trigrams_of(rows: DataFrame) -> dict[str, int]:
    """How often each character trigram occurs in the distinct words of each labelled text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        grams: Counter = Counter()

        def spell() -> None:
            for word, n in words.items():
                if word.isalpha():
                    padded = f"  {word} "
                    for i in range(len(padded) - 2):
                        grams[padded[i: i + 3]] += n
            words.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update(plain_words(set(text.lower().split())))
                if len(words) >= MEMO:
                    spell()
        spell()
        yield pa.record_batch([pa.array(grams.keys(), pa.string()), pa.array(grams.values(), pa.int64())], names=["gram", "n"])

    found = rows.filter("label is not null").select("_text").mapInArrow(counted, "gram string, n long")
    return {r["gram"]: r["n"] for r in found.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def spelled(rows: DataFrame, trigrams: dict[str, int]) -> DataFrame:
    """``rows`` with the words of each text, restored ones too, in ``words`` in place of ``_text``."""
    shared, kept = rows.sparkSession.sparkContext.broadcast(trigrams), [c for c in rows.columns if c != "_text"]

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = CharacterModel(shared.value), {}
        for batch in batches:
            for run in runs(batch.num_rows, 1024):
                some = batch.slice(run.start, run.stop - run.start)
                found = [" ".join(sorted(words_of(t, model, memo))) for t in some.column("_text").to_pylist()]
                yield pa.record_batch([*map(some.column, kept), pa.array(found, pa.string())], names=[*kept, "words"])

    return rows.mapInArrow(words, ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept), "words string"]))


def restored(rows: DataFrame, trigrams: dict[str, int]) -> DataFrame:
    """What ``spelled`` gives, written once. Words depend on no label, so what learns and what scores can read one copy of them."""
    return stage(spelled(rows, trigrams))


def bucket_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """By half and label, of the labelled ``rows``: texts, and texts by bucket. Counts of tasks are added up ``FAN_IN`` at a time."""
    size = (1 << BITS) // CHUNKS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, seen = np.zeros((2, 2), np.uint32), np.zeros((2, 2, 1 << BITS), np.uint32)
        part = 0
        for batch in batches:
            part = batch.column(0)[0].as_py() if batch.num_rows else part
            label, half = (np.asarray(c) for c in batch.columns[1:3])
            np.add.at(texts, (half, label), 1)
            for some, whose, words in together(batch.column(3)):
                owner, buckets = buckets_of(words.dictionary)
                word = words.indices.to_numpy()
                n = np.bincount(owner, minlength=len(words.dictionary))
                times, ahead = n[word], (np.cumsum(n) - n)[word]
                rows = np.repeat(ahead - np.cumsum(times) + times, times) + np.arange(times.sum())
                held = buckets[rows]
                held = ((np.repeat(whose, times) << BITS)[:, None] | held)[held >= 0]
                held.sort()
                held = held[np.diff(held, prepend=-1) > 0]
                group = (2 * half[some] + label[some])[held >> BITS]
                for g in (0, 1, 2, 3):
                    seen[g // 2, g % 2] += np.bincount(held[group == g] & ((1 << BITS) - 1), minlength=1 << BITS).astype(np.uint32)
        groups = [(h, x) for h in (0, 1) for x in (0, 1) if texts[h, x]]
        for h, x in groups:
            yield pa.record_batch([pa.array([part] * CHUNKS, pa.int64()), pa.array([(2 * h + x) * CHUNKS + i for i in range(CHUNKS)], pa.int32()), pa.array([int(texts[h, x])] * CHUNKS, pa.int64()),
                                   pa.array([pack(c) for c in np.split(seen[h, x], CHUNKS)], pa.binary())], names=["part", "chunk", "texts", "counts"])

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.uint64)
        for c in table.column("counts").to_pylist():
            total += unpack(c, np.uint32)
        return pa.table({"part": table.column("part").slice(0, 1), "chunk": table.column("chunk").slice(0, 1), "texts": pa.array([sum(table.column("texts").to_pylist())], pa.int64()),
                         "counts": pa.array([pack(np.minimum(total, 2**32 - 1).astype(np.uint32))], pa.binary())})

    kind = "part long, chunk int, texts long, counts binary"
    some = rows.filter("label is not null").select(F.spark_partition_id().cast("long").alias("part"), "label", "half", "words")
    left = max(1, some.rdd.getNumPartitions())
    parts = some.mapInArrow(partial, kind)
    while True:
        left = -(-left // FAN_IN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "chunk").applyInArrow(added, kind)
        if left == 1:
            break
    texts, seen = np.zeros((2, 2)), np.zeros((2, 2, CHUNKS, size))
    for r in parts.collect():  # 4 * CHUNKS rows at most
        half, label, chunk = r["chunk"] // CHUNKS // 2, r["chunk"] // CHUNKS % 2, r["chunk"] % CHUNKS
        texts[half, label], seen[half, label, chunk] = r["texts"], unpack(bytes(r["counts"]), np.uint32)
    return texts, seen.reshape(2, 2, -1)


def _evidence(with_it: np.ndarray, without: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Lower bound (one deviation) of the log odds a bucket gives, at 0 where it speaks against toxicity or says nothing."""
    odds = np.log((with_it + 0.5) / (toxic + 1)) - np.log((without + 0.5) / (clean + 1))
    return np.maximum(odds - np.sqrt(1 / (with_it + 0.5) + 1 / (without + 0.5)), 0) * (with_it >= 2)


def fitted(words: DataFrame, trigrams: dict[str, int], share: float) -> ToxicityModel:
    """The model of all labelled rows of ``words``; ``share`` is the rate of label 1.

    Evidence is counted in two halves; each half's texts are then described by the other half's evidence, and a logistic
    regression on these descriptions turns the strongest words of a text into a probability, at that rate.
    """
    texts, seen = bucket_counts(words)
    parts = [_evidence(seen[h, 1], seen[h, 0], texts[h, 1], texts[h, 0]).astype(np.float32) for h in (0, 1)]
    evidence = _evidence(seen[:, 1].sum(0), seen[:, 0].sum(0), texts[:, 1].sum(), texts[:, 0].sum()).astype(np.float32)
    shared = words.sparkSession.sparkContext.broadcast(parts)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half, x = np.asarray(batch.column(1)), np.zeros((batch.num_rows, 4))
            for h in (0, 1):
                x[half == h] = strongest(batch.column(2).filter(pa.array(half == h)), shared.value[1 - h])
            yield pa.record_batch([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"])

    rows = stage(words.filter("label is not null").select("label", "half", "words").mapInArrow(described, "label int, x array<double>"))
    return ToxicityModel(evidence, _logistic(rows, texts.sum(0), share), trigrams)


def _rate(labels: DataFrame, label_col: str) -> float:
    given = {r["label"]: r["n"] for r in labels.select(F.col(label_col).cast("int").alias("label")).groupBy("label").agg(F.count("*").alias("n")).collect()}
    return given.get(1, 0) / max(1, given.get(0, 0) + given.get(1, 0))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fits the model on all texts with a label, at the labels' own rate."""
    rows = labelled(docs, labels, id_col, text_col, label_col).filter("label is not null")
    trigrams = trigrams_of(rows)
    return fitted(restored(rows, trigrams), trigrams, _rate(labels, label_col))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.3) -> DataFrame:
    """What ``score`` gives of ``docs`` under the model that ``train`` fits, with the words of each text restored only once."""
    rows = labelled(docs, labels, id_col, text_col, label_col)
    trigrams = trigrams_of(rows)
    words = restored(rows, trigrams)
    model = fitted(words, trigrams, _rate(labels, label_col))
    return _scores(words.select("_id", "words"), model, threshold).withColumnRenamed("_id", id_col)


def _logistic(rows: DataFrame, given: np.ndarray, share: float) -> np.ndarray:
    """Weights and bias by Newton's method with a small ridge; rows (label, x) are weighted so that label 1 has the given share.

    ``given`` holds the number of rows of each label. Each step sums gradient and curvature over all rows, a row per task."""
    w = np.zeros(5)
    if not given.all():
        w[-1] = math.log((share + 1e-3) / (1 - share + 1e-3))
        return w
    toxic = given[1] / given.sum()
    rates = np.array([(1 - share) / (1 - toxic), share / toxic])
    ridge = np.diag([0.5] * 4 + [1e-3])

    def summed(w: np.ndarray):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, part = np.zeros(30), 0
            for batch in batches:
                if batch.num_rows:
                    part, y = batch.column(0)[0].as_py(), np.asarray(batch.column(1))
                    x = np.hstack([np.asarray(batch.column(2).flatten()).reshape(len(y), 4), np.ones((len(y), 1))])
                    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                    total[:25] += ((x * (rates[y] * p * (1 - p))[:, None]).T @ x).reshape(-1)
                    total[25:] += x.T @ (rates[y] * (p - y))
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part", "sums"])

        return sums

    placed = rows.select(F.spark_partition_id().alias("part"), "label", "x")
    for _ in range(50):
        sums = sorted((r["part"], r["sums"]) for r in placed.mapInArrow(summed(w), "part int, sums array<double>").collect())
        total = np.array([x for _, x in sums]).sum(axis=0)
        step = np.linalg.solve(total[:25].reshape(5, 5) + ridge, total[25:] + ridge @ w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: the id, score (0 to 1), predicted (1 from ``threshold`` on). NULL and empty texts have no words and get
    the model's score for that. Whole texts are read; only the text enters a score."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return _scores(spelled(rows, model.trigrams), model, threshold).withColumnRenamed("_id", id_col)


def _scores(rows: DataFrame, model: ToxicityModel, threshold: float) -> DataFrame:
    """(_id, score, predicted) of rows of an id and a text's words."""
    shared = rows.sparkSession.sparkContext.broadcast((model.evidence, model.weights))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence, weights = shared.value
        for batch in batches:
            x = np.hstack([strongest(batch.column(1), evidence), np.ones((batch.num_rows, 1))])
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["_id", "score", "predicted"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"_id {kind}, score double, predicted int")
