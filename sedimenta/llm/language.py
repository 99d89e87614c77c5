"""Language identification: averaged hashed subword embeddings with a linear softmax, trained in numpy, with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

UNDETERMINED = "und"
#: Bytes of text whose subwords are looked up together.
TOGETHER = 1_000_000
#: Lengths in bytes of the subwords.
LENGTHS = (3, 4)


def chunks(texts: list[bytes], most: int = TOGETHER) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) in runs of about ``most`` bytes."""
    begin, n = 0, 0
    for i, text in enumerate(texts):
        n += len(text)
        if n >= most:
            yield begin, texts[begin: i + 1]
            begin, n = i + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:]


def subwords(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, where each text's begin). Texts are folded to lower case (A-Z) and set between spaces.

    Bucket ``2**bits`` marks places where a subword would reach past its text.
    """
    stream = np.frombuffer(b"".join(b" " + t.lower() + b" " for t in texts) + bytes(max(LENGTHS)), np.uint8).astype(np.uint32)
    size = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    found = np.empty((total, len(LENGTHS)), np.int32)
    for k, n in enumerate(LENGTHS):
        code = stream[:total].copy()
        for i in range(1, n):
            code |= stream[i: total + i] << np.uint32(8 * i)
        code = (code * np.uint32(2654435761)) ^ (code >> np.uint32(15))
        found[:, k] = (code * np.uint32(2246822519 + 2 * n)) >> np.uint32(32 - bits)
        for i in range(1, n):
            past = end - i
            found[past[size >= i], k] = 1 << bits
    return found, end - size


@dataclass(frozen=True)
class LanguageModel:
    """Scores of each bucket for each language (embeddings times softmax weights), their bias, and the calibration.

    Of fixed size: 2**bits + 1 rows whatever the corpus.
    """

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        bits = (len(self.table) - 1).bit_length() - 1
        out = np.empty((len(texts), len(self.languages)))
        for at, some in chunks(texts):
            found, start = subwords(some, bits)
            total = np.zeros((len(some), len(self.languages)))
            for k in range(found.shape[1]):
                total += np.add.reduceat(self.table[found[:, k]], start, axis=0)
            held = np.add.reduceat((found < 1 << bits).sum(axis=1), start)
            logits = (total / np.maximum(held, 1)[:, None] + self.bias) / self.temperature
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            out[at: at + len(some)] = p / p.sum(axis=1, keepdims=True)
        return out


#: Parts of a language that are ranked apart.
SHARES = 64


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` texts with a letter of each language, the first by a hash of the id; a repeated row counts once.

    Hashes alone are ranked, first in ``SHARES`` parts of each language, so a language with a third of all rows is gathered nowhere; then the
    texts of the few chosen ones are read.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("_h"), F.col(id_col).cast("string").alias("_i"),
                       F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumn("_t", F.xxhash64("text"))
    order = ["_h", "_i", "_t"]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("_h", "_t"), F.lit(SHARES))).orderBy(*order)
    first = rows.select("lang", *order).withColumn("_n", F.row_number().over(parts)).filter(F.col("_n") <= per_language)
    chosen = first.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("_n") <= per_language).select(
        "lang", "_h", F.coalesce("_i", F.lit("")).alias("_i"), "_t").distinct()
    texts = rows.withColumn("_i", F.coalesce("_i", F.lit(""))).join(chosen, ["lang", *order])
    return texts.groupBy("lang", *order).agg(F.min("text").alias("text")).select("lang", "text")


def _examples(bits: int, fragments: int):
    """Sparse subword counts of whole texts and of short fragments of them, made where the texts are."""

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, index, count = [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode()
                rng = np.random.default_rng(len(data))
                some = [data]
                for _ in range(fragments):
                    n = int(rng.integers(8, 160))
                    begin = int(rng.integers(0, max(1, len(data) - n)))
                    some.append(data[begin: begin + n])
                for part in some:
                    buckets, times = np.unique(subwords([part], bits)[0], return_counts=True)
                    held = buckets < 1 << bits
                    lang.append(name)
                    index.append(buckets[held])
                    count.append(times[held].astype(np.float32))
            yield pa.record_batch([pa.array(lang, pa.string()), pa.array(index, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.float32()))], names=["lang", "index", "count"])

    return examples


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400, bits: int = 15,
          width: int = 16, epochs: int = 12, rate: float = 0.5, fragments: int = 3, seed: int = 7) -> LanguageModel:
    """Fits the model on ``training_rows`` (a documented bound: ``per_language`` rows of each language, as subword counts).

    Stochastic gradient descent on embeddings and softmax weights; a fifth of the examples is kept apart for the temperature
    that calibrates the probabilities. Without any labelled text the model knows no language.
    """
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("index", T.ArrayType(T.IntegerType())), T.StructField("count", T.ArrayType(T.FloatType()))])
    rows = training_rows(docs, id_col, text_col, lang_col, per_language).mapInArrow(_examples(bits, fragments), schema).toArrow()
    names = rows.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    if not languages:
        return LanguageModel((), np.zeros(((1 << bits) + 1, 0)), np.zeros(0), 1.0)
    known = {name: i for i, name in enumerate(languages)}
    y = np.array([known[n] for n in names])
    index = rows.column("index").combine_chunks()
    weight = np.asarray(rows.column("count").combine_chunks().flatten(), np.float64)
    flat, cut = np.asarray(index.flatten()), np.asarray(index.offsets).astype(np.int64)
    cut = cut - cut[0]
    rng = np.random.default_rng(seed)
    order = rng.permutation(np.lexsort((weight[np.minimum(cut[:-1], max(len(weight) - 1, 0))], cut[1:] - cut[:-1], y)))
    apart, used = order[: len(order) // 5], order[len(order) // 5:]
    share = np.bincount(y[used], minlength=len(languages)) if len(used) else np.ones(len(languages))
    balance = 1.0 / np.maximum(share, 1) * len(used) / len(languages)
    table, out, bias = rng.normal(0, 0.1, ((1 << bits), width)), rng.normal(0, 0.1, (width, len(languages))), np.zeros(len(languages))
    g_table, g_out, g_bias = np.full(len(table), 1e-8), np.full(out.shape, 1e-8), np.full(bias.shape, 1e-8)
    for _ in range(epochs):
        for i in rng.permutation(used):
            a, b = cut[i], cut[i + 1]
            if a == b:
                continue
            at, w = flat[a:b], weight[a:b]
            w = w / w.sum()
            mean = w @ table[at]
            p = mean @ out + bias
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= balance[y[i]]
            back = out @ p
            step = np.outer(mean, p)
            g_out += step**2
            g_bias += p**2
            g_table[at] += (w**2) * (back**2).mean()
            out -= rate * step / np.sqrt(g_out)
            bias -= rate * p / np.sqrt(g_bias)
            table[at] -= rate * (w / np.sqrt(g_table[at]))[:, None] * back
    scores = np.vstack([table @ out, np.zeros((1, len(languages)))])

    def logits(which: np.ndarray) -> np.ndarray:
        return np.array([(weight[cut[i]: cut[i + 1]] / max(weight[cut[i]: cut[i + 1]].sum(), 1)) @ scores[flat[cut[i]: cut[i + 1]]] + bias for i in which]).reshape(-1, len(languages))

    held, temperature = logits(apart), 1.0
    if len(apart):
        def loss(t: float) -> float:
            z = held / t
            z -= z.max(axis=1, keepdims=True)
            return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), y[apart]]).mean())

        temperature = min(np.geomspace(0.2, 20, 60), key=loss)
    return LanguageModel(languages, scores, bias, float(temperature))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", reject: float = 0.0) -> DataFrame:
    """Per row of ``docs``: the id, lang_pred, score (calibrated probability).

    ``und`` with score 0 where the text is NULL or has no letter, and where the probability is below ``reject``. Whole texts are
    read; only the text enters a prediction.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.when(has_letter(F.col(text_col)), F.col(text_col)).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            at = [i for i, t in enumerate(texts) if t is not None] if m.languages else []
            names, score = [UNDETERMINED] * n, np.zeros(n)
            if at:
                p = m.probabilities([texts[i] for i in at])
                for i, best, value in zip(at, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    if value >= reject:
                        names[i], score[i] = m.languages[best], min(value, 1.0)
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["_id", "lang_pred", "score"])

    schema = T.StructType([rows.schema["_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(guess, schema).withColumnRenamed("_id", id_col)
