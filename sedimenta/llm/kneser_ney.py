"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text, and quantiles of its perplexity per language.

The model's units are bytes. Before that a word that repeats the two words before it is respelled in control characters, so that running
repetitions, which spell likely words, are as surprising as other text that trusted documents lack.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import shardedcounts
from sedimenta.llm.textscan import TOGETHER, Counts, Lookup, gathered, gram_keys, shard_of_context
from sedimenta.llm.work import ROW, chosen_rows, flagged, ranked, stage, stored, with_row_number

#: Each byte's place in the alphabet of repeated words: the control characters that are no white space.
CONTROL = [b for b in range(32) if not 9 <= b <= 13]
#: Bytes of all languages' usual text that are added to a language's own.
USUAL_BYTES = 2_000
RESPELLED = bytes(CONTROL[b % len(CONTROL)] for b in range(256))


def marked(text: bytes) -> bytes:
    """A text's words with one space between them, those that come a third time running respelled."""
    words = text.split()
    return b" ".join([w if w != before or w != earlier else w.translate(RESPELLED) for earlier, before, w in zip([b"", b"", *words], [b"", *words], words)])


@dataclass
class Order:
    """All (context, byte) of one length of context in a shard, with their counts: of occurrences at full length, else of the distinct
    bytes before them. ``up``: row one byte shorter; ``context``: index of each row's context."""

    counts: np.ndarray
    context: np.ndarray
    up: np.ndarray | None


def orders_of(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[list[Order], np.ndarray]:
    """Orders from ``depth`` to 2 bytes of context, and the keys of the last."""
    out = []
    for d in range(depth, 1, -1):
        name = keys >> np.uint64(8)
        context = np.cumsum(np.concatenate([[True], name[1:] != name[:-1]])) - 1 if len(keys) else np.empty(0, np.int64)
        order = Order(counts, context, None)
        out.append(order)
        if d > 2:
            nearer = ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))
            keys, order.up = np.unique(nearer, return_inverse=True)
            counts = np.bincount(order.up, weights=counts > 0, minlength=len(keys)).astype(np.int64)
    return out, keys


@dataclass(frozen=True)
class Top:
    """Discounts of each order (rows 0 to depth; for counts of one, two, more), and the probability of a byte after one byte.

    Of fixed size.
    """

    discounts: np.ndarray
    after_byte: np.ndarray


def discounts(times: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts from how many n-grams occur once, twice, three and four times (last axis)."""
    n1, n2, n3, n4 = (times[..., i].astype(float) for i in range(4))
    y = n1 / np.maximum(n1 + 2 * n2, 1)
    d = np.stack([1 - 2 * y * n2 / np.maximum(n1, 1), 2 - 3 * y * n3 / np.maximum(n2, 1), 3 - 4 * y * n4 / np.maximum(n3, 1)], axis=-1)
    # Few or odd counts of counts (tiny corpora) can leave the range in which mass is neither lost nor made.
    return np.clip(d, [0.1, 0.1, 0.1], [0.95, 1.9, 2.85])


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What is taken off each count."""
    return np.where(counts <= 0, 0.0, np.where(counts == 1, d[0], np.where(counts == 2, d[1], d[2])))


def top_of(near: np.ndarray, times: np.ndarray) -> Top:
    """From the distinct second bytes before each (byte, byte) and the counts of counts of the longer orders."""
    first = (near > 0).sum(axis=0)  # distinct bytes before a byte
    per_order = np.vstack([counts_of_counts(first), counts_of_counts(near), times])
    d = discounts(per_order)

    def smoothed(counts: np.ndarray, d: np.ndarray, lower: np.ndarray) -> np.ndarray:
        total = counts.sum(axis=-1, keepdims=True)
        off = discounted(counts, d)
        return np.where(total > 0, (counts - off) / np.maximum(total, 1) + off.sum(axis=-1, keepdims=True) / np.maximum(total, 1) * lower, lower)

    single = smoothed(first.astype(float), d[0], np.full(256, 1 / 256))
    return Top(d, smoothed(near.astype(float), d[1], single))


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.array([(counts == i).sum() for i in (1, 2, 3, 4)])


def log_probabilities(keys: np.ndarray, counts: np.ndarray, depth: int, top: Top) -> np.ndarray:
    """log10 of the probability of each key's byte after its context."""
    orders, last = orders_of(keys, counts, depth)
    p = top.after_byte[(last >> np.uint64(16)).astype(int), (last & np.uint64(255)).astype(int)]
    for i in range(len(orders) - 1, -1, -1):
        order, d = orders[i], top.discounts[depth - i]
        off = discounted(order.counts, d)
        total = np.bincount(order.context, weights=order.counts)[order.context]
        left = np.bincount(order.context, weights=off)[order.context]
        if order.up is not None:
            p = p[order.up]
        p = np.where(total > 0, (order.counts - off) / np.maximum(total, 1) + left / np.maximum(total, 1) * p, p)
    return np.log10(p)


def _counted(depth: int):
    def counted(batches: Iterator[list[list]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        grams = Counts()
        for texts, learn in batches:
            for part in gathered([len(t) for t in texts], TOGETHER):
                for weight in (0, 1):
                    for keys, _, _ in gram_keys([marked(t) for t, x in zip(texts[part], learn[part]) if x == bool(weight)], depth):
                        grams.add(keys, weight)
        keys, counts = grams.total()
        if len(keys):
            yield 0, keys, counts, shard_of_context(keys, depth)

    return counted


def _scored(depth: int):
    def scored(docs: pa.Table, values: pa.Table) -> pa.Table:
        lookup = Lookup(*shardedcounts.dictionaries(values, [(0, np.float32)])[0])
        texts = docs.column("_text").cast(pa.large_binary()).to_pylist()
        score, size = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for part in gathered([len(t) for t in texts], TOGETHER):
            some = [marked(t) for t in texts[part]]
            size[part] = [len(t) + 1 for t in some]
            for keys, owner, start in gram_keys(some, depth):
                np.add.at(score, part.start + owner, np.add.reduceat(lookup(keys).astype(float), start))
        return pa.table({**{c: docs.column(c) for c in docs.column_names if c not in ("_text", "_block")}, "n_bytes": size, "score": score})

    return scored


def perplexity(docs: DataFrame, learn: str, id_col: str, text_col: str, also: list[str], depth: int) -> DataFrame:
    """Per row of ``docs`` (a stored table with a row number and the boolean column ``learn``): _row, _id, the columns ``also``,
    n_bytes, score (log10 probability), perplexity per byte, under the model of the rows to learn from."""
    rows = docs.select(ROW, F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.col(learn).alias("_learn"), *also)
    shards = shardedcounts.shards_for(rows)
    rows = shardedcounts.in_blocks(rows)
    packed = shardedcounts.staged_counts(rows, ["_text", "_learn"], _counted(depth), shards)

    def summarised(table: pa.Table) -> pa.Table:
        keys, counts = shardedcounts.shard_counts(table)
        orders, last = orders_of(keys, counts, depth)
        times = np.vstack([counts_of_counts(o.counts) for o in orders[::-1]]).astype(float)
        near = np.zeros((256, 256))
        seen = last[orders[-1].counts > 0]
        np.add.at(near, ((seen >> np.uint64(16)).astype(int), (seen & np.uint64(255)).astype(int)), 1)
        held = np.flatnonzero(near.any(axis=1)).tolist()
        return pa.table({"near": pa.array([*held, 256], pa.int32()), "sums": pa.array([*(near[i].tolist() for i in held), times.reshape(-1).tolist()], pa.list_(pa.float64()))})

    def added(table: pa.Table) -> pa.Table:
        sums = np.array(table.column("sums").to_pylist()).sum(axis=0)
        return pa.table({"near": table.column("near").slice(0, 1), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    kind = "near int, sums array<double>"
    parts = packed.groupBy("_shard").applyInArrow(summarised, kind).groupBy("near").applyInArrow(added, kind).collect()  # 257 rows at most
    near, times = np.zeros((256, 256)), np.zeros((depth - 1, 4))
    for r in parts:
        if r["near"] == 256:
            times = np.array(r["sums"]).reshape(depth - 1, 4)
        else:
            near[r["near"]] = r["sums"]
    top = docs.sparkSession.sparkContext.broadcast(top_of(near, times))
    values = shardedcounts.values_per_block(packed, lambda kind, keys, counts: log_probabilities(keys, counts, depth, top.value).astype(np.float32))
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("_text", "_block"))
    found = rows.groupBy("_block").cogroup(values.groupBy("_block")).applyInArrow(_scored(depth), out + ", n_bytes long, score double")
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_bytes")))


def quantiles(rows: DataFrame, group: str, quantile: float | Column, value: str = "_drawn") -> DataFrame:
    """(group, _value, _total): the exact quantile of ``value`` in each group, between two rows in proportion, and the group's size.

    The quantile may depend on the group's size, the column ``_total``."""
    at = (F.col("_total") - 1) * (F.lit(quantile) if isinstance(quantile, float) else quantile)
    near = ranked(rows.select(group, value, ROW), [group], [value, ROW]).filter((F.col("_index") == F.floor(at)) | (F.col("_index") == F.ceil(at)))
    low, high, share = F.min(value), F.max(value), F.max(at - F.floor(at))
    return stage(near.groupBy(group).agg((low + (high - low) * share).alias("_value"), F.max("_total").alias("_total")))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality", depth: int = 4,
          trusted: int | None = None, quantile: float = 0.995, margin: float = 1.25, prior_bytes: int = 30, spared: int = 4, prior_rows: int = 400) -> DataFrame:
    """Per row of ``docs``: _row, the id, perplexity per byte, threshold, kept.

    Trusted text: documents labelled 1. The model learns from four fifths of them by a hash of the id, all others set the thresholds,
    as what a model has learnt says nothing of how it takes new text. With ``trusted`` it learns from no more than the first so many of
    each language, and the rest sets thresholds too. A short text says little, so its perplexity is drawn towards its language's own, as if
    ``prior_bytes`` of usual text came before it. A document is kept if this is at most ``margin`` times the ``quantile`` that the
    trusted documents of its language have.

    That quantile is the language's median times how far above the median of their language trusted documents lie; in few rows
    this spread is little more than one row's, so it is drawn (in logarithms) towards that of all languages, as
    if ``prior_rows`` rows had it, and the ``spared`` largest rows of a group never set it. So a few wrong labels do not move a threshold, and no
    language needs a least number of rows; one without any takes what holds for all. Without trusted
    documents all are kept. NULL texts are empty, NULL languages are one language. ``docs`` must be a stored table.
    """
    labelled = labels.filter(F.col(label_col) == 1).select(F.col(id_col).cast("string").alias("_key")).filter("_key is not null").distinct()
    rows = with_row_number(docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang")))
    part = F.pmod(F.xxhash64("_key", F.lit("trusted")), F.lit(5))
    known = rows.select(ROW, F.col("_d").cast("string").alias("_key"), "_lang").join(labelled, "_key").select(ROW, "_lang", F.xxhash64("_key").alias("_hash"), "_key", part.alias("_fifth"))
    learns = F.col("_fifth") > 0
    if trusted is not None:
        known, learns = ranked(known, ["_lang"], ["_hash", "_key", ROW]), learns & (F.col("_index") < trusted)
    known = stage(known.select(ROW, learns.alias("_train")))
    rows = flagged(rows, known.filter("_train"), "_fit")
    scored = stage(perplexity(rows, "_fit", "_d", "_t", ["_lang"], depth))
    held = stage(scored.join(known.filter("not _train").select(ROW), ROW).select(ROW, "_lang", "n_bytes", "score"))
    overall = F.broadcast(held.agg((F.sum("score") / F.sum("n_bytes")).alias("_usual_all")))  # one row
    usual = (F.col("_score") + USUAL_BYTES * F.col("_usual_all")) / (F.col("_bytes") + USUAL_BYTES)
    by_lang = held.groupBy("_lang").agg(F.sum("score").alias("_score"), F.sum("n_bytes").alias("_bytes")).crossJoin(overall).select("_lang", usual.alias("_usual"))

    def drawn(rows: DataFrame) -> DataFrame:
        rows = rows.join(by_lang, "_lang", "left").crossJoin(overall)
        typical = F.coalesce("_usual", "_usual_all", F.lit(0.0))
        return rows.withColumn("_drawn", F.pow(F.lit(10.0), -(F.col("score") + prior_bytes * typical) / (F.col("n_bytes") + prior_bytes)))

    cuts = stage(drawn(held).select(ROW, "_lang", F.ln("_drawn").alias("_drawn")))
    most = F.greatest(F.least(F.lit(quantile), 1 - F.lit(float(spared)) / F.col("_total")), F.lit(0.5))
    middle = quantiles(cuts, "_lang", 0.5).select("_lang", F.col("_value").alias("_middle"))
    above = stage(cuts.join(middle, "_lang").withColumns({"_above": F.col("_drawn") - F.col("_middle"), "_all": F.lit(0)}))
    own = quantiles(above, "_lang", most, "_above").select("_lang", F.col("_value").alias("_own"), "_total").join(middle, "_lang")
    # Two tables of one row each (or none).
    of_all = quantiles(above, "_all", most, "_above").agg(F.max("_value").alias("_spread"))
    middle_all = quantiles(above, "_all", 0.5).agg(F.max("_value").alias("_middle_all"))
    spread = (F.col("_own") * F.col("_total") + F.col("_spread") * prior_rows) / (F.col("_total") + prior_rows)
    found = drawn(scored).join(own, "_lang", "left").crossJoin(F.broadcast(of_all.crossJoin(middle_all)))
    threshold = margin * F.exp(F.coalesce("_middle", "_middle_all") + F.coalesce(spread, "_spread"))
    return found.select(ROW, F.col("_id").alias(id_col), F.col("_drawn").alias("perplexity"), threshold.alias("threshold"), F.coalesce(F.col("_drawn") <= threshold, F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    docs = stored(docs)
    return chosen_rows(docs, judge(docs, labels, id_col, text_col, lang_col).filter("kept"))
