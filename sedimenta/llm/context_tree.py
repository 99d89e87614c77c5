"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision, given the bits of its byte before it, has a tree of contexts: the byte before, the
two before, and so on. A node's Krichevsky-Trofimov estimate of its counts is mixed half and half with the product of its children's
mixtures, so every depth takes part, weighted by how well it explains the training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import shardedcounts
from sedimenta.llm.textscan import TOGETHER, WORDS, Counts, Lookup, gathered, gram_keys, runs, shard_of_context, word_hashes
from sedimenta.llm.work import with_row_number

GRAM, WORD = 0, 1
#: Key of the end of a text among the words.
END_WORD = np.uint64(0xFFFFFFFFFFFFFFFF)
LOG2 = np.log(2.0)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, stepped back."""
    x = np.asarray(x, float)
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = np.ones_like(x)
    for i in range(8):
        product *= x + i
    return series - np.log(product)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


@dataclass
class Level:
    """All (context, byte) of one depth. Lists run over the eight bits: node of each row, first row of each node, counts of each node."""

    keys: np.ndarray
    up: np.ndarray | None  # row one depth nearer
    node: list[np.ndarray]
    first: list[np.ndarray]
    zeros: list[np.ndarray]
    ones: list[np.ndarray]


def levels_of(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[Level]:
    """Levels from ``depth`` to ``top`` bytes of context."""
    out = []
    n = counts.astype(float)
    for d in range(depth, top - 1, -1):
        node, first, zeros, ones = [], [], [], []
        for j in range(8):
            name = keys >> np.uint64(8 - j)
            new = np.concatenate([[True], name[1:] != name[:-1]]) if len(name) else np.empty(0, bool)
            index = np.cumsum(new) - 1
            bit = ((keys >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
            count = int(index[-1]) + 1 if len(index) else 0
            node.append(index)
            first.append(np.flatnonzero(new))
            zeros.append(np.bincount(index[~bit], weights=n[~bit], minlength=count))
            ones.append(np.bincount(index[bit], weights=n[bit], minlength=count))
        level = Level(keys, None, node, first, zeros, ones)
        out.append(level)
        if d > top:
            nearer = ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))
            keys, level.up = np.unique(nearer, return_inverse=True)
            n = np.bincount(level.up, weights=n, minlength=len(keys))
    return out


def mixtures(levels: list[Level]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per level and bit: log of the mixture of every node, and the weight its own estimate has in it (1 at full depth)."""
    out: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for i, level in enumerate(levels):
        bits = []
        for j in range(8):
            own = estimate(level.zeros[j], level.ones[j])
            if i == 0:
                bits.append((own, np.ones(len(own))))
                continue
            deeper = levels[i - 1]
            parent = level.node[j][deeper.up[deeper.first[j]]]
            children = np.bincount(parent, weights=out[i - 1][j][0], minlength=len(own))
            total = np.logaddexp(own, children) - LOG2
            bits.append((total, np.exp(own - LOG2 - total)))
        out.append(bits)
    return out


@dataclass(frozen=True)
class Top:
    """Contexts of one byte (rows 0 to 255) and of none (row 256): weight and counts of each decision (1 << bit | bits before it).

    Of fixed size.
    """

    weight: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray


def tree_counts(by_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(zeros, ones) of the 256 decisions from counts of the 256 bytes (last axis)."""
    zeros, ones = np.zeros(by_byte.shape), np.zeros(by_byte.shape)
    for j in range(8):
        grouped = by_byte.reshape(*by_byte.shape[:-1], 1 << j, 2, 1 << (7 - j)).sum(axis=-1)
        zeros[..., 1 << j: 2 << j], ones[..., 1 << j: 2 << j] = grouped[..., 0], grouped[..., 1]
    return zeros, ones


def top_of(children: np.ndarray, by_byte: np.ndarray) -> Top:
    """From, per nearest byte, the sum of the log mixtures of its contexts of two bytes and its counts."""
    zeros, ones = tree_counts(by_byte)
    own = estimate(zeros, ones)
    total = np.logaddexp(own, children) - LOG2
    z0, o0 = zeros.sum(axis=0, keepdims=True), ones.sum(axis=0, keepdims=True)
    own0 = estimate(z0, o0)
    total0 = np.logaddexp(own0, total.sum(axis=0, keepdims=True)) - LOG2
    weight = np.exp(np.vstack([own - LOG2 - total, own0 - LOG2 - total0]))
    return Top(weight, np.vstack([zeros, z0]), np.vstack([ones, o0]))


def summary(keys: np.ndarray, counts: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per nearest byte in a shard: 256 sums of log mixtures over its contexts of two bytes, then 256 counts of bytes."""
    levels = levels_of(keys, counts, depth, 2)
    last, mixed_last = levels[-1], mixtures(levels)[-1]
    near = (last.keys >> np.uint64(16)).astype(np.int64)
    n = np.zeros(len(last.keys))
    # Counts of a (context, byte): the node of its last bit has the byte's count on its own side.
    bit = (last.keys & np.uint64(1)).astype(bool)
    n[:] = np.where(bit, last.ones[7][last.node[7]], last.zeros[7][last.node[7]])
    for c in np.unique(near).tolist():
        out = np.zeros(512)
        rows = near == c
        np.add.at(out, 256 + (last.keys[rows] & np.uint64(255)).astype(int), n[rows])
        for j in range(8):
            first = last.first[j]
            held = near[first] == c
            place = (1 << j) | ((last.keys[first[held]] & np.uint64(255)) >> np.uint64(8 - j)).astype(int)
            np.add.at(out, place, mixed_last[j][0][held])
        yield c, out


def log_probabilities(keys: np.ndarray, counts: np.ndarray, depth: int, top: Top) -> np.ndarray:
    """log10 of the probability of each key's byte after its context."""
    levels = levels_of(keys, counts, depth, 2)
    weights = mixtures(levels)
    out = np.zeros(len(keys))
    byte = (keys & np.uint64(255)).astype(int)
    near = (keys >> np.uint64(8 * depth)).astype(int)
    for j in range(8):
        bit = (byte >> (7 - j)) & 1
        p, row = None, np.arange(len(keys))
        for i, level in enumerate(levels):
            node = level.node[j][row]
            zeros, ones = level.zeros[j][node], level.ones[j][node]
            own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
            weight = weights[i][j][1][node]
            p = own if p is None else weight * own + (1 - weight) * p
            if level.up is not None:
                row = level.up[row]
        place = (1 << j) | (byte >> (8 - j))
        for context in (near, np.full(len(keys), 256)):
            zeros, ones = top.zeros[context, place], top.ones[context, place]
            weight = top.weight[context, place]
            p = weight * (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1) + (1 - weight) * p
        out += np.log10(p)
    return out


def canonical(text: bytes) -> tuple[list[bytes], bytes]:
    """Words of a text with A-Z in lower case, and the text that they make with one space between them."""
    words = text.lower().split()
    return words, b" ".join(words)


def _counted(depth: int):
    """Keys of a block's texts with their counts in those to learn from."""

    def counted(batches: Iterator[list[list]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        grams, words = Counts(), Counts()
        for texts, learn in batches:
            for part in gathered([len(t) for t in texts], TOGETHER):
                for weight in (0, 1):
                    some = [canonical(t) for t, x in zip(texts[part], learn[part]) if x == bool(weight)]
                    for keys, _, _ in gram_keys([t for _, t in some], depth):
                        grams.add(keys, weight)
                    flat = [w for ws, _ in some for w in ws]
                    for run in runs(len(flat), 4 * WORDS):
                        words.add(word_hashes(flat[run]), weight)
                    if some:
                        words.add(np.full(len(some), END_WORD), weight)
        keys, counts = grams.total()
        if len(keys):
            yield GRAM, keys, counts, shard_of_context(keys, depth)
            del grams
            keys, counts = words.total()
            yield WORD, keys, counts, keys

    return counted


def _scored(depth: int):
    def scored(docs: pa.Table, values: pa.Table) -> pa.Table:
        (gram_key, gram_value), (word_key, word_value) = shardedcounts.dictionaries(values, [(GRAM, np.float32), (WORD, np.int64)])
        grams, words = Lookup(gram_key, gram_value), Lookup(word_key, word_value)
        texts = docs.column("_text").cast(pa.large_binary()).to_pylist()
        n = len(texts)
        score, base, tokens, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        end = words(np.array([END_WORD]))[0] if n else 0.0
        for part in gathered([len(t) for t in texts], TOGETHER):
            some = [canonical(t) for t in texts[part]]
            for keys, owner, start in gram_keys([t for _, t in some], depth):
                np.add.at(score, part.start + owner, np.add.reduceat(grams(keys).astype(float), start))
            for i, (ws, _) in enumerate(some):
                at = part.start + i
                tokens[at] = len(ws) + 1
                base[at], known[at] = np.log10(end + 1.0), end > 0
            counts = np.fromiter((len(ws) for ws, _ in some), np.int64, len(some))
            flat = [w for ws, _ in some for w in ws]
            owner = np.repeat(np.arange(len(some)), counts)
            for run in runs(len(flat), 4 * WORDS):
                c = words(word_hashes(flat[run]))
                base[part] += np.bincount(owner[run], weights=np.log10(c + 1.0), minlength=len(some))
                known[part] += np.bincount(owner[run], weights=c > 0, minlength=len(some)).astype(np.int64)
        return pa.table({"_row": docs.column("_row"), "_id": docs.column("_id"), "n_tokens": tokens, "n_known": known, "_base": base, "score": score})

    return scored


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = 5) -> DataFrame:
    """Per row of ``docs``: the id, n_tokens, n_known, train_tokens, base_score, score.

    Texts (NULL: empty) are taken as their words, A-Z in lower case, with one space between them, and then an end. ``score`` is the
    model's log10 probability of these bytes and the end, given the counts of the rows that ``learn`` is true for (NULL: false); the
    model's probabilities of all such texts add up to 1. ``base_score`` is that of single words with one added to their counts; words are counted by
    64-bit hashes. Without any row to learn from every decision has probability 1/2.

    Shards hold all contexts that end in the same two bytes, whole subtrees; the top of the tree (one byte of context, none) is
    summed from at most 256 rows per shard and is of fixed size. ``docs`` must be a stored table.
    """
    spark = docs.sparkSession
    rows = with_row_number(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.coalesce(learn, F.lit(False)).alias("_learn")))
    shards = shardedcounts.shards_for(rows)
    rows = shardedcounts.in_blocks(rows)
    packed = shardedcounts.staged_counts(rows, ["_text", "_learn"], _counted(depth), shards)

    def summarised(table: pa.Table) -> pa.Table:
        keys, counts = shardedcounts.shard_counts(table)
        if table.column("_kind")[0].as_py() == WORD:
            found = [(256, np.array([counts.sum(), (counts > 0).sum()], float))]
        else:
            found = list(summary(keys, counts, depth))
        return pa.table({"near": pa.array([c for c, _ in found], pa.int32()), "sums": pa.array([s.tolist() for _, s in found], pa.list_(pa.float64()))})

    def added(table: pa.Table) -> pa.Table:
        sums = np.array(table.column("sums").to_pylist()).sum(axis=0)
        return pa.table({"near": table.column("near").slice(0, 1), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    kind = "near int, sums array<double>"
    parts = packed.groupBy("_shard").applyInArrow(summarised, kind).groupBy("near").applyInArrow(added, kind).collect()  # 257 rows at most
    children, by_byte, total, distinct = np.zeros((256, 256)), np.zeros((256, 256)), 0.0, 0.0
    for r in parts:
        if r["near"] == 256:
            total, distinct = r["sums"]
        else:
            children[r["near"]], by_byte[r["near"]] = r["sums"][:256], r["sums"][256:]
    top = spark.sparkContext.broadcast(top_of(children, by_byte))

    def value(kind: int, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts if kind == WORD else log_probabilities(keys, counts, depth, top.value).astype(np.float32)

    values = shardedcounts.values_per_block(packed, value)
    id_type = rows.schema["_id"].dataType.simpleString()
    out = rows.select("_block", "_row", "_id", "_text").groupBy("_block").cogroup(values.groupBy("_block")).applyInArrow(
        _scored(depth), f"_row long, _id {id_type}, n_tokens long, n_known long, _base double, score double")
    return out.select("_row", F.col("_id").alias(id_col), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"),
                      (F.col("_base") - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"), "score")
