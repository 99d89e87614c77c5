"""Context trees and Kneser-Ney against their definitions."""

import math
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import context_tree, kneser_ney
from sedimenta.llm.textscan import BEFORE, END, Counts, Lookup, gram_keys, pack, unpack, word_hashes
from sedimenta.llm.work import ROW, flagged, with_row_number
from tests.llm.conftest import DOCS, ODD


def keyed(texts, learn, depth):
    counts = Counts()
    for t, x in zip(texts, learn):
        for keys, _, _ in gram_keys([t], depth):
            counts.add(keys, int(x))
    return counts.total()


def grams(text, depth):
    """((nearest byte, .., farthest byte), byte) for every byte and the end."""
    whole = bytes([BEFORE]) * depth + text + bytes([END])
    return [(tuple(whole[i - 1: i - depth - 1: -1] if i > depth else whole[:depth][::-1]), whole[i]) for i in range(depth, len(whole))]


def texts(seed, n=24):
    rng = np.random.default_rng(seed)
    return [bytes(rng.choice([97, 98, 32], size=rng.integers(0, 18)).astype(np.uint8)) for _ in range(n)]


def in_shards(keys, depth):
    near = keys >> np.uint64(8 * (depth - 1))
    return [near == s for s in np.unique(near)]


def context_tree_values(keys, counts, depth):
    children, by_byte = np.zeros((256, 256)), np.zeros((256, 256))
    for rows in in_shards(keys, depth):
        for c, sums in context_tree.summary(keys[rows], counts[rows], depth):
            children[c] += sums[:256]
            by_byte[c] += sums[256:]
    top, out = context_tree.top_of(children, by_byte), np.zeros(len(keys))
    for rows in in_shards(keys, depth):
        out[rows] = context_tree.log_probabilities(keys[rows], counts[rows], depth, top)
    return out


def kneser_ney_values(keys, counts, depth):
    near, times = np.zeros((256, 256)), np.zeros((depth - 1, 4))
    for rows in in_shards(keys, depth):
        orders, last = kneser_ney.orders_of(keys[rows], counts[rows], depth)
        times += np.vstack([kneser_ney.counts_of_counts(o.counts) for o in orders[::-1]])
        seen = last[orders[-1].counts > 0]
        np.add.at(near, ((seen >> np.uint64(16)).astype(int), (seen & np.uint64(255)).astype(int)), 1)
    top, out = kneser_ney.top_of(near, times), np.zeros(len(keys))
    for rows in in_shards(keys, depth):
        out[rows] = kneser_ney.log_probabilities(keys[rows], counts[rows], depth, top)
    return out, top


def as_key(context, byte):
    key = 0
    for c in (*context, byte):
        key = key << 8 | c
    return key


def with_all_bytes(keys, counts, depth):
    """All 256 bytes after one of the contexts, too."""
    context = keys[len(keys) // 2] >> np.uint64(8)
    every = np.unique(np.concatenate([keys, (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)]))
    n = np.zeros(len(every), np.int64)
    n[np.searchsorted(every, keys)] = counts
    return every, n, (every >> np.uint64(8)) == context


def test_keys_hold_byte_and_context():
    some = texts(1) + [b"", b"abc" * 5]
    got = [k for keys, _, _ in gram_keys(some, 3) for k in keys.tolist()]
    assert got == [as_key(*g) for t in some for g in grams(t, 3)]


def test_long_texts_are_taken_in_parts(monkeypatch):
    from sedimenta.llm import textscan

    whole = [k for keys, _, _ in gram_keys([b"some words in a row" * 9, b"x"], 4) for k in keys.tolist()]
    monkeypatch.setattr(textscan, "SEGMENT", 7)
    assert [k for keys, _, _ in gram_keys([b"some words in a row" * 9, b"x"], 4) for k in keys.tolist()] == whole


def test_context_tree_equals_its_definition():
    depth, some = 3, texts(2)
    learn = [i % 3 > 0 for i in range(len(some))]
    keys, counts = keyed(some, learn, depth)
    every, n, same = with_all_bytes(keys, counts, depth)
    got = context_tree_values(every, n, depth)
    assert abs((10 ** got[same]).sum() - 1) < 1e-12
    seen = Counter(g for t, x in zip(some, learn) if x for g in grams(t, depth))

    def mixture(context, prefix, j, more):
        """log probability that the tree of a decision gives the training bits, and one more after a context."""
        zeros = ones = 0
        below = set()
        for (c, b), k in [*seen.items(), *more]:
            if c[: len(context)] == context and b >> (8 - j) == prefix:
                below.add(c[: len(context) + 1])
                zeros, ones = zeros + k * (1 - (b >> (7 - j) & 1)), ones + k * (b >> (7 - j) & 1)
        own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
        if len(context) == depth:
            return own
        return np.logaddexp(own, sum(mixture(c, prefix, j, more) for c in below)) - math.log(2)

    for g in [grams(some[5], depth)[-1], grams(some[3], depth)[1], grams(some[0], depth)[-1]]:
        want = sum(mixture((), g[1] >> (8 - j), j, [(g, 1)]) - mixture((), g[1] >> (8 - j), j, []) for j in range(8))
        assert got[np.searchsorted(every, np.uint64(as_key(*g)))] == pytest.approx(want / math.log(10), abs=1e-8)


def test_kneser_ney_equals_its_definition():
    depth, some = 3, texts(3)
    learn = [i % 4 > 0 for i in range(len(some))]
    keys, counts = keyed(some, learn, depth)
    every, n, same = with_all_bytes(keys, counts, depth)
    got, top = kneser_ney_values(every, n, depth)
    assert abs((10 ** got[same]).sum() - 1) < 1e-12
    seen = Counter(g for t, x in zip(some, learn) if x for g in grams(t, depth))
    by_order = {depth: dict(seen)}
    for d in range(depth - 1, -1, -1):
        lower = defaultdict(int)
        for (c, b), k in by_order[d + 1].items():
            lower[c[:d], b] += k > 0
        by_order[d] = dict(lower)

    @cache
    def probability(context, byte):
        d = len(context)
        lower = probability(context[:-1], byte) if d else 1 / 256
        held = {b: k for (c, b), k in by_order[d].items() if c == context}
        if not held:
            return lower
        off = {b: top.discounts[d][min(k, 3) - 1] for b, k in held.items()}
        return (held.get(byte, 0) - off.get(byte, 0) + sum(off.values()) * lower) / sum(held.values())

    for t in some[:6]:
        for c, b in grams(t, depth):
            assert got[np.searchsorted(every, np.uint64(as_key(c, b)))] == pytest.approx(math.log10(probability(c, b)), abs=1e-9)


def test_lookup_and_packing():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    values = rng.normal(size=len(keys))
    assert (Lookup(keys, values)(keys[::-1]) == values[::-1]).all()
    with pytest.raises(LookupError):
        Lookup(keys, values)(keys[:1] + np.uint64(1))
    assert (unpack(pack(keys, rising=True), np.uint64, rising=True) == keys).all()
    assert (unpack(pack(values), np.float64) == values).all()
    assert len(unpack(pack(keys[:0], rising=True), np.uint64)) == 0
    words = [b"", b"a", b"ab", b"ba", "été".encode(), b"x" * 5000]
    assert len(set(word_hashes(words[1:]).tolist())) == 5


def test_scores_of_documents(odd, clashing, empty):
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1
    got = {(r["doc_id"], r["n_tokens"]): r for r in context_tree.score(odd, learn, depth=3).collect()}
    some = [((r[1] or "").encode().lower().split(), (r[0] or 0) % 3 != 1, r[0]) for r in ODD]
    counts = Counter(w for ws, x, _ in some if x for w in [*ws, None])
    total, distinct = sum(counts.values()), len(counts)
    for ws, _, doc_id in some:
        r = got[doc_id, len(ws) + 1]
        tokens = [*ws, None]
        assert r["train_tokens"] == total and r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens), rel=1e-9)
    keys, n = keyed([b" ".join(ws) for ws, _, _ in some], [x for _, x, _ in some], 3)
    value = dict(zip(keys.tolist(), context_tree_values(keys, n, 3)))
    for ws, _, doc_id in some:
        assert got[doc_id, len(ws) + 1]["score"] == pytest.approx(sum(value[as_key(*g)] for g in grams(b" ".join(ws), 3)), rel=1e-5)
    assert context_tree.score(empty, F.lit(True)).count() == 0
    assert context_tree.score(clashing, F.lit(None).cast("boolean"), depth=3).count() == len(ODD)


def good(i):
    rng = np.random.default_rng(i)
    return " ".join(w for _ in range(2 + i % 4) for w in rng.permutation(["the", "house", "stands", "on", "green", "hills", "and", "rivers", "run"]))


@pytest.fixture
def judged(stored):
    rows = [(i, good(i), "en" if i % 2 else None, "s", 0) for i in range(260)]
    junk = ["THE HOUSE!! STANDS!! ON!! HILLS!! RUN!! AND!!", "the%%% house### stands$$$ on&&& hills*** and%%%", "run run run run run run run run run run run run run", "q7 | zx | vk | 88 | jj | qq | wv"]
    rows += [(1000 + i, t, "en", "s", 0) for i, t in enumerate(junk)]
    docs = stored([*rows, *((r[0] and 2000 + r[0], *r[1:]) for r in ODD)], DOCS)
    labels = stored([(i, 1) for i in range(240)] + [(1000, 0), (None, 1), (2007, None)], "doc_id long, quality int")
    return docs, labels


def test_quality_keeps_good_text_and_rejects_junk(judged, empty):
    docs, labels = judged
    got = {r["doc_id"]: r for r in kneser_ney.judge(docs, labels).collect()}
    assert all(got[i]["kept"] for i in range(260))
    assert not any(got[1000 + i]["kept"] for i in range(4))
    kept = kneser_ney.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() < docs.count()
    assert kneser_ney.judge(empty, labels).count() == 0


def test_a_wrong_label_per_language_does_not_let_junk_in(judged, stored):
    docs, labels = judged
    before = {r["threshold"] for r in kneser_ney.judge(docs, labels).collect()}
    odd = [(3000 + i, "".join(chr(33 + (i * 7 + j * 29) % 90) for j in range(60)), lang, "s", 0) for i in range(40) for lang in ("en", None)]
    held = 0
    for row in odd:  # one of each language that sets thresholds, whichever ids do
        more = docs.unionByName(stored([row], DOCS, 1))
        got = kneser_ney.judge(more, labels.unionByName(stored([(row[0], 1)], "doc_id long, quality int", 1)))
        cuts = {r["doc_id"]: r for r in got.collect()}
        if {r["threshold"] for r in cuts.values()} != before:
            held += 1
            assert max(r["threshold"] for r in cuts.values()) < 2 * max(before)
            assert not any(cuts[1000 + i]["kept"] for i in range(4))
            assert all(cuts[i]["kept"] for i in range(260))
        if held == 2:
            break
    assert held


def test_without_trusted_text_all_are_kept(odd, clashing, stored):
    none = stored([], "doc_id long, quality int", 1)
    assert kneser_ney.keep_good(odd, none).count() == len(ODD)
    assert kneser_ney.keep_good(clashing, none).columns == clashing.columns


def test_remainder_is_that_of_the_id_as_text(spark):
    from sedimenta.llm.queries import remainder

    rows = spark.range(20).withColumnRenamed("id", "doc_id").select("doc_id", remainder(7).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["doc_id"]).encode()) % 7 for r in rows)


def test_thresholds_of_a_rare_language_outlive_the_training_bound(stored):
    words = [f"word{i}" for i in range(40)]
    other = [f"\u0436\u0437{chr(0x430 + i)}\u043b" for i in range(30)]
    rows = [(i, " ".join((other if i % 6 == 0 else words)[(i * k) % 30] for k in range(1, 12)), "xx" if i % 6 == 0 else "en", "s", 1) for i in range(1800)]
    docs = stored(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = stored([(i, 1) for i in range(1800)], "doc_id long, quality int")
    lang = {r[0]: r[2] for r in rows}
    cuts = {}
    for r in kneser_ney.judge(docs, labels, trusted=100).collect():
        cuts.setdefault(lang[r["doc_id"]], set()).add(r["threshold"])
    assert len(cuts["xx"]) == len(cuts["en"]) == 1 and cuts["xx"] != cuts["en"]


def test_the_quality_model_learns_from_all_trusted_text(spark, stored):
    """Past any number of documents of a language: those last by the hash of their id have words of their own."""
    ids = [r["id"] for r in spark.range(24_000).orderBy(F.xxhash64(F.col("id").cast("string"))).collect()]
    rows = [(i, "the house stands on green hills" if k < 21_000 else "quick brown foxes jump over dogs", "en", "s", 0) for k, i in enumerate(ids)]
    docs, labels = stored(rows, DOCS), stored([(i, 1) for i in ids], "doc_id long, quality int")
    late = set(ids[21_000:])
    mean = lambda found: np.mean([r["perplexity"] for r in found.collect() if r["doc_id"] in late])
    assert mean(kneser_ney.judge(docs, labels)) < 1.5 < mean(kneser_ney.judge(docs, labels, trusted=20_000))


def test_rows_are_flagged_where_they_stand(spark, stored):
    docs = with_row_number(stored([(i,) for i in range(70_000)], "i long", 2))
    for chosen in (F.col("i") % 7 == 3, F.col("i") < 0, F.lit(True)):
        got = flagged(docs, docs.filter(chosen).select(ROW).union(docs.filter(chosen).select(ROW)), "f")
        assert got.count() == 70_000 and got.filter(F.col("f") != chosen).isEmpty()


def test_quantiles_are_exact(stored):
    frame = stored([("a" if i % 3 else "b", float(i * 37 % 1009 // 2), i) for i in range(1000)], "g string, _drawn double, _row long")
    values = {g: [float(i * 37 % 1009 // 2) for i in range(1000) if ("a" if i % 3 else "b") == g] for g in "ab"}
    got = {r["g"]: r["_value"] for r in kneser_ney.quantiles(frame, "g", 0.995).collect()}
    assert all(abs(got[g] - np.quantile(values[g], 0.995)) < 1e-9 for g in "ab")
