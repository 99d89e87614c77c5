"""Toxicity and language: restored words, held-out accuracy, defined results for odd rows."""

import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import language, queries, toxicity
from tests.llm.conftest import DOCS, ODD

SF = "/root/testdata/sf0.01"
driver_tables = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
WORDS = "you are such an idiot moron loser pathetic worthless scum and the thing is that stupid people run around here".split()


@pytest.fixture(scope="module")
def characters():
    grams = Counter()
    for w in WORDS * 50:
        padded = f"  {w} "
        grams.update(padded[i: i + 3] for i in range(len(padded) - 2))
    return toxicity.CharacterModel(dict(grams))


@pytest.mark.parametrize(("hidden", "word"), [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("l o s e r", "loser"), ("i.d.i.o.t", "idiot"), ("stuuuupid", "stupid"), ("w0rthl3ss", "worthless"), ("$cum", "scum"),
    ("p@thet!c", "pathetic"), ("i d i o t", "idiot"), ("", ""), ("the", "the"),
])
def test_hidden_words_are_restored(characters, hidden, word):
    assert toxicity.restore(hidden, characters) == word


def test_words_of_a_text(characters):
    assert {"moron", "m0r0n", "loser", "you"} <= toxicity.words_of("You M0R0N, l o s e r!", characters, {})
    assert toxicity.words_of("", characters, {}) == set()


@pytest.mark.parametrize("text", ["a very long token " + "x-" * 115 + "m0r0n here", "m0r0n" + "," * 300, "a$$", "shi+", "idio+!", "morron", "m.o.r.o.n" + "." * 250, "s c u m"])
def test_no_token_is_too_long_or_too_plain_to_be_decoded(text):
    model = toxicity.CharacterModel({g: 50 for w in [*WORDS, "ass", "shit"] for g in (f"  {w} "[i: i + 3] for i in range(len(w) + 1))})
    found = toxicity.words_of(text, model, {})
    assert any(w.endswith(x) for w in found for x in ("moron", "ass", "shit", "idiot", "scum")), found


def test_a_long_word_keeps_all_its_parts():
    word = "ab" * 100
    held = set(toxicity.features(word))
    assert set(toxicity.features(word[:64])) <= held and set(toxicity.features("xyz")) == set(toxicity.features("xyz")[:1])
    assert toxicity.features("q" * 500 + "moron")[-3] == toxicity.features("moron" * 20)[-3]


def test_words_of_whole_texts_equal_decoding_every_token(characters):
    """Against the definition: each token and spaced run restored apart, without memo or prefilter."""
    text = "You m0r0n, 1d10t!! Stuuupid p@thet!c people... i d i o t and w.o.r.t.h.l.e.s.s (loser) l0ser 2023 good letter's end-of-line"
    want = toxicity.plain_words(set(text.lower().split()))
    for token in text.lower().split():
        words = toxicity.restore(token.strip(toxicity.AROUND), characters).split()
        want |= {*words, "".join(words)}
    for run in toxicity.SPACED.findall(text.lower()):
        words = toxicity.restore(run, characters).split()
        want |= {*words, "".join(words)}
    assert toxicity.words_of(text, characters, {}) == want - {""}


def test_the_best_path_is_the_least_of_all_paths(characters):
    """Viterbi against all choices of letters for a short token without separators or repetitions."""
    token, choices = "1d1", ["il", "d", "il"]
    cost = {}
    for a in choices[0]:
        for b in choices[1]:
            for c in choices[2]:
                word = f"  {a}{b}{c} "
                cost[a + b + c] = sum(characters.cost(word[i: i + 2], word[i + 2]) for i in range(len(word) - 2))
    assert toxicity.restore(token, characters) == min(cost, key=cost.get)


@driver_tables
def test_toxicity_of_held_out_documents(spark):
    rows = queries.op5_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out").collect()
    wrong = [r for r in rows if r["predicted"] != r["toxic"]]
    assert len(wrong) < 0.05 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_toxicity_of_odd_rows(odd, clashing, empty, stored):
    labels = stored([(1, 1), (2, 0), (None, 1), (8, None), (4, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    assert toxicity.score(odd, model).count() == toxicity.score(clashing, model).count() == len(ODD)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(empty, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(odd, none).collect()} <= {0, 1}


def test_the_toxicity_model_learns_from_every_labelled_text(spark, stored):
    """Past any number of labelled ids, and from each text of an id: the last by the hash of their id have words of their own."""
    ids = [r["id"] for r in spark.range(9_000).orderBy(F.xxhash64(F.col("id").cast("string"))).collect()]
    rows = [(i, f"plain talk of day {k % 7}" + (" moron" if k % 2 and k < 8_800 else " bozo" if k % 2 else ""), "en", "s", 0) for k, i in enumerate(ids)]
    rows += [(ids[1], f"you zyzzy {j}", "en", "s", 0) for j in range(6)]
    docs, labels = stored(rows, DOCS), stored([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    seen, fresh = ["bozo", "moron"], stored([(1, "a bozo here", "en", "s", 0), (2, "a moron here", "en", "s", 0), (3, "a day here", "en", "s", 0)], DOCS)
    assert all(max(model.evidence[i] for i in toxicity.features(w)) > 2 for w in seen)
    assert max(model.evidence[i] for i in toxicity.features("zyzzy")) > 0
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(fresh, model).collect()} == {1: 1, 2: 1, 3: 0}
    both = {r["doc_id"]: r["score"] for r in toxicity.judge(docs, labels).collect() if r["doc_id"] != ids[1]}
    assert both == pytest.approx({r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect() if r["doc_id"] != ids[1]})


def test_buckets_and_evidence_of_many_words_at_once_equal_their_definition(spark):
    """Words of any length and script, texts without words, more parts than are worked on at a time."""
    words = ["x", "ab", "abc", "abcd", "abcdefg", "é", "ñandú", "日本語テスト", "😀😀😀😀😀", "$", *("a" * n for n in (63, 64, 65, 96, 97)), "é日" * 50, *(f"word{i}" for i in range(300))]

    def buckets(word):
        for begin in range(0, max(1, len(word) - 32), 32):
            part = word[begin: begin + 64]
            edges = [e for n in (3, 4, 5, 6) if len(part) > n for e in (f"^{part[:n]}", f"{part[-n:]}$")]
            yield [zlib.crc32(e.encode()) >> (32 - toxicity.BITS) for e in [f"^{part}$", *edges]]

    want = [(i, b) for i, w in enumerate(words) for b in buckets(w)]
    owners, found = toxicity.buckets_of(pa.array(["ahead", *words]).slice(1))
    assert [(i, [x for x in row if x >= 0]) for i, row in zip(owners.tolist(), found.tolist())] == want

    evidence = np.random.default_rng(1).normal(1, 2, 1 << toxicity.BITS).clip(0).astype(np.float32)
    texts = ["", *(" ".join(words[i: i + i % 7]) for i in range(len(words))), " ".join(words), ""]
    of_word = {w: max(float(evidence[x]) for b in buckets(w) for x in b) for w in words}
    top = [sorted((of_word[w] for w in t.split()), reverse=True) for t in texts]
    assert toxicity.strongest(pa.array(texts), evidence).tolist() == [[*(v + [0.0] * 3)[:3], math.log1p(sum(x > 3 for x in v))] for v in top]

    labels, halves = [i % 3 % 2 for i in range(len(texts))], [i % 2 for i in range(len(texts))]
    counts, seen = toxicity.bucket_counts(spark.createDataFrame(list(zip(labels, halves, texts)), "label int, half int, words string"))
    of_texts = Counter((h, x, i) for h, x, t in zip(halves, labels, texts) for i in {i for w in t.split() for b in buckets(w) for i in b})
    assert {(*map(int, at),): int(seen[at]) for at in zip(*np.nonzero(seen))} == of_texts
    assert counts.tolist() == [[sum(h == a and x == b for h, x in zip(halves, labels)) for b in (0, 1)] for a in (0, 1)]


def test_a_words_buckets_are_found_once_for_the_texts_that_hold_it(monkeypatch):
    asked, plain = [], toxicity.buckets_of
    monkeypatch.setattr(toxicity, "buckets_of", lambda words: asked.extend(words.to_pylist()) or plain(words))
    toxicity.strongest(pa.array(["a moron and", "and a moron", "moron"] * 500), np.ones(1 << toxicity.BITS, np.float32))
    assert sorted(asked) == ["a", "and", "moron"]


@driver_tables
def test_languages_of_held_out_documents(spark):
    rows = queries.op8_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)


def test_subwords_stay_inside_their_text():
    one = [language.subwords([t], 10)[0] for t in (b"abc", b"", b"longer text")]
    together, start = language.subwords([b"abc", b"", b"longer text"], 10)
    assert start.tolist() == [0, 5, 7]
    assert (np.concatenate(one) == together).all()


def test_languages_of_odd_rows(odd, clashing, empty, stored):
    rows = [(i, "das ist ein satz und noch ein wort" if i % 2 else "this is a line with some words", "de" if i % 2 else "en", None, None) for i in range(60)]
    model = language.train(stored([*rows, *ODD], DOCS), epochs=4)
    assert set(model.languages) == {"de", "en", "fr"}
    got = {r["doc_id"]: r for r in language.predict(odd, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (4, 5, 6))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in language.predict(odd, model, reject=1.1).collect()} == {"und"}
    assert language.predict(clashing, model).count() == len(ODD) and language.predict(empty, model).count() == 0
    none = language.train(empty)
    assert {r["lang_pred"] for r in language.predict(odd, none).collect()} == {"und"}
    assert language.predict(odd.filter(F.lit(False)), model).count() == 0
