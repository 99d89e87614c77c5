import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from sedimenta.llm import order_minhash
from sedimenta.llm.order_minhash import BASE, FOLD, Sketcher
from tests.llm.conftest import ODD

SMALL = Sketcher(width=4, tuples=3, hashes=16)


def brute_entries(sketcher, text):
    """The definition, one pair at a time: number each k-mer's occurrences, take the smallest per function, hash them in text order."""
    n = sketcher.size(text)
    if not n:
        return [0] * sketcher.hashes
    kmers = [int(sketcher.kmers(text, i, i + 1)[0]) for i in range(n)]
    seen, pairs = defaultdict(int), []
    for kmer in kmers:
        pairs.append((kmer + seen[kmer] * int(BASE)) * int(FOLD) % 2**64 >> 32)
        seen[kmer] += 1
    entries = []
    for turn, factor in zip(sketcher.turns[:, 0].tolist(), sketcher.factors[:, 0].tolist()):
        chosen = sorted(sorted(range(n), key=lambda i: ((pairs[i] ^ turn) * factor % 2**32, i))[: sketcher.tuples])
        entry = np.full(1, np.uint64(min(sketcher.tuples, n)))
        for i in chosen:
            entry = order_minhash.mixed(entry * FOLD + np.uint64(kmers[i]))
        entries.append(int(entry[0]) >> 32)
    return entries


def words(n, seed):
    draw = random.Random(seed)
    return " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "été", "漢字", "🙂", "of", "the"]) + str(draw.randrange(50)) for _ in range(n))


def test_entries_equal_the_definition():
    texts = ["", "a", "abc", "abcd", "abcde", "aaaaaaaaaaaaaaaaaaaa", "abababababab" * 30, words(5, 1), words(200, 2), "🙂" * 9]
    for text in texts:
        assert SMALL.sketch(text)[0].tolist() == brute_entries(SMALL, text), text[:20]


def test_a_long_text_in_segments_equals_one_scan(monkeypatch):
    texts = [words(900, 3), "ab" * 3_000, "x" * 5_000]
    whole = [SMALL.sketch(t)[0].tolist() for t in texts]
    monkeypatch.setattr(order_minhash, "SEGMENT", 700)
    monkeypatch.setattr(order_minhash, "COLUMNS", 64)
    small = Sketcher(width=4, tuples=3, hashes=16)
    assert [small.sketch(t)[0].tolist() for t in texts] == whole
    for text in texts:
        changed, kept = order_minhash.edited(text, words(400, 4))
        shared = small.sketch(changed, small.sketch(text)[1], kept - 3)[0]
        assert shared.tolist() == small.sketch(changed)[0].tolist()


def test_order_counts():
    a, b = words(300, 5), words(300, 6)
    forth, back = Sketcher().sketch(a + " " + b)[0], Sketcher().sketch(b + " " + a)[0]
    near = Sketcher().sketch(a + " " + b[:-40])[0]
    assert order_minhash.equal_entries(forth, near) > order_minhash.equal_entries(forth, back)


def brute(rows):
    """Rows in descending order of id, each against its edited text and the next row; ids are distinct."""
    sketcher = Sketcher()
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for (key, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        own, other, after = (np.array(brute_entries(sketcher, x)) for x in (text, changed, following))
        digits = ["".join(f"{x:08x}" for x in e) for e in (own, other)]
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), *digits, float(np.mean(own == other)), float(np.mean(own == after))))
    return sorted(out)


def test_query_equals_brute_force(spark, stored):
    rows = [(i, words(i % 60, i % 7)) for i in range(80)] + [(100, None), (101, ""), (102, "🙂" * 40), (103, "ab"), (-5, "x" * 3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for files in (1, 5):
            docs = stored(rows, "doc_id long, text string", files)
            got = order_minhash.compare_edited(docs)
            assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_row_follows_itself(stored):
    got = order_minhash.compare_edited(stored([(1, "abcdef")], "doc_id long, text string", 1)).collect()
    assert [r["edited_sha256"] for r in got] == [hashlib.sha256(b"abcdab").hexdigest()] and got[0]["near_next"] == 1


def test_odd_rows(odd, clashing, empty):
    got = order_minhash.compare_edited(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ODD)
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((r[0], len(r[1] or "")) for r in ODD)
    by_text = defaultdict(set)
    for r in got:
        assert len(r["fingerprint"]) == len(r["edited_fingerprint"]) == 512 and 0 <= r["near_edited"] <= 1
        by_text[r["doc_id"]].add(r["fingerprint"])
    assert by_text[4] == by_text[5] == {"0" * 512} and len(by_text[8]) == 1
    assert sorted(map(tuple, order_minhash.compare_edited(clashing).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    assert order_minhash.compare_edited(empty).count() == 0


def test_fingerprint_column_and_likeness(odd, clashing, empty):
    got = order_minhash.fingerprint(odd)
    assert got.columns == [*odd.columns, "fingerprint"]
    want = {r["doc_id"]: r["fingerprint"] for r in order_minhash.compare_edited(odd).collect()}
    assert all(want[r["doc_id"]] == r["fingerprint"] for r in got.collect() if r["doc_id"] is not None)
    a, b = words(300, 7), words(300, 8)
    entries = [np.frombuffer(bytes.fromhex(x), ">u4") for x in (Sketcher().sketch(t)[0].astype(">u4").tobytes().hex() for t in (a, a[:1500] + b))]
    hexes = [x.tobytes().hex() for x in entries]
    near = odd.limit(1).select(order_minhash.likeness(F.lit(hexes[0]), F.lit(hexes[1])).alias("x")).first()["x"]
    assert near == order_minhash.equal_entries(*entries) > 0
    assert order_minhash.fingerprint(clashing, out="score").columns == clashing.columns
    assert order_minhash.fingerprint(clashing, out="score").schema["score"].dataType.simpleString() == "string"
    assert order_minhash.fingerprint(empty).count() == 0
