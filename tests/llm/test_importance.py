import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest

from sedimenta.llm import importance, queries
from tests.llm.conftest import ODD
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i: i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest=1, buckets=10_000, share=(10, 100), least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw, want = (Counter(bucket(f) for t in texts for f in features(t, longest)[1]) for texts in ([t for _, t in docs], target))
    all_raw, all_want = sum(raw.values()), sum(want.values())
    gain = {b: math.floor(1000 * math.log((want[b] + 1) * (all_raw + buckets) / ((raw[b] + 1) * (all_want + buckets)))) for b in raw}
    out = []
    for key, text in docs:
        n_words, own = features(text, longest)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((n_words, key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    enough = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    drawn = len(enough) * share[0] // share[1]
    ranks = [(*r[1:], i + 1 if i < drawn else None) for i, r in enumerate(enough)]
    return sorted(ranks + [(*r[1:], None) for r in out if r[0] < least], key=repr)


def text(n, seed):
    draw = random.Random(seed)
    return "".join(draw.choice(["Alpha", "beta", "ÉTÉ", "x1", "漢字", "🙂", "of", "a_b"]) + draw.choice([" ", ", ", "\n", "--", "\x7f"]) for _ in range(n))


DOCS = [(i, text(i % 70, i)) for i in range(150)] + [(None, text(40, 1)), (900, None), (901, ""), (902, "word " * 30), (3, text(3, 3)), (903, "x" * 50)]
TARGET = [text(50, 1000 + i) for i in range(4)] + [None, ""]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_equals_brute_force(stored, longest):
    docs, target = stored(DOCS, "doc_id long, text string"), stored([(t,) for t in TARGET], "text string")
    got = importance.resample(docs, target, longest=longest, buckets=500, share=(30, 100))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(DOCS, TARGET, longest, 500, (30, 100))


@pytest.mark.parametrize("longest", [1, 2, 3])
@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_blocks_do_not_change_runs(monkeypatch, block, longest):
    monkeypatch.setattr(importance, "BLOCK", block)
    texts = [text(60, 1), "", "y" * 300, "é" * 90 + " b " + "c" * 40, text(5, 2), " ", "a", "b", text(200, 3), "a" * 70 + "," + "b" * 70 + " end"]
    got = [Counter() for _ in texts]
    for owner, bucket in importance.buckets_of(texts, longest, 997):
        for o, b in zip(owner.tolist(), bucket.tolist()):
            got[o][b] += 1
    assert got == [Counter(zlib.crc32(f.encode()) % 997 for f in features(t, longest)[1]) for t in texts]


def test_crc_of_joined_strings():
    shift = importance.CrcShift()
    draw = random.Random(4)
    pairs = [(draw.randbytes(draw.randrange(20)), draw.randbytes(draw.choice([0, 1, 5, 300, 70_000]))) for _ in range(50)]
    crc, following, length = ([f(x) for x in pairs] for f in (lambda x: zlib.crc32(x[0]), lambda x: zlib.crc32(x[1]), lambda x: len(x[1])))
    joined = shift.joined(importance.np.array(crc, "u4"), importance.np.array(following, "u4"), importance.np.array(length))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_odd_rows(odd, clashing, empty, stored):
    target = stored([("same words",), (None,)], "text string")
    rows = [r[:2] for r in ODD]
    got = sorted(map(tuple, importance.resample(odd, target, share=(100, 100), least_words=1).collect()), key=repr)
    assert got == brute(rows, ["same words"], share=(100, 100), least=1)
    assert sorted(map(tuple, importance.resample(clashing, target, share=(100, 100), least_words=1).collect()), key=repr) == got
    assert importance.resample(empty, target).count() == 0
    none = importance.resample(odd, empty)
    assert sorted(map(tuple, none.collect()), key=repr) == brute(rows, [])


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
def test_query_equals_its_sql(spark):
    name = "op13_importance"
    ok, detail = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok, detail
