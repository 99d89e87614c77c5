import random

import pytest

from sedimenta.llm import jaccard
from sedimenta.llm.components import connected
from sedimenta.llm.jaccard import groups, one_of_each
from tests.llm.conftest import DOCS, ODD


def brute(rows, width, num, den):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i: i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    best = {}
    for i, (id_, _) in enumerate(rows):
        r = root(i)
        if r not in best or (id_ is None, id_ or 0) < (best[r] is None, best[r] or 0):
            best[r] = id_
    return sorted(((rows[i][0], len(sets[i]), best[root(i)]) for i in range(len(rows))), key=repr)


def found(frame, **more):
    return sorted((tuple(r) for r in groups(frame, **more).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def corpus(seed, n=160):
    """Texts that share passages; near copies of some, chains of edits, exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    common = text(30)
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3 or not out:
            t = text(rng.randint(0, 50))
        elif kind < 0.5:
            t = common + " " + text(rng.randint(0, 8))
        elif kind < 0.6:
            t = rng.choice(out)
        else:
            w = rng.choice(out).split() or ["x"]
            for _ in range(rng.randint(1, 2)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            t = " ".join(w)
        out.append(t)
    return [(i, t, "en", "s", 0) for i, t in enumerate(out)]


@pytest.mark.parametrize(("seed", "width", "num", "den"), [(1, 4, 85, 100), (2, 5, 4, 5), (3, 2, 1, 2)])
def test_equals_brute_force(stored, seed, width, num, den):
    rows = corpus(seed)
    assert found(stored(rows, DOCS), width=width, num=num, den=den) == brute([r[:2] for r in rows], width, num, den)


def test_near_copies_meet_few_others(stored, monkeypatch):
    """A group of edited copies that link through those with fewer edits and mostly not with each other: what is compared grows with its size."""
    rng = random.Random(7)
    base, rows = [f"w{rng.randrange(500)}" for _ in range(140)], []
    for i in range(200):
        w = list(base)
        for _ in range(i % 3):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    compared, links_of = [], jaccard.links_of
    monkeypatch.setattr(jaccard, "links_of", lambda pairs, *more: compared.append(pairs.count()) or links_of(pairs, *more))
    assert found(stored(rows, DOCS), width=4, num=85, den=100) == brute([r[:2] for r in rows], 4, 85, 100)
    assert sum(compared) < 5 * len(rows)


def test_odd_rows(odd, clashing, empty):
    want = brute([r[:2] for r in ODD], 5, 4, 5)
    assert found(odd) == want
    assert found(clashing) == want
    assert found(empty) == []
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    # One row of each component of texts with words, and every row without.
    wordless = sum(n == 0 for _, n, _ in want)
    assert kept.count() == wordless + len({c for _, n, c in want if n})


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5, 5)]
    got = {r["node"]: r["label"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(1000, 1100), 1000)}
