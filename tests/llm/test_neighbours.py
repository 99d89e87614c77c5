from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import queries
from sedimenta.llm.neighbours import hilbert, search

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, asks):
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            ok[i] = x / np.sqrt((x * x).sum())
    out = {}
    for q in ok:
        if asks(q):
            near = sorted(((-round(float(ok[q] @ ok[i]), 12), i) for i in ok if i != q and len(ok[i]) == len(ok[q])))[:k]
            out[q] = [i for _, i in near]
    return out


def found(df, **more):
    out = {}
    for r in search(df, F.col("vec_id") % 5 == 0, **more).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert all([r for r, *_ in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [i for _, i, _ in sorted(v)] for q, v in out.items()}


def test_curve_visits_neighbours_one_after_another():
    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = points[np.argsort(hilbert(points, 3))]
    assert len(set(hilbert(points, 3).tolist())) == 512
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_full_windows_equal_brute_force(stored):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist(), 0) for i in range(120)]
    same = rows[7][1]
    rows += [(1000 + i, same, 0) for i in range(40)]  # one vector many times
    rows += [(500, None, 0), (501, [0.0] * 4, 0), (502, [float("nan"), 1.0, 1.0, 1.0], 0), (503, [1.0, None, 1.0, 1.0], 0), (504, [float("inf"), 1.0, 1.0, 1.0], 0), (505, [], 0), (506, [1.0, 2.0], 0), (None, [1.0] * 4, 0)]
    rows += [rows[0], (510, [1e30, 2e30, 1e30, 3e30], 0), (515, [1e-30, 2e-30, 1e-30, 3e-30], 0)]
    rows += [(600 + i, rng.normal(size=6).astype(np.float32).tolist(), 0) for i in range(30)] + [(700, [3.0, 1.0], 0), (900, [1.0] * 7, 0)]
    frame = stored([(*r, 1) for r in rows], SCHEMA + ", _score int")
    want = brute(rows, 5, lambda q: q % 5 == 0)
    assert want[700] == [506] and want.pop(900) == [] and len(want[600]) == 5
    assert found(frame, window_share=2.5, curves=2) == want


def test_few_rows_and_none(stored):
    frame = stored([(5, [1.0, 0.0, 0.0, 0.0], 0), (6, [1.0, 1.0, 0.0, 0.0], 0), (10, [0.0, 0.0, 0.0, 1.0], 0)], SCHEMA)
    assert found(frame) == {5: [6, 10], 10: [5, 6]}
    assert found(frame.filter("vec_id = 5")) == {}
    assert found(frame.filter("vec_id = 6")) == {}
    assert found(frame.limit(0)) == {}


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
def test_recall(spark):
    got = {}
    for r in queries.op10_neighbours(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.stack(table["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = table["vec_id"].to_numpy()
    asked = np.flatnonzero(ids % 50 == 0)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -2
    best = ids[np.argsort(-score, axis=1)[:, :5]]
    assert set(got) == set(ids[asked].tolist())
    assert np.mean([len(got[q] & set(b)) / 5 for q, b in zip(ids[asked].tolist(), best.tolist())]) >= 0.9
