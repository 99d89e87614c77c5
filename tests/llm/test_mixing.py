from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from sedimenta.llm.mixing import mix, mixed_rows
from sedimenta.llm.queries import ORACLES
from tests.llm.conftest import ODD


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by sharing again and again what is above the cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        each = left / sum(w[s] for s in open_)
        left = 0.0
        for s in list(open_):
            got[s] += each * w[s]
            if got[s] >= cap * sizes[s]:
                left += got[s] - cap * sizes[s]
                got[s] = cap * sizes[s]
                open_.discard(s)
    return got


def words(text):
    return len([w for w in (text or "").encode().split()])


def check(rows, frame, **more):
    got = mix(frame, **more).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += words(r[1])
    want = targets(sizes)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append((words(r[1]), sizes[r[3]], r[3]))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        of = next(x for x in by_id[r["doc_id"]] if x[:2] == (r["size"], r["source_size"]))
        assert abs(r["target"] - want[of[2]]) <= 1e-9 * max(1, want[of[2]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[of[2]] += r["taken"]
        largest[of[2]] = max(largest[of[2]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    return got


def test_targets_and_rounding(odd, clashing):
    check(ODD, odd)
    check(ODD, clashing)


def test_many_rows_of_one_source_and_size(stored):
    rows = [(i, "two words" if i % 3 else f"a text of more words {i}", "en", "hot" if i % 4 else f"s{i % 7}", 1) for i in range(900)]
    frame = stored(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = check(rows, frame)
    again = mix(frame).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_large_cells_follow_the_order_of_the_sql(spark, stored, tmp_path):
    sources = [*["hot"] * 6, *["warm"] * 3, None]
    rows = [(None if i < 4 else i * 7919 % 100_003, "two words" if i % 10 else "a few more words", "en", sources[i // 7 % 10], 1) for i in range(9000)]
    frame = stored(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    frame.write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    want = connection.execute(f"SELECT doc_id, size, taken FROM ({ORACLES['op2_mixing']})").fetchall()
    got = mix(spark.read.parquet(str(tmp_path / "documents"))).select("doc_id", "size", "taken").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_rows_come_as_often_as_taken(odd, empty):
    out = mixed_rows(odd)
    assert out.columns == odd.columns
    assert out.count() == mix(odd).agg(F.sum("copies")).first()[0]
    assert mixed_rows(empty).count() == mix(empty).count() == 0


def test_priors_are_tilted_alike_within_a_source(stored):
    rows = [(i, "w " * (10 + i % 5), "en", "s" if i % 2 else "t", i % 3) for i in range(400)]
    frame = stored(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mix(frame.withColumn("p", F.col("n_chars")), prior=F.lit(0.5)).groupBy("target", "source_size").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 14 for r in got)
