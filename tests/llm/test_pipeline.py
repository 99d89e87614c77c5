from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
import regex

import corpus_pipeline
from sedimenta.llm import bpe, kneser_ney, queries
from sedimenta.llm.work import stage
from tests.llm.conftest import DOCS, ODD
from tests.llm.test_exact_dedup import brute as equal_texts
from tests.llm.test_jaccard import brute as similar_texts
from tests.llm.test_mixing import targets, words
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
driver_tables = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@driver_tables
def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    step = dict(corpus_pipeline.STAGES)
    judged = {r["doc_id"]: r["kept"] for r in kneser_ney.judge(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    good = stage(step["quality_classifier"](spark, docs, SF))
    rows = rows_of(good)
    assert sorted(rows, key=repr) == sorted((r for r in rows_of(docs) if judged[r[0]]), key=repr)

    single = stage(step["exact_dedup"](spark, good, SF))
    kept = {r[0] for r in equal_texts([r[:2] for r in rows]) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    assert sorted(rows_of(single)) == sorted(rows)

    apart = stage(step["ngram_jaccard"](spark, single, SF))
    first = {c for _, n, c in similar_texts([r[:2] for r in rows], 5, 4, 5) if n} | {r[0] for r in rows if not words(r[1])}
    rows = [r for r in rows if r[0] in first]
    assert sorted(rows_of(apart)) == sorted(rows)

    mixed = stage(step["mixing"](spark, apart, SF))
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r[3]] += words(r[1])
        largest[r[3]] = max(largest[r[3]], words(r[1]))
    got = rows_of(mixed)
    for r in got:
        taken[r[3]] += words(r[1])
    want = targets(dict(sizes))
    assert set(got) <= set(rows) and max(Counter(got).values()) <= 2
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)

    encoded = step["bpe"](spark, mixed, SF).collect()
    encoder = bpe.Encoder(bpe.Vocabulary.from_bytes(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()), public_tokenizers.PATTERN)
    assert Counter(tuple(r)[:5] for r in encoded) == Counter(got)
    assert all(encoder.decode(r["ids"]) == r["text"].encode() for r in encoded)
    assert regex.compile(public_tokenizers.PATTERN)


@driver_tables
def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"] and out.count() > 0


def test_stages_take_odd_rows_and_none(spark, stored, odd, empty, tmp_path):
    spark.createDataFrame([(1, 1, 0), (8, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, odd, str(tmp_path)))
        assert out.columns[:5] == odd.columns and 0 < out.count() <= 2 * len(ODD), name
        assert stage(step(spark, empty, str(tmp_path))).count() == 0, name
    extra = stored([(*r, 7) for r in ODD], DOCS + ", _row int")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, extra, str(tmp_path)).columns[:6] == extra.columns


@driver_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    ok, detail = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok, detail


def test_every_operator_is_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
