"""Row numbers and blocks when a table is split over tasks in another way at the second read."""

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import context_tree, exact_dedup
from sedimenta.llm.work import ROW, with_row_number
from tests.llm.conftest import DOCS

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def split_anew(spark):
    before = spark.conf.get(SPLIT)
    yield lambda: spark.conf.set(SPLIT, "300")
    spark.conf.set(SPLIT, before)


@pytest.fixture
def frame(stored):
    return stored([(i, f"text number {i // 2}", "en", "s", i) for i in range(400)], DOCS)


def test_numbers_stay(frame, split_anew):
    numbers = lambda: sorted((r["doc_id"], r[ROW]) for r in with_row_number(frame.select("doc_id")).collect())
    first = numbers()
    split_anew()
    assert numbers() == first and len({n for _, n in first}) == 400


def test_dedup_keeps_the_right_rows(frame, split_anew):
    out = exact_dedup.dedup(frame)
    split_anew()
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(0, 400, 2))


def test_blocks_meet_their_texts(frame, split_anew):
    scores = lambda df: sorted((r["doc_id"], round(r["score"], 9)) for r in df.select("doc_id", "score").collect())
    want, other = scores(context_tree.score(frame, F.lit(True))), context_tree.score(frame, F.lit(True))
    split_anew()
    assert scores(other) == want
    assert scores(context_tree.score(frame, F.lit(True))) == want


def test_other_frames_are_stored_first(frame):
    twice = frame.union(frame)
    assert exact_dedup.dedup(twice).count() == 200
