"""Several versions of an entity in one run, and arrivals that come late, against one run per moment."""

import random

import pytest

from sedimenta.operators import scd2

COLUMNS = "applicant_id long, SK_ID_CURR long, name_income_type string, name_education_type string, name_family_status string, cnt_children int, told_at timestamp_ntz"


def moment(day):
    return f"2024-01-{day:02d} 00:00:00"


def statements(seed, entities=12, days=20):
    draw = random.Random(seed)
    out = []
    for k in range(entities):
        for day in sorted(draw.sample(range(1, days + 1), draw.randrange(1, 9))):
            out.append((k, 1000 * k + day, draw.choice(["Working", None]), "Higher", draw.choice(["Single", "Married"]), draw.choice([None, 0, 1]), day))
    return out


def frame(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(*r[:6], datetime(2024, 1, r[6])) for r in rows], COLUMNS)


def run_by_run(spark, rows):
    """The same statements, one run of ``apply_scd2`` per moment."""
    dim = None
    for day in sorted({r[6] for r in rows}):
        batch = frame(spark, [r for r in rows if r[6] == day])
        dim = scd2.first_versions(batch, moment(day)) if dim is None else scd2.apply_scd2(dim, batch, moment(day))
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    return dim


@pytest.mark.parametrize("seed", [1, 2])
def test_one_run_equals_a_run_per_moment(spark, rows, seed):
    told = statements(seed)
    want = rows(run_by_run(spark, told))
    assert rows(scd2.version_chains(frame(spark, told), "told_at")) == want
    first = [r for r in told if r[6] <= 7]
    later = [r for r in told if r[6] > 7]
    dim = scd2.version_chains(frame(spark, first), "told_at")
    got = scd2.apply_arrivals(dim, frame(spark, later), "told_at")
    assert rows(got) == want
    assert scd2.interval_violations(got).count() == 0
    assert scd2.late_entities(dim, frame(spark, later), "told_at", "start_date").count() == 0


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_any_order_of_arrival_gives_the_same_dimension(spark, rows, seed):
    told = statements(seed)
    want = rows(scd2.version_chains(frame(spark, told), "told_at"))
    shuffled = list(told)
    random.Random(seed).shuffle(shuffled)
    parts = [shuffled[i::3] for i in range(3)]
    dim, known = scd2.version_chains(frame(spark, parts[0]), "told_at"), parts[0]
    for part in parts[1:]:
        dim = scd2.apply_arrivals(dim, frame(spark, part), "told_at", earlier=frame(spark, known))
        dim = spark.createDataFrame(dim.collect(), dim.schema)
        known = known + part
    assert rows(dim) == want
    assert scd2.interval_violations(dim).count() == 0


def test_arrivals_again_change_nothing(spark, rows):
    told = statements(6)
    dim = scd2.version_chains(frame(spark, told), "told_at")
    again = scd2.apply_arrivals(dim, frame(spark, told), "told_at", earlier=frame(spark, told))
    assert rows(again) == rows(dim)
    nothing = frame(spark, told).filter("false")
    assert rows(scd2.apply_arrivals(dim, nothing, "told_at")) == rows(dim)
    assert rows(scd2.apply_arrivals(dim, nothing, "told_at", earlier=frame(spark, told))) == rows(dim)


def test_a_statement_that_changed_nothing_opens_again_after_a_late_one(spark, rows):
    a, b = ("Working", "Higher", "Single", 0), ("Working", "Higher", "Married", 0)
    first = [(1, 11, *a, 1), (1, 15, *a, 5)]
    dim = scd2.version_chains(frame(spark, first), "told_at")
    assert dim.count() == 1
    late = frame(spark, [(1, 13, *b, 3)])
    got = scd2.apply_arrivals(dim, late, "told_at", earlier=frame(spark, first))
    assert [(r["SK_ID_CURR"], r["start_date"].day, r["end_date"] and r["end_date"].day, r["is_current"]) for r in got.orderBy("start_date").collect()] == [
        (11, 1, 3, False), (13, 3, 5, False), (15, 5, None, True)]


def test_contradictions(spark):
    a, b = ("Working", "Higher", "Single", 0), ("Working", "Higher", "Single", None)
    told = frame(spark, [(1, 1, *a, 1), (1, 2, *a, 1), (2, 3, *a, 1), (2, 4, *b, 1), (3, 5, *b, 2)])
    assert [(r[0], r[1].day) for r in scd2.contradictions(told, "told_at").collect()] == [(2, 1)]
    assert scd2.version_chains(told.filter("applicant_id = 1"), "told_at").count() == 1


def test_late_arrivals_meet_their_entities_once(spark):
    """Each input is read once and nothing is joined, so a task sorts its share twice, however the parts of a dimension are made."""
    told = statements(5)
    even, odd = frame(spark, told[::2]), frame(spark, told[1::2])
    dim = scd2.version_chains(even, "told_at")
    plan = scd2.apply_arrivals(dim, odd, "told_at", earlier=even)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
