import random
from datetime import datetime

import pytest

from sedimenta.operators import scd2
from sedimenta.operators.scd2 import DIM_APPLICANT, TRACKED_ATTRIBUTES

SRC = "applicant_id long, SK_ID_CURR long, name_income_type string, name_education_type string, name_family_status string, cnt_children int"
T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def source(spark, items):
    return spark.createDataFrame([(k, k, *attributes) for k, *attributes in items], SRC)


def state(df):
    """{id: sorted [(start, end, current, attributes)]} without surrogates."""
    out = {}
    for r in df.collect():
        out.setdefault(r["applicant_id"], []).append(
            (r["start_date"], r["end_date"], r["is_current"], tuple(r[c] for c in TRACKED_ATTRIBUTES))
        )
    return {k: sorted(v, key=repr) for k, v in out.items()}


def brute_force(before, src, as_of, close_missing=False):
    after = {k: [list(v) for v in versions] for k, versions in before.items()}
    for key, versions in after.items():
        for version in versions:
            if version[2] and ((key in src and src[key] != version[3]) or (close_missing and key not in src)):
                version[1], version[2] = as_of, False
    for key, attributes in src.items():
        if not any(v[2] for v in after.get(key, [])):
            after.setdefault(key, []).append([as_of, None, True, attributes])
    return {k: sorted((tuple(v) for v in versions), key=repr) for k, versions in after.items()}


def test_worked_example(spark):
    """One applicant changes from NULL to 2 children, one is unchanged, one is new."""
    first = source(spark, [(100001, "Working", "Higher", "Married", None), (100002, "Pensioner", "Basic", "Single", 1)])
    dim = scd2.first_versions(first, T0)
    src = source(spark, [(100001, "Working", "Higher", "Married", 2), (100002, "Pensioner", "Basic", "Single", 1),
                         (100003, "Student", "Higher", "Single", 0)])
    after = state(scd2.apply_scd2(dim, src, T1))
    assert after[100001] == [(T0, T1, False, ("Working", "Higher", "Married", None)), (T1, None, True, ("Working", "Higher", "Married", 2))]
    assert after[100002] == [(T0, None, True, ("Pensioner", "Basic", "Single", 1))]
    assert after[100003] == [(T1, None, True, ("Student", "Higher", "Single", 0))]


@pytest.mark.parametrize("close_missing", [False, True])
def test_against_brute_force_over_several_runs(spark, close_missing):
    rng = random.Random(11)
    values = ["a", "b", None]
    dim, expected = None, {}
    for as_of in (T0, T1, T2):
        src = {k: (rng.choice(values), "h", rng.choice(values), rng.choice([0, 1, None])) for k in range(60) if rng.random() < 0.8}
        frame = source(spark, [(k, *a) for k, a in src.items()])
        dim = scd2.first_versions(frame, as_of) if dim is None else scd2.apply_scd2(dim, frame, as_of, close_missing=close_missing)
        expected = brute_force(expected, src, as_of, close_missing)
        assert state(dim) == expected
        assert dim.select("applicant_sk").distinct().count() == dim.count()
        if not close_missing:
            assert scd2.interval_violations(dim).count() == 0


def test_steps_agree_with_the_single_pass(spark, rows):
    first = source(spark, [(k, "a", "h", "m", k % 3) for k in range(30)])
    dim = scd2.first_versions(first, T0)
    src = source(spark, [(k, "a", "h", "m", 0) for k in range(10, 40)])
    closing = scd2.expiring_versions(dim, src, T1)
    kept = dim.join(closing.select("applicant_id"), ["applicant_id"], "left_anti").select(*DIM_APPLICANT.columns)
    expired = kept.unionByName(closing)
    two_steps = expired.unionByName(scd2.opening_versions(expired, src, T1))
    assert rows(two_steps) == rows(scd2.apply_scd2(dim, src, T1))


def test_unchanged_source_and_same_instant_are_no_ops(spark, rows):
    dim = scd2.first_versions(source(spark, [(1, "a", None, "m", None), (2, "b", "h", "m", 1)]), T0)
    src = source(spark, [(1, "a", None, "m", None), (2, "c", "h", "m", 1)])
    once = scd2.apply_scd2(dim, src, T1)
    assert rows(once) == rows(scd2.apply_scd2(once, src, T1)) == rows(scd2.apply_scd2(once, src, T2))


def test_untracked_attributes_do_not_open_a_version(spark, rows):
    spec = scd2.DimensionSpec(tracked=("name_income_type",), carried=("SK_ID_CURR", "cnt_children"))
    dim = scd2.first_versions(source(spark, [(1, "a", "h", "m", 1)]), T0, spec)
    after = scd2.apply_scd2(dim, source(spark, [(1, "a", "h", "m", 9)]), T1, spec)
    assert rows(after, "cnt_children", "is_current") == [(1, True)]


def test_as_of_join_respects_half_open_intervals(spark, rows):
    dim = scd2.first_versions(source(spark, [(1, "old", "h", "m", 0)]), T0)
    dim = scd2.apply_scd2(dim, source(spark, [(1, "new", "h", "m", 0)]), T1)
    fact = spark.sql(
        "SELECT * FROM VALUES (1, 1L, TIMESTAMP_NTZ'2023-12-31 00:00:00'), (2, 1L, TIMESTAMP_NTZ'2024-01-01 00:00:00'),"
        " (3, 1L, TIMESTAMP_NTZ'2024-01-31 23:59:59'), (4, 1L, TIMESTAMP_NTZ'2024-02-01 00:00:00'),"
        " (5, 2L, TIMESTAMP_NTZ'2024-02-01 00:00:00'), (6, 1L, NULL) AS t(f, applicant_id, at)"
    )
    expected = [(1, None), (2, "old"), (3, "old"), (4, "new"), (5, None), (6, None)]
    assert rows(scd2.join_as_of(fact, dim, "at", ["name_income_type"]), "f", "name_income_type") == expected
    for period in ("day", "month", "year"):
        joined = scd2.join_as_of(fact, dim, "at", ["name_income_type"], period=period)
        assert rows(joined, "f", "name_income_type") == expected, period


@pytest.mark.parametrize(
    ("versions", "bad"),
    [
        ([(T0, T1), (T1, None)], False),
        ([(T0, T1), (T2, None)], True),  # gap
        ([(T0, T2), (T1, None)], True),  # overlap
        ([(T0, None), (T1, None)], True),  # two open
        ([(T0, T1)], True),  # none open
        ([(T0, T0), (T0, None)], True),  # empty interval
        ([(T0, T1), (T0, T1), (T1, None)], True),  # repeated
        ([(T0, None)], False),
        ([(T0, T2), (T1, T2), (T2, None)], True),  # two versions meet one start
        ([(T0, T1), (T1, T2), (T2, None)], False),
        ([(T0, T2), (T1, T1), (T2, None)], True),
    ],
)
def test_interval_check(spark, versions, bad):
    df = spark.createDataFrame([(1, a, b, b is None) for a, b in versions],
                               "applicant_id long, start_date timestamp_ntz, end_date timestamp_ntz, is_current boolean")
    assert (scd2.interval_violations(df).count() > 0) is bad


def test_interval_check_against_sorted_chains(spark):
    """Random version sets, judged by walking each entity's versions in order."""
    rng = random.Random(3)
    days = [datetime(2024, 1, d) for d in range(1, 5)]
    versions, expected = [], set()
    for key in range(3000):
        own = []
        for _ in range(rng.randint(1, 4)):
            start = rng.choice(days)
            own.append((start, rng.choice([*days, None])))
        if rng.random() < 0.3:
            cuts = sorted(rng.sample(days, rng.randint(1, 4)))
            own = list(zip(cuts, [*cuts[1:], None]))
            rng.shuffle(own)
        versions += [(key, a, b, b is None) for a, b in own]
        chain = sorted(own, key=lambda v: (v[0], v[1] or datetime.max))
        sound = all(b is not None and a < b == nxt for (a, b), (nxt, _) in zip(chain, chain[1:])) and chain[-1][1] is None
        if not sound:
            expected.add(key)
    df = spark.createDataFrame(versions, "applicant_id long, start_date timestamp_ntz, end_date timestamp_ntz, is_current boolean")
    assert {r[0] for r in scd2.interval_violations(df).collect()} == expected
    assert 0 < len(expected) < 3000
