import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sedimenta.llm.exact_dedup import dedup, exact_groups
from tests.llm.conftest import ODD


def brute(rows):
    """(id, keep_id, size, kept, sha) of rows (id, text), as a sorted list."""
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for i, n in enumerate(norm):
        groups.setdefault(n, []).append(i)
    out = []
    for n, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        out += [(rows[i][0], rows[best][0], len(members), i == best, hashlib.sha256(n.encode()).hexdigest()) for i in members]
    return sorted(out, key=repr)


def found(df, **more):
    got = exact_groups(df, **more).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted((tuple(r) for r in got), key=repr)


def test_equals_brute_force(odd, clashing):
    want = brute([r[:2] for r in ODD])
    assert found(odd) == want
    assert found(clashing) == want


@pytest.mark.parametrize("digest", [lambda c: F.lit(b"same"), lambda c: F.unhex(F.substring(F.md5(c), 1, 2))])
def test_bytes_decide_where_hashes_collide(odd, digest):
    assert found(odd, digest=digest) == brute([r[:2] for r in ODD])


def test_one_row_of_each_group_stays(odd, clashing, empty):
    kept = dedup(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r[0] for r in brute([r[:2] for r in ODD]) if r[3]), key=repr)
    assert dedup(clashing).columns == clashing.columns
    assert dedup(empty).count() == exact_groups(empty).count() == 0
