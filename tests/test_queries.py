"""Every registered query against its SQL, on the smallest driver tables."""

from pathlib import Path

import pytest

from tests.oracle_check import compare, duck
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    ok, detail = compare(spark, connection, name, QUERIES[name], ORACLES[name], SF)
    assert ok, detail


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
