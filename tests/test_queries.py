"""Every registered query against the SQL that states its result."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tidemark.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
SLOW = {"restart_no_dup", "stream_landing"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, duck, name):
    assert difference(spark, SF, QUERIES[name], ORACLE[name], duck) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1631
