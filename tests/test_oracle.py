"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_a_stable_schema(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["geography", "n", "label_rate"]
    assert frame.count() > 0
