"""Every registered query on the smallest tables: against its SQL oracle, or for rows."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()
