"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from compare import check, connect

SF_DIR = "/root/testdata/sf0.001"
ALL_QUERIES, ALL_ORACLE = entry_points.queries(), entry_points.oracle_sql()
#: The optional operators have their tests beside them.
QUERIES = {name: ALL_QUERIES[name] for name in entry_points.QUERIES}
ORACLE = {name: ALL_ORACLE[name] for name in entry_points.ORACLE}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert check(spark, con, QUERIES[name], ORACLE[name], SF_DIR) > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5 + 10 + 143 + 32 + 1
