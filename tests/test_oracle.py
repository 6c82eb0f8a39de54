"""Every query against its SQL, on the smallest test data."""

import pytest

import __spark_entry__ as entry
from bedhour.testbed.oracle import ORACLE
from bedhour.testbed.queries import QUERIES
from compare import compare, duck

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, QUERIES[name], ORACLE[name], SF)
    if problem == "no rows to compare":
        problem = compare(spark, duck(LARGER), QUERIES[name], ORACLE[name], LARGER)
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
