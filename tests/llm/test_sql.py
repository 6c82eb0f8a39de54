"""The text queries that SQL can express, against it."""

import pytest

from bedhour.llm import queries
from compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    assert compare(spark, duck(SF), queries.QUERIES[name], queries.ORACLE[name], SF) is None
