"""Every registered query of the subpackage that has a SQL form, on the smallest tables."""

import pytest

from linkloom.llm.queries import QUERIES
from oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_sql(spark, name):
    query, sql = QUERIES[name]
    left_columns, right_columns, left, right = compare(spark, query, sql, SF_DIR, duck(SF_DIR))
    assert left_columns == right_columns
    assert left == right
    assert left
