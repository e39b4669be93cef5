"""Every registered query against its SQL form; ``ORACLE_SF_DIR`` picks larger tables."""

import os

import pytest

import __spark_entry__ as entry_file
from oracle import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# Queries of the llm subpackage have tests of their own there.
REGISTERED = {n: p for stage in entry_file.LIBRARY for n, p in stage.QUERIES.items()}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_sql(spark, con, name):
    left_columns, right_columns, left, right = compare(spark, *REGISTERED[name], SF_DIR, con)
    assert left_columns == right_columns
    assert left == right
    assert left


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["page_id", "url", "n_paragraphs", "n_words"]
    assert df.count() > 0
