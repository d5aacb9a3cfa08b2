"""Queries that SQL can express, against DuckDB on whole tables."""

import pytest
from conftest import SF01
from oracle import compare, duck

from featureflow.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, name):
    problems, _ = compare(queries()[name](spark, SF01), duck(SF01), oracle_sql()[name], digits=None, types=True)
    assert not problems, problems
