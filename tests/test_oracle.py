"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the entry smoke check at sf0.001."""

import pytest
from conftest import SF01
from oracle import compare, duck

import __spark_entry__ as entry
from featureflow.plans import queries as plans

QUERIES = plans.queries()
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    # exact values (doubles included, the queries round where engines could differ) and matching types
    problems, _ = compare(QUERIES[name](spark, SF01), con, SQL[name], digits=None, types=True)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF01).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["class", "precision", "recall", "f1", "support"]
