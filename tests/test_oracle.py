"""Every query with a SQL statement gives exactly the statement's result."""

import __spark_entry__ as contract
import pytest
from oracle_compare import connect, differences

SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, sf, name):
    assert differences(duck, QUERIES[name](spark, sf), SQL[name]) == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
