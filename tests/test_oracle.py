"""Each registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from matchledger.registry import all_queries
from oracle.statements import all_statements
from tests.compare import connect, duck_bag, spark_bag
from tests.conftest import SF_DIR

QUERIES = all_queries()
STATEMENTS = all_statements()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(contract.queries())
    assert set(STATEMENTS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(name, spark, duck):
    columns, rows = spark_bag(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_bag(duck, STATEMENTS[name])
    assert columns == expected_columns
    assert sum(expected.values()) > 0
    assert rows == expected


def test_entry_has_the_fact_schema(spark):
    assert contract.entry(spark).columns[:3] == ["player_id", "date_utc", "joined_time"]
