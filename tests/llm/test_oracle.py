"""Each registered query with a statement against its SQL, and each one's run over whole tables."""

import pytest

from matchledger.llm.registry import llm_queries, llm_statements
from tests.compare import connect, duck_bag, spark_bag
from tests.conftest import SF_DIR

STATEMENTS = llm_statements()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_agrees_with_sql(name, spark, duck):
    columns, rows = spark_bag(llm_queries()[name](spark, SF_DIR))
    expected_columns, expected = duck_bag(duck, STATEMENTS[name])
    assert columns == expected_columns
    assert sum(expected.values()) > 0
    assert rows == expected


def test_names_are_numbered_one_to_thirteen():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))
