"""The registered queries against their SQL in DuckDB, on the smallest shared tables."""

import compare
import pytest

from trialmart.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.catalogue()) == list(range(1, 14))
    assert set(oracle.statements()) <= set(queries.catalogue())


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, name):
    connection = compare.oracle_connection(FOLDER)
    assert compare.differences(queries.catalogue()[name](spark, FOLDER), connection, oracle.statements()[name]) == []
