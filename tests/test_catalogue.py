"""Every query of the catalogue against its SQL statement in DuckDB."""

import compare
import pytest

import __spark_entry__ as driver
from trialmart.plans import catalog, oracle as statements


@pytest.fixture(scope="module")
def oracle(folder):
    return compare.oracle_connection(folder)


def test_every_query_has_a_statement():
    assert set(catalog.catalogue()) == set(statements.statements())


@pytest.mark.parametrize("name", sorted(catalog.catalogue()))
def test_query_matches_sql(spark, folder, oracle, name):
    df = driver.queries()[name](spark, folder)
    assert compare.differences(df, oracle, driver.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
