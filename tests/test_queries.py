"""Every registered query against its SQL on the smallest tables; the others must have rows."""

import pytest

import __spark_entry__ as contract
from check import connect, difference
from millrace.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, database, name):
    assert difference(QUERIES[name](spark, FOLDER), database.execute(ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
