"""Every registered query against its SQL in another engine, on the small driver tables."""

import pytest

import __spark_entry__ as entry_module
from ledgerloom.plans import catalog
from tests.parity import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    problem, _ = compare(spark, con, FOLDER, name, entry_module.oracle_sql()[name])
    assert not problem


def test_entry_shows_known_breaks(spark):
    found = {r.break_type for r in entry_module.entry(spark).collect()}
    assert found == {"CASH_BALANCE_BREAK", "MISSING_IN_CUSTODIAN", "MISSING_IN_INTERNAL"}
