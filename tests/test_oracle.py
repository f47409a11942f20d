"""Every registered query against its SQL, on the whole test tables."""

import os

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, kinds_of, rows_of

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry_module.queries()[name](spark, SF_DIR).toArrow()
    expected = duck.execute(entry_module.oracle_sql()[name]).to_arrow_table()
    got_names, got_rows = rows_of(got)
    expected_names, expected_rows = rows_of(expected)
    assert got_names == expected_names
    assert kinds_of(got) == kinds_of(expected)
    assert len(got_rows) == len(expected_rows) > 0
    assert got_rows == expected_rows


def test_every_sql_has_its_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
