"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import pytest
from oracle import spark_rows, sql_rows

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, name):
    assert spark_rows(entry.queries()[name](spark, FOLDER)) == sql_rows(FOLDER, entry.oracle_sql()[name])


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
