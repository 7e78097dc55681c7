"""Every catalog query against its SQL counterpart on whole tables."""

import pytest
from compare import connection, difference, spark_rows, sql_rows

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, SF))
    assert got[1]
    if name in entry.oracle_sql():
        assert difference(got, sql_rows(con, entry.oracle_sql()[name])) is None
