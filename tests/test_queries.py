"""Every registered query with SQL agrees with DuckDB on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks import compare as C

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = C.duck(sf_dir)
    yield con
    con.close()


def test_entry(spark):
    assert entry.entry(spark).count() == 1500


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    assert C.compare(df, duck, SQL[name]) is None
