"""Every registered query against the SQL that states it, or for a non-empty result."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_queries import compare, database

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return database(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    ok, message, _ = compare(spark, con, folder, name, QUERIES[name], SQL.get(name))
    assert ok, message


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["probes"] > 0 and 0 <= rows[0]["accuracy"] <= 100


def test_registry():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) > 90
