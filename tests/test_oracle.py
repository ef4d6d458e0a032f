"""Every catalogue query against its SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from threadpulse.plans import catalogue, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


# The types both engines report for a column, by family.
_FAMILY = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF_DIR)
    want = duck.execute(oracle.oracle_sql()[name])
    want_columns = [d[0] for d in want.description]
    want_types = {d[0]: str(d[1]) for d in want.description}
    assert sorted(got.columns) == sorted(want_columns)
    assert {c: _FAMILY[t] for c, t in got.dtypes} == want_types
    expected = _rows(want_columns, want.fetchall())
    assert expected, "a query without rows proves nothing"
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == expected


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())
    assert set(catalogue.queries()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
