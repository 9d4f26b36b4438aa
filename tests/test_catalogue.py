"""Every query with an oracle against DuckDB on the smallest tables; the others have rows."""

import os

import duckdb
import pytest

from facetlake.plans import catalogue, figures, joins, listings, mechanisms  # noqa: F401  # the latter register their queries with the first

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return con


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("null" if r[i] is None else f"{type(r[i]).__name__}:{r[i]}" for i in order) for r in rows)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, tables, name):
    frame = catalogue.QUERIES[name](spark, SF)
    rows = frame.collect()
    if name not in catalogue.ORACLES:
        assert rows
        return
    other = tables.sql(catalogue.ORACLES[name])
    assert sorted(frame.columns) == sorted(other.columns)
    assert cells(frame.columns, [tuple(r) for r in rows]) == cells(other.columns, other.fetchall())
