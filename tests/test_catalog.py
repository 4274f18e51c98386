"""Every query with SQL beside it gives the rows that DuckDB gives."""

import os

import duckdb
import pytest

from stratavox import catalog


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        path = f"{sf}/{f}" + ("/*.parquet" if os.path.isdir(f"{sf}/{f}") else "")
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    got = df.collect()
    if name not in catalog.ORACLES:
        assert got and len(set(df.columns)) == len(df.columns) == len(got[0])
        return
    found = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, found.fetchall())
