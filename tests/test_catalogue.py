"""Every query that SQL can express, against DuckDB on the same tables; the others run and give rows."""

import math
from pathlib import Path

import duckdb
import pytest

from sparktree.plans import catalogue

QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    db = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        db.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return db


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    want = duck.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    at = [want.columns.index(c) for c in names]
    assert rows == sorted(tuple(plain(r[k]) for k in at) for r in want.fetchall())
    assert rows or name in ()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
