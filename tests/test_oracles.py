"""Every query that has SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from clustrata.plans import queries as q

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def plain(df):
    columns = sorted(df.columns)

    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "item"):
            v = v.item()
        return v if isinstance(v, (str, bool)) else float(v) + 0.0

    return columns, sorted(repr([value(v) for v in row]) for row in df[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_query(spark, duck, name):
    got, want = plain(q.QUERIES[name](spark, str(DATA)).toPandas()), plain(duck.sql(q.SQL[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
