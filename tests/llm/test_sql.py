"""The SQL of the corpus queries gives their rows, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from clustrata.llm import queries

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_rows(spark, duck, name):
    got, want = queries.QUERIES[name](spark, str(DATA)), duck.sql(queries.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda rows: sorted(map(repr, (tuple(r) for r in rows)))
    assert key(got.select(*columns).collect()) == key(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())
