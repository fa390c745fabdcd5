"""Queries against their SQL on the small tables."""

import glob
import os

import pytest

from tabletide.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    found = con.execute(SQL[name])
    columns = [c[0] for c in found.description]
    df = QUERIES[name](spark, small)
    assert set(columns) == set(df.columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(found.fetchall())
