"""The training-data operators against their checking SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from loomcorpus.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    key = lambda row: tuple((v is not None, v) for v in row)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    assert got == sorted(want.project(", ".join(columns)).fetchall(), key=key)
