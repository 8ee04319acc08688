"""Every registered query against its checking SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import decimal
import math

import duckdb
import pytest

from loomcorpus import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return str(int(v)) if v == int(v) else f"{float(v):.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if name not in plans.ORACLES:
        assert len(df.columns) and got is not None
        return
    want = duck.sql(plans.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == table(want.columns, want.fetchall())
