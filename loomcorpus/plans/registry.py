"""Registry of queries: a Spark function and, where SQL can express it, the equal DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomcorpus.sources import bindings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, longs: str = "") -> Callable[[Callable[[bindings.Tables], DataFrame]], Callable]:
    """Register ``f(tables)`` under ``name``. Bound views named in ``sql`` are put before it as CTEs.

    ``longs`` names columns whose sums DuckDB widens beyond 64 bits; they are cast back.
    """

    def add(f: Callable[[bindings.Tables], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = lambda spark, sf_dir: f(bindings.Tables(spark, sf_dir))
        if sql is not None:
            full = bindings.with_views(sql)
            casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in longs.split())
            ORACLES[name] = f"SELECT * REPLACE ({casts}) FROM ({full}) q" if casts else full
        return f

    return add
