"""An address table laid out for look-ups: folders by country and state, rows sorted by street and number, Bloom filters for both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLACE = ["country", "state"]
#: What a look-up compares, in upper case: the table is stored so.
KEYS = ["number", "street", "city", "state", "zipcode", "country"]


def write(addresses: DataFrame, path: str, rows_per_file: int = 5_000_000, row_group_bytes: int = 32 << 20) -> None:
    """Store ``addresses`` (``KEYS`` and any other columns). A state of many rows has several files, each a range of its streets."""
    rows = addresses.withColumns({k: F.upper(F.col(k)) for k in KEYS})
    files = max(1, -(-rows.count() // rows_per_file))
    ranged = rows.repartitionByRange(files, *PLACE, "street", "number").sortWithinPartitions(*PLACE, "street", "number")
    out = ranged.write.mode("overwrite").partitionBy(*PLACE).option("parquet.block.size", row_group_bytes)
    for column in ("street", "number", "zipcode"):
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
    out.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored table; the folder columns stay text, and an empty one is null again."""
    return spark.read.option("basePath", path).schema(_schema(spark, path)).parquet(path)


def _schema(spark: SparkSession, path: str):
    found = spark.read.parquet(path).schema
    for f in found.fields:
        if f.name in PLACE:
            f.dataType = spark.createDataFrame([], "x string").schema["x"].dataType
    return found


def look_up(spark: SparkSession, path: str, number: str, street: str, **further: str) -> DataFrame:
    """The addresses of a number and street, and of what else is stated (city, state, zipcode, country). With a state only its
    folder is opened; the order of the rows and the filters let all but the row groups that can hold the street be skipped."""
    wanted = {"number": number, "street": street} | further
    condition: Column = F.lit(True)
    for k, v in wanted.items():
        if k not in KEYS:
            raise ValueError(f"{k} is no part of an address")
        condition = condition & (F.col(k) == v.upper())
    return read(spark, path).where(condition)


def look_up_all(spark: SparkSession, path: str, asked: DataFrame, query_id: str = "query_id") -> DataFrame:
    """``(query_id, ...)``: the addresses of every row of ``asked`` (query_id, number, street, and any of the other ``KEYS``;
    a null states nothing). Joined on number and street, which both sides must have."""
    further = [c for c in KEYS[2:] if c in asked.columns]
    keys = asked.select(F.col(query_id), *[F.upper(F.col(c)).alias(f"_{c}") for c in ["number", "street", *further]])
    rows = read(spark, path)
    met = (rows["number"] == keys["_number"]) & (rows["street"] == keys["_street"])
    for c in further:
        met = met & (keys[f"_{c}"].isNull() | (rows[c] == keys[f"_{c}"]))
    return rows.join(keys, met).select(query_id, *rows.columns)
