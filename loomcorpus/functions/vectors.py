"""Vector expressions in double precision: dot product, norm, cosine, element-wise mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, 0.0).otherwise(dot(a, b) / scale)


def centroids(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """Element-wise mean of the vectors of each group, partially aggregated per element."""
    cells = rows.select(group, F.posexplode(vector).alias("i", "x")).groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return cells.groupBy(group).agg(F.transform(ordered, lambda c: c["x"]).alias("centroid"))


def point_id(*parts: Column) -> Column:
    """First 15 hex digits of the MD5 of the parts joined by colons, as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")
