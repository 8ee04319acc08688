"""Pages of a sorted table: stored by ranges of its order with their sizes, so that a page reads the range it lies in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write(rows: DataFrame, path: str, order: Sequence[str], descending: bool = False, rows_per_range: int = 1_000_000) -> None:
    """Store ``rows`` in the order of ``order`` (unique), about ``rows_per_range`` to a range."""
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    n = max(1, -(-rows.count() // rows_per_range))
    ranged = rows.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id())
    placed = ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1)
    placed.write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
    # What the driver has to know of a table: its columns, and one number for each range.
    stored = rows.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    sizes = stored.groupBy("_range").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.collect_list(F.struct("_range", "n"))).alias("sizes"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    sizes.withColumn("kinds", F.lit(kinds)).coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")


class Pages:
    """Reads the pages of a stored table. The sizes, one number for each range, are held by the driver."""

    def __init__(self, spark: SparkSession, path: str, size: int) -> None:
        self.spark, self.path, self.size = spark, path, size
        self.sizes, self.kinds = spark.read.parquet(f"{path}/sizes").select("sizes", "kinds").first()
        self.total = sum(self.sizes.values())
        #: There is one page at least.
        self.pages = max(1, -(-self.total // size))

    def page(self, number: int) -> DataFrame:
        """The rows of a page, counted from 1 and clamped to the pages there are, in order."""
        number = min(max(1, number), self.pages)
        first, end = (number - 1) * self.size, number * self.size
        before, wanted = 0, F.lit(False)
        for k in sorted(self.sizes):
            low, high = max(first, before), min(end, before + self.sizes[k])
            if low < high:
                wanted = wanted | ((F.col("_range") == k) & F.col("_place").between(low - before, high - before - 1))
            before += self.sizes[k]
        rows = self.spark.read.schema(self.kinds).parquet(f"{self.path}/rows").where(wanted)
        return rows.orderBy("_range", "_place").drop("_range", "_place")
