"""Intel files as a stream: read once, archived, numbered on, with what is not valid beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomcorpus.operators import state
from loomcorpus.operators.keyed import KeyedTable
from loomcorpus.operators.tables import exists, scratch, stored
from loomcorpus.sources.readers import INTEL

_FIELDS = ["source", "category", "content"]


def intake(spark: SparkSession, inbox: str, archive: str, table: str, checkpoint: str, files_per_batch: int = 100, buckets: int = 16) -> StreamingQuery:
    """Read what lies in ``inbox`` (JSON objects or arrays of them), then stop; a later call goes on where this one ended.

    Valid rows get gapless ids after those that the table has and go to ``table/rows``; rows without source, category or
    content, and files that are no JSON, go to ``table/rejects`` in the same batch. A batch that is repeated after a failure gives
    the same ids and changes nothing that it had written. Files that were read are moved to ``archive``.
    """
    stream = (
        spark.readStream.schema(INTEL).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_batch)
        .option("cleanSource", "archive").option("sourceArchiveDir", archive).json(inbox)
    )
    stream = stream.select("*", F.col("_metadata.file_path").alias("file"))

    def write(batch: DataFrame, number: int) -> None:
        rows_table = KeyedTable(spark, f"{table}/rows", ["id"], buckets)
        with scratch(spark):
            rows = stored(batch.withColumn("place", F.monotonically_increasing_id()), "intel")
            valid = F.col("_corrupt_record").isNull()
            for f in _FIELDS:
                valid = valid & (F.trim(F.coalesce(f, F.lit(""))) != "")
            rows.where(~valid).drop("place").write.mode("overwrite").parquet(f"{table}/rejects/batch={number}")
            if number not in rows_table.versions():
                before = [v for v in rows_table.versions() if v < number]
                known = rows_table.read(before[-1]).select("id") if before else spark.createDataFrame([], "id long")
                good = state.append_ids(known, rows.where(valid).drop("_corrupt_record"), ["file", "place"]).drop("place")
                rows_table.merge(good, number)

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return query


def rows(spark: SparkSession, table: str) -> DataFrame | None:
    return KeyedTable(spark, f"{table}/rows", ["id"]).read()


def rejects(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.read.parquet(f"{table}/rejects") if exists(spark, f"{table}/rejects") else None
