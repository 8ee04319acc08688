"""Continuous forms of the pipeline steps with Structured Streaming.

The status column of the reference's polled tables becomes the query's checkpoint: each step reads
what is new, and ``foreachBatch`` merges by key, so a batch that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomcorpus.operators import library, state
from loomcorpus.operators.keyed import KeyedTable
from loomcorpus.sources import readers

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Event files as a stream, in event time."""
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def snapshots(rows: DataFrame, every: str = "2 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per metric and window, with a watermark that bounds the state."""
    grouped = rows.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), F.col("event_type").alias("metric_type"))
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("minute"), "metric_type", "n", "total")


def sessions(rows: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    grouped = rows.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return grouped.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def unseen(rows: DataFrame, key: str = "event_id", late: str = "1 hour") -> DataFrame:
    """First row of each key within the watermark."""
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def interval_join(left: DataFrame, right: DataFrame, key: str, within: str = "1 hour") -> DataFrame:
    """Rows of ``right`` that follow a row of ``left`` of the same key within an interval."""
    a = left.withWatermark("ts", within).select(F.col(key).alias("_k"), F.col("ts").alias("left_ts"), F.col("event_id").alias("left_id"))
    b = right.withWatermark("ts", within).select(key, F.col("ts").alias("right_ts"), F.col("event_id").alias("right_id"))
    near = (F.col("_k") == F.col(key)) & (F.col("right_ts") >= F.col("left_ts")) & (F.col("right_ts") <= F.col("left_ts") + F.expr(f"INTERVAL {within}"))
    return a.join(b, near).select(key, "left_id", "right_id")


def merge_into(path: str, keys: list[str], order: str, keep: Callable[[DataFrame], DataFrame] | None = None, within: str | None = None, versions: int = 3, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` that merges into a ``KeyedTable``, last row of a key winning, and only rewrites the buckets it touches.

    A later batch wins over an earlier one; ``order`` receives the number of the batch. Inside a batch
    the row of greatest ``within`` wins (ties, and rows without such a column: the greatest row by its
    other fields). A repeated batch changes nothing, and the newest ``versions`` stay. ``keep`` can drop rows by
    age, which is retention and not a watermark.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = KeyedTable(batch.sparkSession, path, keys, buckets)
        table.merge(batch.withColumn(order, F.lit(number).cast("long")), number, within, keep=keep)
        table.expire(versions)

    return write


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a merged table."""
    return KeyedTable(spark, path, []).read()


def run_available(rows: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Process all that is there in micro-batches, then stop: one poll of a stage loop."""
    query = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    return query


def pending(documents: DataFrame, stage_input: str) -> DataFrame:
    """What a stage has left to do, and whether everything before it is done."""
    order = state.FLOW.index(stage_input)
    upstream = [s for s in state.FLOW[:order]]
    return documents.agg(F.count_if(F.col("status") == stage_input).alias("ready"), F.count_if(F.col("status").isin(upstream) if upstream else F.lit(False)).alias("upstream"))


def polled(spark: SparkSession, step: Callable[[int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``step(number)`` once per ``every``, or once in all without it.

    The query's checkpoint counts the polls; a step that failed is run again under its number.
    """
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    trigger = {"processingTime": every} if every else {"once": True}
    return ticks.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(lambda rows, number: step(number)).start()


def arrivals(files: DataFrame, known: DataFrame, as_of: Column, seconds: int, key: str = "hash") -> DataFrame:
    """Files that are new and have been still for ``seconds``; of files of one key the first by path."""
    still = readers.stable(files, as_of, seconds).join(known.select(key).distinct(), key, "left_anti")
    return state.first_wins(known.select(key), still, [key], "path")


def dispatch(files: DataFrame, known: DataFrame, as_of: Column, seconds: int, processors: dict[str, str]) -> DataFrame:
    """``(hash, path, meta_file, processor)`` of what has arrived in the hopper: content and sidecar by base
    name; the extension chooses the processor, and files without one are left out."""
    here = arrivals(files, known, as_of, seconds)
    base = F.regexp_replace("path", r"(\.meta\.json|\.[^./]*)$", "")
    kind = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))
    content = here.where(~F.col("path").endswith(".meta.json")).select("hash", "path", base.alias("base"), kind.alias("kind"))
    meta = files.where(F.col("path").endswith(".meta.json")).groupBy(base.alias("base")).agg(F.min("path").alias("meta_file"))
    chosen = F.lit(None).cast("string")
    for extension, processor in processors.items():
        chosen = F.when(F.col("kind") == extension, processor).otherwise(chosen)
    return content.join(meta, "base", "left").select("hash", "path", "meta_file", chosen.alias("processor")).where("processor is not null")


def to_file(documents: DataFrame) -> DataFrame:
    """What a filing worker has to place: complete documents that aren't organized."""
    return documents.where((F.col("status") == "complete") & F.col("organized_at").isNull())


def watched(files: DataFrame, documents: DataFrame, as_of: Column, seconds: int, acquired: str, ingest: str) -> tuple[DataFrame, DataFrame]:
    """The two phases of a watchdog: the still files of the acquired folder with their action, and the
    documents of the ingest folder that are ready to be placed."""
    still = readers.stable(files, as_of, seconds).where(F.contains("path", F.lit(acquired)))
    first = still.join(documents.select("hash", "status"), "hash", "left")
    return first.select("hash", "path", library.acquire_action(F.col("status")).alias("action")), to_file(documents).where(F.contains("path", F.lit(ingest)))
