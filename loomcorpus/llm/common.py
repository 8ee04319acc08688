"""Shared pieces of the training-data operators: graph components, and the tables that cut lineage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcorpus.operators.tables import cleaned, delete, folder, new_path, qualified, scratch, sent, small_batches, stored, with_prefix_sums

__all__ = ["cleaned", "connected_components", "delete", "folder", "new_path", "publish", "scratch", "sent", "shared_uri", "small_batches", "stored", "with_prefix_sums"]

#: Below a folder of published files, where the attempts of tasks write.
ATTEMPTS = "_attempts"


def shared_uri(spark: SparkSession, folder: str) -> str:
    """The URI of a folder as pyarrow opens it; a path without a scheme is one of Spark's default store."""
    uri = qualified(spark, folder)
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _moved(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, base = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for attempt, name in zip(batch.column("attempt").to_pylist(), batch.column("file").to_pylist(), strict=True):
            source = f"{base}/{ATTEMPTS}/{attempt}"
            # A repeated task finds the file moved already.
            if store.get_file_info(source).type != fs.FileType.NotFound:
                store.move(source, f"{base}/{name}")
        yield batch


def publish(written: DataFrame, folder: str) -> DataFrame:
    """Give the files of ``written`` (attempt, file, ...) their names in ``folder``.

    Tasks write under ``ATTEMPTS``, each attempt under a new name. Only the attempts whose rows Spark
    committed are in the stored list, and only those are moved; what lost or repeated attempts left is deleted.
    """
    spark, listed = written.sparkSession, stored(written, "written")
    done = stored(listed.mapInArrow(lambda b: _moved(b, folder), listed.schema), "published")
    delete(spark, f"{folder}/{ATTEMPTS}")
    return done.drop("attempt")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an undirected edge list; component is the least node.

    Alternating large-star and small-star rounds, each a grouped minimum and a join, until the edge
    set no longer changes; the edges of a round are written, so the plan stays short. Nulls and
    self-loops give no edge; repeated edges count once.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        # Every node above its least neighbour is tied to that neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        # Then every node passes its lower neighbours on to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u > v").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
