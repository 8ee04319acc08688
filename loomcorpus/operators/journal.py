"""Plans that are carried out in slices, with a journal of what was done.

A slice of the plan is a range of its rows. The tasks of a slice carry out one operation after the other, and each writes a
line of its own journal file before it goes on to the next; the slice ends with a table of its results. A run that broke off
is taken up again by the same call: slices that have ended are passed over, and in the one that was under way the rows
that a journal names are replayed from it. An operation that was carried out but not yet written when its task was lost comes
again, so it has to bear that (a move that finds its target in place, an upsert).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcorpus.operators.library import plan_slice
from loomcorpus.operators.tables import exists, qualified, scratch, stored

_RESULT = "key string, result string"


class Journal:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _uri(self, folder: str) -> str:
        uri = qualified(self.spark, f"{self.path}/{folder}")
        return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri

    def ended(self, number: int) -> bool:
        return exists(self.spark, f"{self.path}/results/slice={number}/_SUCCESS")

    def noted(self, number: int) -> DataFrame:
        """``(key, result)`` of what the journals of a slice name; a last line that was cut off names nothing."""
        folder = f"{self.path}/notes/slice={number}"
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], _RESULT)
        lines = self.spark.read.schema(f"{_RESULT}, _corrupt_record string").option("mode", "PERMISSIVE").json(folder)
        return lines.where("key is not null and _corrupt_record is null").groupBy("key").agg(F.max("result").alias("result"))

    def run(self, plan: DataFrame, key: str, operation: Callable[[dict], str], size: int, slices: int | None = None) -> int:
        """Carry out the plan's rows, ``size`` to a slice in the order of ``key`` (unique), at most ``slices`` of them now.
        ``operation`` gets a row and gives what came of it. Gives the number of slices that have ended."""
        total = plan.count()
        done = 0
        for number in range(-(-total // size)):
            if slices is not None and done >= slices:
                break
            done += 1
            if self.ended(number):
                continue
            with scratch(self.spark):
                rows = plan_slice(plan, key, number * size, size)
                noted = stored(self.noted(number), "noted")
                left = rows.join(noted, rows[key].cast("string") == noted["key"], "left_anti").select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("row"))
                folder = self._uri(f"notes/slice={number}")
                made = left.mapInArrow(lambda b, f=folder: _carried_out(b, f, operation), _RESULT)
                # What lost or repeated tasks did twice has one row.
                results = noted.union(made).groupBy("key").agg(F.max("result").alias("result"))
                results.write.mode("overwrite").parquet(f"{self.path}/results/slice={number}")
        return done

    def results(self) -> DataFrame:
        """``(key, result, slice)`` of all slices that have ended."""
        return self.spark.read.parquet(f"{self.path}/results") if exists(self.spark, f"{self.path}/results") else self.spark.createDataFrame([], f"{_RESULT}, slice int")


def _carried_out(batches: Iterator[pa.RecordBatch], folder: str, operation: Callable[[dict], str]) -> Iterator[pa.RecordBatch]:
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base)
    with store.open_output_stream(f"{base}/{uuid.uuid4().hex}.json") as out:
        for batch in batches:
            results = []
            for key, row in zip(batch.column("key").to_pylist(), batch.column("row").to_pylist(), strict=True):
                results.append(operation(json.loads(row)))
                out.write((json.dumps({"key": key, "result": results[-1]}) + "\n").encode())
                out.flush()
            yield pa.record_batch([batch.column("key"), pa.array(results, pa.string())], names=["key", "result"])
