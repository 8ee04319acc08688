"""The stateful stage loop over files that arrive one by one, with a restart after each: nothing lost, nothing run twice."""

from __future__ import annotations

import datetime
from collections import Counter

import pytest

from loomcorpus.streaming import stages

START = datetime.datetime(2026, 1, 1, 12)
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    yield spark
    spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run(spark, tmp_path, batches, **options):
    """Each batch is one file, and each is processed by a query of its own that continues from the checkpoint."""
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        events = [(h, e, START + datetime.timedelta(seconds=s), m) for h, e, s, m in rows]
        spark.createDataFrame(events, "hash string, event string, at timestamp, message string").coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("hash string, event string, at timestamp, message string").parquet(inbox)
        actions = stages.stage(stream, ["timeout"], retries=3, base_seconds=10, cap_seconds=15, stale_seconds=100, **options)
        query = actions.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    rows = spark.read.schema(stages.OUTPUT).parquet(out).collect()
    return sorted(((r.at - START).total_seconds(), r.hash, r.action, r.attempt) for r in rows)


def test_every_document_ends_once(rocks, tmp_path):
    tick = lambda s: [("clock", "tick", s, None)]  # noqa: E731  moves the watermark
    batches = [
        [("a", "arrived", 0, None), ("b", "arrived", 1, None), ("c", "arrived", 2, None), ("d", "arrived", 3, None), ("a", "arrived", 4, None), (None, "arrived", 4, None)],
        [("a", "done", 10, None), ("b", "error", 11, "Timeout in request"), ("c", "error", 12, "bad key")],
        tick(25), tick(26),
        [("b", "error", 30, "timeout"), ("a", "arrived", 31, None), ("c", "done", 32, None)],
        tick(50), tick(51),
        [("b", "done", 55, None)],
        tick(150), tick(151), tick(300), tick(301), tick(500), tick(501),
    ]
    got = run(rocks, tmp_path, batches)
    assert got == [
        (0, "a", "run", 1), (1, "b", "run", 1), (2, "c", "run", 1), (3, "d", "run", 1), (10, "a", "complete", 1), (12, "c", "failed", 1), (21, "b", "run", 2),
        (45, "b", "run", 3), (55, "b", "complete", 3), (103, "d", "recovered", 2), (203, "d", "recovered", 3), (303, "d", "failed", 3),
    ]
    ended = Counter(h for _, h, action, _ in got if action in ("complete", "failed"))
    assert ended == {"a": 1, "b": 1, "c": 1, "d": 1}


def test_loop_stops_when_idle():
    """A step without work goes on polling while something before it is still to come."""
    todo = {"extract": [3, 2], "enrich": [0, 0, 4, 1]}
    left = {"extract": 0, "enrich": 5}

    def step(name):
        n = todo[name].pop(0) if todo[name] else 0
        if name == "enrich":
            left["enrich"] -= n
        return n

    got = stages.run_stages({n: (lambda n=n: step(n)) for n in todo}, lambda n: left[n], idle_polls=2, wait_seconds=0)
    assert got == {"extract": 5, "enrich": 5} and not any(todo.values())
    assert stages.run_stages({"x": lambda: 1}, lambda n: 0, polls=3, wait_seconds=0) == {"x": 3}
