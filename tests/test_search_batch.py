"""Batch vector search: every query gets its nearest points, across blocks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcorpus import plans
from loomcorpus.operators import search

SF = "/root/testdata/sf0.001"


def test_all_queries_are_answered(spark):
    asked = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 50 = 0").count()
    got = plans.QUERIES["t01_top_k_batch"](spark, SF).groupBy("query_id").count().collect()
    assert len(got) == asked > 1 and all(r["count"] == 10 for r in got)


@pytest.mark.parametrize("block", [4096, 7])
def test_batch_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    vectors = np.random.default_rng(1).normal(size=(60, 8)).astype(np.float32)
    vectors[3], vectors[4] = vectors[5], 0
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(60, None)], "point_id long, embedding array<float>")
    got = search.top_k_batch(rows, rows.where("point_id % 3 = 0").withColumnRenamed("point_id", "query_id"), 4, F.col("point_id") != 7)
    unit = vectors.astype(float)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)
    score = np.round(unit @ unit.T, 10)
    want = {(q, p, i + 1) for q in range(0, 60, 3) for i, p in enumerate(sorted((p for p in range(60) if p != 7), key=lambda p: (-score[q, p], p))[:4])}
    assert {(r.query_id, r.point_id, r.place) for r in got.collect()} == want
