"""The inverted-list index: recall and exactness against brute force, appends, filters; the router on both sides of its bound."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcorpus.operators import search
from loomcorpus.operators.vector_index import VectorIndex

SF = "/root/testdata/sf0.001"


def _same(got, want):
    key = lambda rows: sorted((r.query_id, r.point_id, r.place, round(r.score, 9)) for r in rows)
    return key(got.collect()) == key(want.collect())


def test_recall_and_exact_search(spark, tmp_path):
    points = spark.read.parquet(f"{SF}/embeddings.parquet").withColumnRenamed("vec_id", "point_id")
    index = VectorIndex(spark, str(tmp_path / "i")).build(points)
    asked = points.where("point_id % 50 = 0").withColumnRenamed("point_id", "query_id")
    probes, recall = index.probes_for(asked, 10)
    assert recall >= 0.9 and probes < len(index.centroids())
    want = search.top_k_batch(points, asked, 10)
    found = index.search(asked, 10, probes)
    hits = found.join(want, ["query_id", "point_id"], "left_semi").count()
    assert hits >= 0.9 * want.count() and found.where(F.col("scored") >= points.count()).count() == 0
    assert _same(index.search(asked, 10, 2, exact=True), want)
    web = F.col("label") == 1
    assert _same(index.search(asked, 3, 1, where=web, exact=True), search.top_k_batch(points, asked, 3, web))


@pytest.mark.parametrize("block", [4096, 5])
def test_clusters_appends_and_odd_rows(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 8)) * 20
    rows = [(i, [float(x) for x in centres[i % 6] + draw.normal(size=8)]) for i in range(120)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8)]
    df = spark.createDataFrame(rows, "point_id long, embedding array<double>")
    first, rest = df.where("point_id % 2 = 0"), df.where("point_id % 2 = 1")
    index = VectorIndex(spark, str(tmp_path / "i")).build(first, 6)
    for _ in range(2):  # a batch that is repeated replaces itself
        index.append(rest, 1)
    assert index.points().count() == 160
    asked = df.where("point_id % 7 = 0 or point_id > 1990").withColumnRenamed("point_id", "query_id")
    want = search.top_k_batch(df.where("point_id < 2000"), asked.where("query_id < 2000"), 4)
    got = index.search(asked, 4, 1, exact=True)
    assert _same(got, want)
    # Clusters far apart: the bound leaves some points unscored.
    assert got.agg(F.avg("scored")).first()[0] < 150


def test_empty_index(spark, tmp_path):
    none = spark.createDataFrame([], "point_id long, embedding array<double>")
    index = VectorIndex(spark, str(tmp_path / "i")).build(none)
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, embedding array<double>")
    assert index.search(asked, 3, 2).count() == 0


def test_router_is_one_rule(spark, monkeypatch):
    """Ties, nulls, zeros and repeated ids get the same route below and above ``MAX_ROUTES``."""
    nan = float("nan")
    examples = spark.createDataFrame([(3, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (4, [-1.0, -1.0])], "label int, embedding array<double>")
    rows = [(1, [5.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [0.0, 2.0]), (5, [1.0, 1.0]), (6, [-1.0, 0.2]), (7, [nan, 1.0]), (7, [0.0, 1.0]), (8, [0.5, -3.0]), (None, [1.0, 0.1])]
    asked = spark.createDataFrame(rows, "point_id long, embedding array<double>")
    key = lambda df: sorted((r.point_id or 0, r.route, round(r.score, 9)) for r in df.collect())
    few = key(search.route(asked, examples, "label", -1, 0.45))
    assert [x[:2] for x in few] == [(0, 1), (1, 1), (2, -1), (3, -1), (4, 2), (5, 1), (6, 4), (7, -1), (7, 2), (8, 4)]
    assert [x[2] for x in few if x[1] == -1] == [0.0] * 3
    monkeypatch.setattr(search, "MAX_ROUTES", 2)
    assert key(search.route(asked, examples, "label", -1, 0.45)) == few
