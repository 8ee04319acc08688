"""Keyed state: no row is lost or made up, whatever the width of the rows, null orders and ties."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from loomcorpus.operators import analytics, concepts, keyed, library, points, state
from loomcorpus.streaming import streams


def test_append_ids_keeps_wide_rows(spark):
    rows = spark.range(300_000).select((F.col("id") * 7919 % 300_007).alias("key"), F.repeat(F.lit("x"), 40).alias("a"), F.col("id").alias("b"), F.lit(None).cast("long").alias("id"))
    out = state.append_ids(spark.createDataFrame([(41,)], "id long"), rows, ["key"])
    n, low, high, ids = out.agg(F.count("*"), F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert (n, low, high, ids) == (300_000, 42, 300_041, 300_000)
    first = [r.key for r in out.orderBy("id").limit(100).collect()]
    assert first == sorted(first) and set(out.columns) == {"key", "a", "b", "id"}


def test_append_ids_to_nothing(spark):
    empty = spark.createDataFrame([], "id long, v string")
    assert state.append_ids(empty, empty, ["v"]).count() == 0
    assert [r.id for r in state.append_ids(empty, spark.createDataFrame([(None, "b"), (None, "a")], "id long, v string"), ["v"]).orderBy("v").collect()] == [1, 2]


def test_last_wins_null_orders_and_ties(spark):
    rows = [(1, None, "only"), (2, None, "a"), (2, 5, "b"), (3, 7, "x"), (3, 7, "y"), (None, 1, "n")]
    for parts in (1, 4):
        got = {r.k: (r.o, r.v) for r in state.last_wins(spark.createDataFrame(rows, "k int, o int, v string").repartition(parts), ["k"], "o").collect()}
        assert got == {1: (None, "only"), 2: (5, "b"), 3: (7, "y"), None: (1, "n")}


def test_first_wins_ignores_known_and_later(spark):
    batch = spark.createDataFrame([("a", 3, "p"), ("a", 1, "q"), ("b", 2, "r"), ("c", None, "s")], "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in state.first_wins(spark.createDataFrame([("b",)], "k string"), batch, ["k"], "o").collect()}
    assert got == {"a": (1, "q"), "c": (None, "s")}


def test_merge_orders_rows_of_one_batch_and_drops_old_versions(spark, tmp_path):
    sink = streams.merge_into(str(tmp_path / "t"), ["k"], "batch", within="seq", versions=2)
    for number in range(4):
        rows = [(k, seq, f"{number}/{seq}") for k in range(number, 5) for seq in (2, 9, 4)]
        sink(spark.createDataFrame(rows, "k int, seq int, v string").repartition(3), number)
    assert {(r.k, r.v) for r in streams.current(spark, str(tmp_path / "t")).collect()} == {(0, "0/9"), (1, "1/9"), (2, "2/9"), (3, "3/9"), (4, "3/9")}
    assert keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"]).versions() == [2, 3]


def test_append_ids_keeps_any_names(spark):
    rows = spark.createDataFrame([(5, 9, 1, 2, 3, 4)], "before int, _one int, rank int, top int, row int, part int")
    got = state.append_ids(spark.createDataFrame([(7,)], "id long"), rows, ["before"]).first().asDict()
    assert got == {"before": 5, "_one": 9, "rank": 1, "top": 2, "row": 3, "part": 4, "id": 8}
    assert analytics.round_robin(rows, ["rank"], 3, "turn").first().asDict() == {"before": 5, "_one": 9, "rank": 1, "top": 2, "row": 3, "part": 4, "turn": 0}
    assert library.plan_slice(rows, "rank", 0, 5).first().asDict() == {"before": 5, "_one": 9, "rank": 1, "top": 2, "row": 3, "part": 4}


def test_merges_of_repeated_keys(spark):
    current = spark.createDataFrame([("a", "f", "p", "s", "c", 1), ("b", "f", "p", "s", "c", 1)], "hash string, filename string, path string, source string, category string, size_bytes long")
    batch = spark.createDataFrame([("a", "g", "q", "s", "c", 2, 1), ("a", "h", "a", "s", "c", 2, 2), ("n", "x", "y", "s", "c", 3, 1), ("n", "x", "z", "s", "c", 3, 0), (None, "x", "z", "s", "c", 3, 0)], "hash string, filename string, path string, source string, category string, size_bytes long, seq int")
    as_of = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    got = {r.hash: (r.filename, r.path, r.size_bytes, r.path_updated_at is not None) for r in state.catalogue_upsert(current, batch, as_of, "seq").collect()}
    assert got == {"a": ("h", "a", 1, True), "b": ("f", "p", 1, False), "n": ("x", "y", 3, False)}
    pts = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (None, "c", "x")], "id int, k string, v string")
    twice = spark.createDataFrame([("a", None), ("a", "n"), ("a", "m"), (None, "z")], "k string, v string")
    assert sorted((r.id or 0, r.v) for r in state.set_payload(pts, twice, "k", ["v"]).collect()) == [(0, "x"), (1, "n"), (2, "x")]
    new = spark.createDataFrame([(2, "q", "1"), (2, "q", "2"), (3, "r", "3"), (None, "s", "4")], "id int, k string, v string")
    assert sorted((r.id or 0, r.v) for r in points.upsert(pts, new).collect()) == [(0, "x"), (1, "x"), (2, "2"), (3, "3")]
    labels = spark.createDataFrame([("d", "t", "one", "x"), ("d", "t", "two", "y"), ("d", None, "no", "no")], "doc_hash string, title string, domain string, kind string")
    rows = spark.createDataFrame([("d", "t", "Reference", None), ("d", None, "Reference", None), ("e", "t", "Own", "k")], "doc_hash string, title string, domain string, kind string")
    for out in concepts.reclassify(rows, rows, labels, ["domain", "kind"], "Reference"):
        assert sorted((r.doc_hash, r.title or "", r.domain, r.kind) for r in out.collect()) == [("d", "", "Reference", None), ("d", "t", "two", "y"), ("e", "t", "Own", "k")]


def test_keyed_table_rewrites_only_touched_buckets(spark, tmp_path):
    def files(version):
        return {p.relative_to(tmp_path): (p.stat().st_mtime_ns, hashlib.md5(p.read_bytes()).hexdigest()) for p in (tmp_path / "t/data").rglob("*.parquet")}

    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], 16)
    table.merge(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).alias("seq")), 0)
    first = files(0)
    batch = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (5, "c", 0), (2000, "n", 0), (None, "x", 0)], "k long, v string, seq int")
    seen = table.read()  # a reader that began before
    for _ in range(2):
        keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], 99).merge(batch, 1, "seq")
    assert {k: v for k, v in files(1).items() if k in first} == first and len(files(1)) - len(first) <= 2
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == 1001 and rows[5] == "b" and rows[2000] == "n" and rows[6] == "old"
    assert seen.count() == 1000 and {r.v for r in seen.collect()} == {"old"}
    assert table.read(0).where("k = 5").first().v == "old"
    # A merge that broke off before its manifest is not seen, and is made anew.
    spark.range(3).selectExpr("id as k", "0 as _bucket").write.partitionBy("_bucket").parquet(str(tmp_path / "t/data/version=2"))
    assert table.read().count() == 1001
    table.merge(batch.withColumn("v", F.lit("again")), 2, "seq", keep=lambda df: df.where("k < 2000"))
    assert table.read().count() == 1000 and table.read().where("k = 5").first().v == "again"
    table.expire(1)
    assert table.versions() == [2] and table.read().count() == 1000


def test_keyed_table_with_a_rule(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], 4)
    add = lambda old, new: old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))
    for version in range(3):
        table.merge(spark.range(10 + version).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("n")), version, rule=add)
    assert {r.k: r.n for r in table.read().collect()} == {k: 3 - max(0, k - 9) for k in range(12)}
    table.merge(spark.createDataFrame([], "k long, n long"), 3, rule=add)
    assert table.read().count() == 12
