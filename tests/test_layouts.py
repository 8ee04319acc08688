"""Address layout, pages of ranges, journalled plans, and the intel stream over restarts."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomcorpus.operators import addresses, paging
from loomcorpus.operators.journal import Journal
from loomcorpus.streaming import intake


def scan(df, metric):
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return rows, leaves.head().metrics().apply(metric).value()


def test_addresses_read_one_state(spark, tmp_path):
    rows = spark.range(60_000).select(
        (F.col("id") % 500).cast("string").alias("number"), F.concat(F.lit("street "), (F.col("id") % 3001).cast("string")).alias("street"), F.lit("Town").alias("city"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("S"), (F.col("id") % 3).cast("string"))).alias("state"), F.lit("01234").alias("zipcode"), F.lit("US").alias("country"), F.rand(3).alias("lat"),
    )
    path = str(tmp_path / "a")
    addresses.write(rows, path, rows_per_file=6000, row_group_bytes=1 << 14)
    stored = addresses.read(spark, path)
    assert stored.count() == 60_000 and stored.where("state is null").count() == rows.where("state is null").count() and stored.first().zipcode == "01234"
    upper = F.upper("street")
    want = lambda c: rows.where(c).count()
    got, files = scan(addresses.look_up(spark, path, "7", "Street 1508", state="s1"), "numFiles")
    assert len(got) == want((F.col("number") == "7") & (upper == "STREET 1508") & (F.col("state") == "S1"))
    assert files == len(list((tmp_path / "a").glob("country=US/state=S1/*.parquet"))) < len(list((tmp_path / "a").rglob("*.parquet")))
    got, read = scan(addresses.look_up(spark, path, "7", "street 1508"), "numOutputRows")
    assert len(got) == want((F.col("number") == "7") & (upper == "STREET 1508")) and read < 20_000
    assert addresses.look_up(spark, path, "7", "no such street").count() == 0
    asked = spark.createDataFrame([(1, "7", "street 1508", "S1"), (2, "7", "STREET 1508", None), (3, "x", "y", None)], "query_id int, number string, street string, state string")
    found = {r.query_id: r["count"] for r in addresses.look_up_all(spark, path, asked).groupBy("query_id").count().collect()}
    assert found == {k: v for k, v in {1: want((F.col("number") == "7") & (upper == "STREET 1508") & (F.col("state") == "S1")), 2: want((F.col("number") == "7") & (upper == "STREET 1508"))}.items() if v}
    with pytest.raises(ValueError):
        addresses.look_up(spark, path, "1", "x", planet="earth")


@pytest.mark.parametrize("descending", [False, True])
def test_pages_read_their_range(spark, tmp_path, descending):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v"))
    paging.write(rows, str(tmp_path / "p"), ["k"], descending, rows_per_range=100)
    pages = paging.Pages(spark, str(tmp_path / "p"), 30)
    assert (pages.total, pages.pages) == (1000, 34)
    keys = [r.k for n in range(1, 35) for r in pages.page(n).collect()]
    assert keys == sorted(range(1000), reverse=descending)
    assert [r.k for r in pages.page(99).collect()] == keys[-10:] and [r.k for r in pages.page(-1).collect()] == keys[:30]
    df = pages.page(17)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows17 = df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert len(rows17) == 30 and leaf.metrics().apply("numFiles").value() <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    paging.write(rows.limit(0), str(tmp_path / "e"), ["k"])
    empty = paging.Pages(spark, str(tmp_path / "e"), 30)
    assert empty.pages == 1 and empty.page(1).count() == 0


def test_a_plan_that_breaks_off(spark, tmp_path):
    """A run that dies in a slice is taken up again: each row has one result, and what was noted isn't done again."""
    done = tmp_path / "done"
    done.mkdir()
    bomb = tmp_path / "bomb"
    bomb.write_text("x")

    def operation(row, done=str(done), bomb=str(bomb)):
        import os

        if row["k"] == 57 and os.path.exists(bomb):
            raise RuntimeError("lost")
        with open(f"{done}/{row['k']}", "a") as f:
            f.write("x")
        return f"did {row['v']}"

    plan = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    journal = Journal(spark, str(tmp_path / "j"))
    with pytest.raises(Exception, match="lost"):
        journal.run(plan, "k", operation, 25)
    assert journal.ended(1) and not journal.ended(2) and journal.results().count() == 50
    noted = {r.key for r in journal.noted(2).collect()}
    bomb.unlink()
    assert Journal(spark, str(tmp_path / "j")).run(plan, "k", operation, 25) == 4
    assert {(r.key, r.result) for r in journal.results().collect()} == {(str(k), f"did {2 * k}") for k in range(100)} and journal.results().count() == 100
    times = {p.name: len(p.read_text()) for p in done.iterdir()}
    assert len(times) == 100 and all(n == 1 for k, n in times.items() if k in noted or not 50 <= int(k) < 75)
    assert journal.run(plan, "k", operation, 25) == 4 and {len(p.read_text()) for p in done.iterdir()} <= {1, 2}
    assert Journal(spark, str(tmp_path / "none")).run(plan.limit(0), "k", operation, 5) == 0


def test_intake_over_restarts(spark, tmp_path):
    inbox, archive = tmp_path / "in", tmp_path / "archive"
    inbox.mkdir()
    good = lambda i: {"source": "s", "category": "c", "content": f"text {i}"}
    run = lambda: intake.intake(spark, str(inbox), str(archive), str(tmp_path / "t"), str(tmp_path / "cp"), files_per_batch=2)
    (inbox / "a.json").write_text(json.dumps([good(1), good(2), {"source": "s"}]))
    (inbox / "b.json").write_text(json.dumps(good(3)))
    (inbox / "c.json").write_text("{broken")
    run()
    assert {r.content for r in intake.rows(spark, str(tmp_path / "t")).collect()} == {"text 1", "text 2", "text 3"}
    first = {r.id: r.content for r in intake.rows(spark, str(tmp_path / "t")).collect()}
    (inbox / "d.json").write_text(json.dumps([good(4), good(4), good(5) | {"content": " "}]))
    run()
    run()
    rows = {r.id: r.content for r in intake.rows(spark, str(tmp_path / "t")).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5] and {k: rows[k] for k in first} == first and [rows[4], rows[5]] == ["text 4"] * 2
    assert intake.rejects(spark, str(tmp_path / "t")).count() == 3
    (inbox / "e.json").write_text(json.dumps(good(6)))
    run()
    assert any(archive.rglob("a.json")) and intake.rows(spark, str(tmp_path / "t")).count() == 6
