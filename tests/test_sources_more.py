"""Sidecars, manifests, uploads, reports, polls and gates on small inputs."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from loomcorpus.functions import text as X
from loomcorpus.operators import archives, library, points, search
from loomcorpus.sources import readers
from loomcorpus.streaming import streams


def test_sidecars_and_manifests(spark, tmp_path):
    (tmp_path / "h1").mkdir()
    (tmp_path / "h1" / "meta.json").write_text(json.dumps({"source_type": "zim", "article_path": "A/b c", "zim_file": "w.zim", "page_timestamps": {"page_0001": 1.5}}))
    (tmp_path / "h2.meta.json").write_text("no json")
    got = {r.base: r for r in readers.sidecars(spark, str(tmp_path)).collect()}
    assert got["h1"].source_type == "zim" and got["h1"].page_timestamps == {"page_0001": 1.5} and got["h2"].source_type is None
    docs = spark.createDataFrame([("h1", "f.html", "/library/f", None, None), ("h3", "g.pdf", "/library/a b/g.pdf", "B", None)], "hash string, filename string, path string, book_title string, book_author string")
    concepts = spark.createDataFrame([("h1", 0, 1, "ten chars and more"), ("h1", 1, 1, "short"), ("h3", 0, 1, "ten chars and more")], "doc_hash string, idx int, start_page int, content string")
    built = {r.payload.doc_hash: r.payload for r in points.build(concepts, readers.with_sidecar(docs, readers.sidecars(spark, str(tmp_path))), spark.createDataFrame([("h1", "kiwix")], "hash string, source string"), "https://l.example/", "https://a.example").collect()}
    assert built["h1"].download_url == "https://a.example/content/w/A/b%20c" and built["h1"].source == "kiwix" and built["h3"].source_type == "document"
    (tmp_path / "m.json").write_text(json.dumps([{"hash": "a", "current_path": "/x", "proposed_path": "/y", "filename": "n"}, {"hash": "b", "current_path": "/x", "sanitized_path": "/x", "sanitized_filename": "n"}, {"hash": "c", "ambiguous": True, "sanitized_path": "/z", "filename": "n"}]))
    plan = readers.manifest(spark, str(tmp_path / "m.json"))
    action = library.manifest_action(F.col("target"), F.col("name"), F.col("ambiguous"), F.col("current_path"), F.col("current_path").isNotNull())
    assert [r[0] for r in plan.orderBy("hash").select(action).collect()] == ["moved", "already_organized", "skipped"]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    assert sorted(r.a for r in readers.json_lines(spark, str(tmp_path / "l.jsonl"), "a int").collect()) == [1, 2]


def test_page_files(spark, tmp_path):
    (tmp_path / "abc").mkdir()
    for n in (1, 2):
        (tmp_path / "abc" / f"page_{n:04}.txt").write_text(f"p{n}\nx")
    (tmp_path / "abc" / "meta.json").write_text("{}")
    assert [(r.hash, r.page_no, r.text) for r in readers.page_files(spark, str(tmp_path)).orderBy("page_no").collect()] == [("abc", 1, "p1\nx"), ("abc", 2, "p2\nx")]


def test_uploads(spark):
    files = spark.createDataFrame([("a.pdf", b"x"), ("b.PDF", b"x"), ("c.exe", b"y"), ("d.pdf", b""), ("e.pdf", b"k")], "filename string, content binary")
    known = spark.createDataFrame([(__import__("hashlib").md5(b"k").hexdigest(),)], "hash string")
    got = {r.filename: r.action for r in readers.uploads(files, known, known.limit(0), ["pdf"]).collect()}
    assert got == {"a.pdf": "accepted", "b.PDF": "duplicate", "c.exe": "bad_type", "d.pdf": "empty", "e.pdf": "duplicate"}


def test_reports(spark, tmp_path):
    plan = spark.createDataFrame([("h", "p", "relocate", "f", "n", 1), ("i", "p", "rescue", "f", "n", None)], "hash string, path string, action string, folder string, name string, step int")
    top = spark.createDataFrame([("T", 3), ("S", 4)], "title string, n long")
    readers.write_report(plan, library.sweep_statistics(plan), str(tmp_path), top)
    lines = [x for f in sorted((tmp_path / "report").glob("part*")) for x in f.read_text().splitlines()]
    assert lines == ["| what | n |", "|-|-|", "| action relocate | 1 |", "| action rescue | 1 |", "| step 1 | 1 |", "| title | n |", "|-|-|", "| S | 4 |", "| T | 3 |"]
    assert spark.read.json(str(tmp_path / "plan")).count() == 2


def test_polls(spark, tmp_path):
    files = spark.createDataFrame([("a", "/hop/x.pdf", 10), ("b", "/hop/y.txt", 99), ("c", "/hop/z.epub", 10), ("d", "/hop/x.meta.json", 10), ("e", "/hop/_acquired/q.pdf", 10)], "hash string, path string, t int")
    files = files.withColumn("modified_at", F.timestamp_seconds("t"))
    known = spark.createDataFrame([("k",)], "hash string")
    as_of = F.timestamp_seconds(F.lit(100))
    got = {r.hash: (r.meta_file, r.processor) for r in streams.dispatch(files, known, as_of, 5, {"pdf": "pdf", "txt": "text"}).collect()}
    assert got == {"a": ("/hop/x.meta.json", "pdf"), "e": (None, "pdf")}
    docs = spark.createDataFrame([("e", "complete", "/in/q", None), ("f", "complete", "/lib/r", None), ("g", "queued", "/in/s", None)], "hash string, status string, path string, organized_at timestamp")
    first, second = streams.watched(files, docs, as_of, 5, "_acquired", "/in/")
    assert [(r.hash, r.action) for r in first.collect()] == [("e", "duplicate")] and [r.hash for r in second.collect()] == ["e"]
    seen = []
    for _ in range(2):
        streams.polled(spark, seen.append, str(tmp_path / "cp")).awaitTermination(60)
    assert seen == [0, 1]


def test_archive_actions(spark):
    body = "<p>" + "words of an article " * 20 + "</p>"
    rows = [("A/a", "text/html", False, body), ("A/b", "text/html", None, body), ("A/c/de", "text/html", False, body), ("A/d/xyz", "text/html", False, "<p>short</p>"), ("A/e", "image/png", False, body),
            ("A/f", "text/html", True, body), ("A/g", "text/html", False, body + "seen"), ("A/h", "text/html", False, "<p>" + "known text " * 30), ("A/i", None, False, body)]
    entries = spark.createDataFrame([(p, "t", m, r, h) for p, m, r, h in rows], "path string, title string, mimetype string, redirect boolean, html string")
    known = spark.createDataFrame([(("known text " * 30).strip(),)], "t string").select(F.md5("t").alias("hash"))
    out = archives.article_actions(entries, spark.createDataFrame([("A/g",)], "path string"), known)
    assert {r.path: r.action for r in out.collect()} == {"A/a": "article", "A/b": "duplicate", "A/c/de": "foreign", "A/d/xyz": "stub", "A/e": "ignored", "A/f": "ignored", "A/g": "ignored", "A/h": "duplicate", "A/i": "ignored"}
    assert archives.article_pages(out, 40).count() == 1


def test_page_starts_and_routes(spark, monkeypatch):
    pages = spark.createDataFrame([("k", 1, "  aa bb"), ("k", 2, "bb"), ("k", 3, "not there"), ("k", 4, "cc")], "k string, n int, text string")
    full = spark.createDataFrame([("k", "aa bb bb cc")], "k string, full string")
    got = [r.start for r in archives.page_starts(pages, full, "k", "n", "text").orderBy("n").collect()]
    assert got[:3] == [0, 6, 8] and got[3] == 17
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").withColumnRenamed("vec_id", "point_id")
    few = {r.point_id: (r.route, round(r.score, 4)) for r in search.route(rows, rows, "label", -1, 0.45).collect()}
    monkeypatch.setattr(search, "MAX_ROUTES", 3)
    assert {r.point_id: (r.route, round(r.score, 4)) for r in search.route(rows, rows, "label", -1, 0.45).collect()} == few


def test_times_and_sizes(spark):
    one = spark.range(1)
    sizes = [0, 1, 1023, 1024, 1536, 5 * 1024**2, 3 * 1024**4]
    got = [one.select(X.readable_size(F.lit(n))).first()[0] for n in sizes]
    assert got == ["0 B", "1 B", "1023 B", "1.0 KB", "1.5 KB", "5.0 MB", "3.0 TB"]
    at = F.timestamp_seconds(F.lit(7200))
    assert tuple(one.select(X.age_hours(F.lit("no time"), at, 1)).first()[0]) == (None, True)
