"""Queries of single rules: crawling, titles of addresses, JSON repair, page text, statistics, rejects and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcorpus.functions import names as N
from loomcorpus.functions import semistructured as J
from loomcorpus.functions import text as X
from loomcorpus.functions.main_text import main_text
from loomcorpus.operators import analytics, library, state
from loomcorpus.plans.registry import query
from loomcorpus.sources.bindings import Tables

_DEFAULTS = " OR ".join(f"contains(lower(u), '{p}')" for p in X.NOT_CRAWLED)


@query("s11_main_text")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", main_text("html").alias("m")).select("page_id", "m.*")


@query("f22_crawl_filter", f"""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '/Shop/x' WHEN 1 THEN url || '/blog' ELSE url END AS u FROM pages)
  SELECT page_id, coalesce((contains(lower(u), 'example.org') OR contains(lower(u), '/en/')) AND NOT (contains(lower(u), 'casino') OR {_DEFAULTS}), FALSE) AS taken FROM p""")
def _(t: Tables) -> DataFrame:
    k = F.col("page_id") % 4
    url = F.when(k == 0, F.concat("url", F.lit("/Shop/x"))).when(k == 1, F.concat("url", F.lit("/blog"))).otherwise(F.col("url"))
    return t.pages.select("page_id", X.crawlable(url, ["Example.org", "/en/"], ["casino"]).alias("taken"))


@query("c11_url_titles", r"""WITH p AS (SELECT page_id, regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g') AS p, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host FROM pages),
  s AS (SELECT page_id, host, regexp_replace(regexp_replace(list_extract(string_split(p, '/'), -1), '[-_]', ' ', 'g'), '\.\w+$', '') AS s FROM p)
  SELECT page_id, CASE WHEN s = '' OR s IS NULL THEN host ELSE array_to_string(list_transform(regexp_extract_all(s, '[a-zA-Z]+|[^a-zA-Z]+'), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), '') END AS title FROM s""")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.title_from_url(F.col("url")).alias("title"))


@query("c50_repaired_lists", """WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders)
  SELECT o_custkey, count(*) AS n, sum(o_orderkey) AS keys FROM o WHERE NOT (o_custkey % 2 = 0 AND k = 2) GROUP BY o_custkey""", longs="keys")
def _(t: Tables) -> DataFrame:
    """One list of objects for each customer, of which the second object is broken for every other customer."""
    listed = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("ks"))
    item = lambda k, i: F.concat(F.lit('{"key": '), F.when((F.col("o_custkey") % 2 == 0) & (i == 1), "").otherwise(k.cast("string")), F.lit(', "text": "a } { b", "more": [{"x": 1}]}'))
    raw = F.concat(F.lit("["), F.array_join(F.transform("ks", item), ", "), F.lit("]"))
    rows = listed.select("o_custkey", F.from_json(J.repair(raw), "array<struct<key:bigint>>").alias("items"))
    total = F.aggregate("items", F.lit(0).cast("long"), lambda acc, x: acc + x["key"])
    # A list that is lost whole has no row in the checking SQL.
    return rows.where(F.size("items") > 0).select("o_custkey", F.size("items").cast("long").alias("n"), total.alias("keys"))


@query("s21_folder_statistics", """WITH f AS (SELECT CASE WHEN path LIKE 'http%' THEN 'web' ELSE source END AS folder, CASE WHEN doc_id % 6 = 0 THEN 'MP4' WHEN doc_id % 6 = 1 THEN 'mkv' WHEN doc_id % 6 = 2 THEN '' ELSE 'pdf' END AS x, size_bytes FROM cat)
  SELECT folder, count(*) AS files, sum(size_bytes) AS bytes, count_if(lower(x) IN ('mp4', 'webm', 'mkv')) AS of_kinds, count_if(x = 'pdf') AS pdf, count_if(x = '') AS plain FROM f GROUP BY folder""", longs="bytes of_kinds pdf plain")
def _(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 6
    name = F.concat(F.lit("a.b/doc"), F.when(k == 0, ".MP4").when(k == 1, ".mkv").when(k == 2, "").otherwise(".pdf"))
    rows = t.cat.select(F.when(state.is_web(), "web").otherwise(F.col("source")).alias("folder"), name.alias("filename"), "size_bytes")
    count = lambda x: F.coalesce(F.try_element_at("extensions", F.lit(x)), F.lit(0)).alias("pdf" if x else "plain")
    return analytics.folder_statistics(rows).select("folder", "files", "bytes", "of_kinds", count("pdf"), count(""))


@query("s35_partial_extractions", """SELECT hash, CASE WHEN pages_extracted > 0 AND book_title IS NOT NULL THEN book_title ELSE concat('Doc ', doc_id) END AS title, pages_extracted < 8 AS partial, 'extracted' AS status,
  CASE WHEN pages_extracted < 8 THEN concat('Partial: ', pages_extracted, '/8 pages') END AS message FROM doc""")
def _(t: Tables) -> DataFrame:
    first = F.when(F.col("pages_extracted") > 0, F.lit("A first page with more than twenty characters"))
    name = F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(".pdf"))
    made = N.partial_extraction(first, name, F.lit(8), F.col("pages_extracted"), F.col("book_title"))
    return t.doc.select("hash", made.alias("m")).select("hash", "m.*")


@query("k24_rejected_files", """SELECT path, CASE WHEN doc_id % 6 = 0 THEN 'encrypted' ELSE 'unreadable' END AS reason, concat('/review/', list_extract(string_split(path, '/'), -1)) AS review_path,
  CASE WHEN doc_id % 4 = 1 THEN concat(path, '.meta.json') END AS removed_meta FROM cat WHERE doc_id % 3 = 0 OR size_bytes < 200""")
def _(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    rows = t.cat.withColumn("meta", F.when(i % 4 == 1, F.concat("path", F.lit(".meta.json"))))
    readable = F.when(i % 3 == 0, F.lit(None).cast("boolean")).otherwise(F.col("size_bytes") >= 200)
    return library.rejects(rows, readable, F.when(i % 6 == 0, "encrypted"), "/review", meta="meta")[1]


@query("c86_trips", """SELECT l_orderkey, l_linenumber, round_even(CAST(l_extendedprice AS DOUBLE) / 64, 1) AS miles, round_even(CAST(l_quantity AS DOUBLE) * 15 / 60, 1) AS minutes FROM lineitem""")
def _(t: Tables) -> DataFrame:
    trip = X.trip(F.col("l_extendedprice").cast("double") / 64, F.col("l_quantity").cast("double") * 15)
    return t.lineitem.select("l_orderkey", "l_linenumber", trip.alias("t")).select("l_orderkey", "l_linenumber", "t.*")


_FLOW = "[" + ", ".join(f"'{s}'" for s in state.FLOW) + "]"


@query("u06_dashboard", f"""WITH s AS (SELECT status, count(*) AS n, list_position({_FLOW}, status) AS place FROM doc GROUP BY status), q AS (SELECT source, count(*) AS n FROM cat GROUP BY source),
  r AS (SELECT coalesce(book_title, 'Untitled') AS title, doc_id, hash FROM doc WHERE status = 'complete' ORDER BY doc_id DESC, hash LIMIT 10)
  SELECT (SELECT count(*) FROM doc) AS documents, (SELECT count(*) FROM doc WHERE status = 'complete') AS complete, (SELECT count(*) FROM doc WHERE status NOT IN ('complete', 'failed')) AS in_pipeline,
    (SELECT count(*) FROM cat WHERE hash NOT IN (SELECT hash FROM doc)) AS not_started, (SELECT CAST(coalesce(sum(vectors_inserted), 0) AS BIGINT) FROM doc) AS vectors, (SELECT count(*) FROM cat) AS catalogued,
    (SELECT string_agg(status || ':' || n, ',' ORDER BY place) FROM s) AS pipeline, (SELECT string_agg(source || ':' || n, ',' ORDER BY n DESC, source) FROM q) AS sources, (SELECT string_agg(title, '|' ORDER BY doc_id DESC, hash) FROM r) AS recent""")
def _(t: Tables) -> DataFrame:
    d = analytics.dashboard(t.doc, t.cat, state.FLOW, "doc_id")
    pairs = lambda c, name: F.array_join(F.transform(c, lambda x: F.concat(x[name], F.lit(":"), x["n"].cast("string"))), ",").alias(c)
    wanted = [F.col(f"totals.{c}").alias(c) for c in ("documents", "complete", "in_pipeline", "not_started", "vectors", "catalogued")]
    return d.select(*wanted, pairs("pipeline", "status"), pairs("sources", "source"), F.array_join("recent", "|").alias("recent"))
