"""Further queries: decisions, labels, scalar functions, library plans, feeds and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcorpus.functions import semistructured as J
from loomcorpus.functions import text as X
from loomcorpus.functions import vectors as V
from loomcorpus.operators import analytics, keywords, library, state
from loomcorpus.plans.registry import query
from loomcorpus.sources import readers
from loomcorpus.sources.bindings import Tables


def _values(t: Tables, rows: list[tuple], schema: str) -> DataFrame:
    return t.spark.createDataFrame(rows, schema)


@query("s07_hopper_pairs", """WITH f AS (SELECT concat('b', CAST(page_id % 40 AS VARCHAR(20))) AS base, concat('b', CAST(page_id % 40 AS VARCHAR(20)), CASE page_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.meta.json' WHEN 2 THEN '.txt' ELSE '.epub' END) AS filename, page_id % 4 = 1 AS meta FROM pages)
  SELECT c.base, c.filename, m.meta_file, m.meta_file IS NOT NULL AS has_meta FROM (SELECT base, min(filename) AS filename FROM f WHERE NOT meta GROUP BY base) c LEFT JOIN (SELECT base, min(filename) AS meta_file FROM f WHERE meta GROUP BY base) m ON c.base = m.base""")
def _(t: Tables) -> DataFrame:
    p = F.col("page_id")
    end = F.when(p % 4 == 0, ".pdf").when(p % 4 == 1, ".meta.json").when(p % 4 == 2, ".txt").otherwise(".epub")
    return readers.hopper_pairs(t.pages.select(F.concat(F.lit("b"), (p % 40).cast("string"), end).alias("filename")))


@query("s14_caption_choice", """SELECT user_id, arg_min(CASE WHEN event_type = 'view' THEN 'en' ELSE event_type END, CASE WHEN event_type = 'view' THEN event_id ELSE event_id + 1000000000 END) AS lang,
  min_by(props, CASE WHEN event_type = 'view' THEN event_id ELSE event_id + 1000000000 END) AS path FROM events GROUP BY user_id""")
def _(t: Tables) -> DataFrame:
    lang = F.when(F.col("event_type") == "view", "en").otherwise(F.col("event_type"))
    return readers.caption_choice(t.events.select("user_id", lang.alias("lang"), F.col("event_id").alias("pos"), F.col("props").alias("path")), "user_id")


@query("s16_counter_totals", """SELECT conv_id, count(*) AS n FROM conversations WHERE role IS NOT NULL GROUP BY conv_id""")
def _(t: Tables) -> DataFrame:
    line = t.conversations.groupBy("conv_id").agg(F.concat(F.lit("rows="), F.count("*").cast("string"), F.lit(";bad=x")).alias("c"))
    return line.select("conv_id", X.counter_map(F.col("c"))["rows"].alias("n"))


@query("s36_channel_statistics", "SELECT count(*) AS channels, count_if(n = 0) AS empty_channels, sum(n) AS videos FROM (SELECT c_custkey, count(o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey) x", longs="empty_channels videos")
def _(t: Tables) -> DataFrame:
    n = F.count_if(F.col("o_orderstatus") == "P").alias("n")
    per = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(n)
    return per.agg(F.count("*").alias("channels"), F.count_if(F.col("n") == 0).alias("empty_channels"), F.sum("n").alias("videos"))


@query("j05_transcript_status", "SELECT d.status, count(*) AS n FROM doc d JOIN cat c ON d.hash = c.hash WHERE c.source = 'src2' GROUP BY d.status")
def _(t: Tables) -> DataFrame:
    return t.doc.join(t.cat.where("source = 'src2'").select("hash"), "hash").groupBy("status").agg(F.count("*").alias("n"))


@query("j08_new_by_two_keys", """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def _(t: Tables) -> DataFrame:
    by_key = t.orders.join(t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    return by_key.join(t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").select("o_orderkey")


@query("j11_counts_with_default", "SELECT n_name, coalesce(n, 0) AS n FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON n_nationkey = s_nationkey")
def _(t: Tables) -> DataFrame:
    counts = t.supplier.where("s_acctbal > 5000").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    return t.nation.join(counts, F.col("n_nationkey") == F.col("s_nationkey"), "left").select("n_name", F.coalesce("n", F.lit(0)).alias("n"))


@query("j14_level4_duplicates", """WITH b AS (SELECT p_partkey, p_brand, p_type, lower(left(p_name, 6)) AS edition, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS year FROM part)
  SELECT a.p_partkey AS id, min(b.p_partkey) AS duplicate_of FROM b a JOIN b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.edition = b.edition AND a.year = b.year AND b.p_partkey < a.p_partkey GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    books = t.part.select("p_partkey", "p_brand", "p_type", F.lower(F.left("p_name", F.lit(6))).alias("edition"), F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("year"))
    keys = ["p_brand", "p_type", "edition", "year"]
    # The first bearer of the four keys is found by one aggregate; pairs of duplicates are never made.
    first = books.where("year IS NOT NULL").groupBy(*keys).agg(F.min("p_partkey").alias("duplicate_of"))
    return books.join(first, keys).where("p_partkey > duplicate_of").select(F.col("p_partkey").alias("id"), "duplicate_of")


@query("j16_keyword_domains", """WITH r(kw, v) AS (VALUES ('steel', 'Metalwork'), ('brass', 'Metalwork'), ('small', 'Handicraft'), ('red', 'Pigments'))
  SELECT p_partkey, string_agg(DISTINCT v, ',' ORDER BY v) AS domains FROM part JOIN r ON contains(lower(p_name || ' ' || p_type), kw) GROUP BY p_partkey""")
def _(t: Tables) -> DataFrame:
    rules = _values(t, [(1, "steel", "Metalwork"), (2, "brass", "Metalwork"), (3, "small", "Handicraft"), (4, "red", "Pigments")], "rule_no int, keyword string, v string")
    met = keywords.matches(t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("text")), rules, "text")
    met = met.select("p_partkey", F.explode("rules").alias("rule_no")).join(F.broadcast(rules.select("rule_no", "v")), "rule_no")  # four rules
    return met.groupBy("p_partkey").agg(F.array_join(F.array_sort(F.collect_set("v")), ",").alias("domains"))


@query("j21_operation_paths", """SELECT o.id, CASE WHEN d.doc_id IS NULL THEN 'unknown' WHEN d.path = concat('/library/', d.filename) OR o.operation = 'rename' THEN 'ok' ELSE 'path_mismatch' END AS result
  FROM ops o LEFT JOIN doc d ON o.doc = d.doc_id""")
def _(t: Tables) -> DataFrame:
    docs = t.doc.select("doc_id", "path", "filename")
    moved = t.ops.join(docs, F.col("doc") == F.col("doc_id"), "left")
    target = F.when(F.col("operation") == "rename", F.col("path")).otherwise(F.concat(F.lit("/library/"), "filename"))
    return moved.select("id", library.path_check(F.col("path"), target).alias("result"))


@query("a17_ingest_summary", """WITH b AS (SELECT md5(text) AS hash, length(text) AS n, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS k FROM documents)
  SELECT count_if(n < 200) AS failed, count_if(n >= 200 AND k > 1) AS duplicates, count_if(n >= 200 AND k = 1) AS fresh FROM b""", longs="failed duplicates fresh")
def _(t: Tables) -> DataFrame:
    per = t.documents.groupBy(F.md5("text").alias("hash")).agg(F.count("*").alias("n"), F.max(F.length("text")).alias("size"))
    ok = F.col("size") >= 200
    return per.agg(
        F.sum(F.when(~ok, F.col("n")).otherwise(0)).alias("failed"), F.sum(F.when(ok, F.col("n") - 1).otherwise(0)).alias("duplicates"), F.count_if(ok).alias("fresh")
    )


@query("w08_last_wins", "SELECT user_id, event_type, max_by(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return state.last_wins(t.events.select("user_id", "event_type", "value", "event_id").withColumn("o", F.col("event_id")), ["user_id", "event_type"], "o").drop("o")


@query("w09_round_robin", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INTEGER) AS key_no FROM documents")
def _(t: Tables) -> DataFrame:
    return analytics.round_robin(t.documents.select("doc_id"), ["doc_id"], 4, "key_no")


@query("t04_oldest_pending", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 1")
def _(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'P'").orderBy("o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_orderdate")


@query("t07_top_two_domains", """SELECT doc, domain, n, CAST(k AS INTEGER) AS rn FROM (SELECT doc, domain, count(*) AS n, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, domain) AS k FROM con GROUP BY 1, 2) x WHERE k <= 2""")
def _(t: Tables) -> DataFrame:
    return analytics.top_n(analytics.breakdown(t.con, ["doc", "domain"]), ["doc"], [F.desc("n"), F.col("domain")], 2)


@query("t08_page_numbers", """SELECT r.n_nationkey AS page, p.i AS shown FROM nation r, range(1, 26) p(i) WHERE p.i <= 3 OR p.i > 22 OR abs(p.i - r.n_nationkey) <= 2""")
def _(t: Tables) -> DataFrame:
    shown = F.filter(F.sequence(F.lit(1).cast("long"), F.lit(25).cast("long")), lambda i: (i <= 3) | (i > 22) | (F.abs(i - F.col("n_nationkey")) <= 2))
    return t.nation.select(F.col("n_nationkey").alias("page"), F.explode(shown).alias("shown"))


@query("f21_junk_urls", "SELECT page_id, contains(lower(url), '/tag/') OR contains(lower(url), '.html') OR contains(lower(url), 'sort=') AS junk FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.matches_any(F.col("url"), ["/TAG/", ".html", "sort="]).alias("junk"))


@query("f26_url_scheme", "SELECT page_id, regexp_matches(url, '^https?://') AS ok FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.col("url").rlike("^https?://").alias("ok"))


@query("f38_masked_keys", """SELECT c_custkey, CASE WHEN length(c_name) >= 12 THEN concat(left(c_name, 4), '...', right(c_name, 4)) WHEN length(c_name) >= 6 THEN concat(left(c_name, 2), '...', right(c_name, 2)) ELSE '***' END AS masked FROM customer""")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", X.masked(F.col("c_name")).alias("masked"))


@query("f39_upload_categories", """WITH o AS (SELECT source AS name, count(*) AS n FROM cat GROUP BY source), c(name) AS (VALUES ('src1'), ('maps'), ('radio')) SELECT coalesce(o.name, c.name) AS name, coalesce(n, 0) AS n FROM o FULL JOIN c ON o.name = c.name""")
def _(t: Tables) -> DataFrame:
    configured = _values(t, [("src1",), ("maps",), ("radio",)], "name string")
    seen = analytics.breakdown(t.cat.withColumnRenamed("source", "name"), ["name"])
    return seen.join(configured, "name", "full_outer").select("name", F.coalesce("n", F.lit(0)).alias("n"))


@query("c09_source_category", """WITH r AS (SELECT hash, string_split(substr(path, 10), '/') AS p FROM cat) SELECT hash, p[1] AS src, CASE WHEN len(p) > 2 THEN p[2] ELSE p[1] END AS category FROM r""")
def _(t: Tables) -> DataFrame:
    source, category = X.source_and_category(F.substr(F.col("path"), F.lit(10)))
    return t.cat.select("hash", source.alias("src"), category.alias("category"))


@query("c28_html_escape", """SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;')) AS escaped_md5 FROM pages""")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(X.escape_html(F.col("html"))).alias("escaped_md5"))


@query("c27_page_names", "SELECT conv_id, turn, printf('page_%04d.txt', turn + 1) AS name FROM conversations")
def _(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.format_string("page_%04d.txt", F.col("turn") + 1).alias("name"))


@query("c53_classification", """SELECT p_partkey, CASE WHEN p_type IN ('STANDARD COPPER', 'PROMO STEEL') THEN p_type WHEN p_brand = 'Brand#11' THEN 'PROMO STEEL' ELSE 'Other' END AS domain FROM part""")
def _(t: Tables) -> DataFrame:
    second = F.when(F.col("p_brand") == "Brand#11", "promo steel.").otherwise("x")
    return t.part.select("p_partkey", J.first_valid(F.array("p_type", second), ["STANDARD COPPER", "PROMO STEEL"], "Other").alias("domain"))


@query("c73_age_hours", "SELECT o_orderkey, datediff('hour', o_orderdate, TIMESTAMP '2000-01-01 00:00:00') AS hours, o_orderdate < TIMESTAMP '2000-01-01 00:00:00' - INTERVAL 2 HOURS AS old FROM orders")
def _(t: Tables) -> DataFrame:
    as_of = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return t.orders.select("o_orderkey", F.timestamp_diff("HOUR", F.col("o_orderdate"), as_of).alias("hours"), (F.col("o_orderdate") < as_of - F.expr("INTERVAL 2 HOURS")).alias("old"))


@query("c76_year_month", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("c81_intel_ids", "SELECT event_id, event_id + 1152921504606846976 AS vector_id FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", (F.col("event_id") + F.lit(1 << 60)).alias("vector_id"))


@query("c82_cosine_pairs", """SELECT a.vec_id, round(coalesce(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 0), 6) AS score
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def _(t: Tables) -> DataFrame:
    b = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return t.embeddings.join(b, "vec_id").select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 6).alias("score"))


@query("c84_readable_sizes", """SELECT doc_id, CASE WHEN n_chars = 0 THEN 0 ELSE CAST(floor(ln(n_chars) / ln(1024)) AS BIGINT) END AS unit, round(100.0 * n_chars / (SELECT sum(n_chars) FROM documents), 6) AS pct FROM documents""")
def _(t: Tables) -> DataFrame:
    total = t.documents.agg(F.sum("n_chars").alias("s"))
    n = F.col("n_chars")
    unit = F.when(n == 0, 0).otherwise(F.floor(F.ln(n) / F.ln(F.lit(1024))))
    return t.documents.crossJoin(F.broadcast(total)).select("doc_id", unit.cast("long").alias("unit"), F.round(100.0 * n / F.col("s"), 6).alias("pct"))


@query("c85_backoff", "SELECT conv_id, turn, least(CAST(5 AS DOUBLE) * pow(2, turn % 8), 120) AS seconds FROM conversations")
def _(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.least(5.0 * F.pow(F.lit(2.0), F.col("turn") % 8), F.lit(120.0)).alias("seconds"))


@query("c87_chart_scale", """SELECT event_type, round(min(value) - 0.05 * (max(value) - min(value)), 6) AS low, round(max(value) + 0.1 * (max(value) - min(value)), 6) AS high FROM events GROUP BY event_type""")
def _(t: Tables) -> DataFrame:
    low, high = F.min("value"), F.max("value")
    return t.events.groupBy("event_type").agg(F.round(low - 0.05 * (high - low), 6).alias("low"), F.round(high + 0.1 * (high - low), 6).alias("high"))


@query("l01_target_paths", """SELECT p_partkey, concat('/lib/', (SELECT string_agg(upper(left(w, 1)) || lower(substr(w, 2)), '-') FROM (SELECT unnest(string_split(p_type, ' ')) AS w) x), '/', CASE WHEN p_size % 3 = 0 THEN 'General' ELSE p_brand END, '/', left(p_name, 116), '.pdf') AS path FROM part""")
def _(t: Tables) -> DataFrame:
    sub = F.when(F.col("p_size") % 3 == 0, "General").otherwise(F.col("p_brand"))
    name = library.capped_name(F.col("p_name"), F.lit(""))
    return t.part.select("p_partkey", F.concat(F.lit("/lib/"), X.folder_name(F.col("p_type")), F.lit("/"), sub, F.lit("/"), name).alias("path"))


@query("l10_plan_slice", "SELECT hash, doc_id FROM doc ORDER BY doc_id LIMIT 100 OFFSET 50")
def _(t: Tables) -> DataFrame:
    return library.plan_slice(t.doc.select("hash", "doc_id"), "doc_id", 50, 100)


@query("l14_ingestion_decision", """SELECT conv_id, turn, CASE WHEN turn % 9 = 8 THEN 'none' WHEN length(trim(text)) < 50 THEN 'too_short' WHEN d.hash IS NOT NULL THEN 'duplicate' ELSE 'extracted' END AS decision
  FROM conversations LEFT JOIN (SELECT DISTINCT md5(text) AS hash FROM conversations WHERE role = 'user') d ON md5(text) = d.hash""")
def _(t: Tables) -> DataFrame:
    """Whole texts of turns; what a user said is known."""
    known = t.conversations.where("role = 'user'").select(F.md5("text").alias("hash"), F.lit(True).alias("known")).distinct()
    rows = t.conversations.withColumn("hash", F.md5("text")).join(known, "hash", "left")
    decision = library.ingestion_decision(F.col("turn") % 9 != 8, F.col("text"), F.coalesce("known", F.lit(False)))
    return rows.select("conv_id", "turn", decision.alias("decision"))


@query("l14_ingestion_decision_all", """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'none' WHEN length(trim(text)) < 50 THEN 'too_short' WHEN doc_id % 5 = 0 THEN 'duplicate' ELSE 'extracted' END AS decision FROM documents""")
def _(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    return t.documents.select("doc_id", library.ingestion_decision(i % 9 != 0, F.col("text"), i % 5 == 0).alias("decision"))


@query("x09_stale_recovery", """SELECT event_id, CASE WHEN event_type = 'view' AND (event_id % 10 = 0 OR ts < (SELECT max(ts) FROM events) - INTERVAL 48 HOURS) THEN 'extracted' WHEN event_type = 'view' THEN 'enriching' ELSE event_type END AS status FROM events""")
def _(t: Tables) -> DataFrame:
    status = F.when(F.col("event_type") == "view", "enriching").otherwise(F.col("event_type"))
    rows = t.events.select("event_id", status.alias("status"), F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("extracted_at"))
    latest = t.events.agg(F.max("ts").cast("timestamp").alias("as_of"))
    return state.stale(rows.crossJoin(F.broadcast(latest)), F.col("as_of"), 48).select("event_id", "status")
