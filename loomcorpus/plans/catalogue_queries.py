"""Queries over the catalogue and documents: filters, joins, conditional counts, listings, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcorpus.operators import analytics, state
from loomcorpus.plans.registry import query
from loomcorpus.sources.bindings import Tables


@query("f01_by_status", "SELECT hash, doc_id, filename FROM doc WHERE status = 'queued' ORDER BY doc_id LIMIT 20")
def _(t: Tables) -> DataFrame:
    return state.listing(t.doc, [F.col("status") == "queued"], [F.col("doc_id")], 20).select("hash", "doc_id", "filename")


@query("f02_catalogued", "SELECT hash, filename, source, category FROM cat WHERE source = 'src1' AND category = 'en'")
def _(t: Tables) -> DataFrame:
    return state.listing(t.cat, [F.col("source") == "src1", F.col("category") == "en"]).select("hash", "filename", "source", "category")


@query("f03_documents_page", "SELECT d.hash, d.doc_id, d.status, c.source FROM doc d LEFT JOIN cat c ON d.hash = c.hash WHERE d.status = 'complete' ORDER BY d.doc_id DESC LIMIT 10 OFFSET 10")
def _(t: Tables) -> DataFrame:
    joined = t.doc.join(t.cat.select("hash", "source"), "hash", "left").select("hash", "doc_id", "status", "source")
    return state.listing(joined, [F.col("status") == "complete"], [F.desc("doc_id")], 10, 10)


@query("f04_failures", "SELECT hash, filename, retry_count FROM doc WHERE status = 'failed'")
def _(t: Tables) -> DataFrame:
    return t.doc.where("status = 'failed'").select("hash", "filename", "retry_count")


@query("f05_unorganized", "SELECT hash, doc_id FROM doc WHERE status = 'complete' AND vectors_inserted IS NOT NULL AND book_title IS NULL")
def _(t: Tables) -> DataFrame:
    return t.doc.where("status = 'complete' AND vectors_inserted IS NOT NULL AND book_title IS NULL").select("hash", "doc_id")


@query("f06_path_prefix", "SELECT hash, path FROM doc WHERE status = 'complete' AND path ILIKE '/library/src1%' ORDER BY doc_id LIMIT 50")
def _(t: Tables) -> DataFrame:
    return state.listing(t.doc, [F.col("status") == "complete", F.col("path").ilike("/library/src1%")], [F.col("doc_id")], 50).select("hash", "path")


@query("f08_web_documents", "SELECT hash, path FROM doc WHERE path ILIKE 'http%' ORDER BY doc_id DESC LIMIT 20")
def _(t: Tables) -> DataFrame:
    return state.listing(t.doc, [state.is_web()], [F.desc("doc_id")], 20).select("hash", "path")


@query("f30_document_type", "SELECT CASE WHEN source = 'transcripts' THEN 'transcript' WHEN source = 'wiki' THEN 'wiki' WHEN path ILIKE 'http%' THEN 'web' ELSE 'pdf' END AS type, count(*) AS n, sum(size_bytes) AS bytes FROM cat GROUP BY 1", longs="bytes")
def _(t: Tables) -> DataFrame:
    return t.cat.groupBy(state.document_type().alias("type")).agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"))


@query("a01_status_counts", "SELECT status, count(*) AS n FROM doc GROUP BY status")
def _(t: Tables) -> DataFrame:
    return analytics.breakdown(t.doc, ["status"])


@query("a02_source_breakdown", "SELECT source, count(*) AS n, sum(size_bytes) AS bytes FROM cat GROUP BY source ORDER BY n DESC, source", longs="bytes")
def _(t: Tables) -> DataFrame:
    return analytics.breakdown(t.cat, ["source"], bytes="size_bytes").orderBy(F.desc("n"), "source")


@query("a03_category_breakdown", "SELECT source, category, count(*) AS n FROM cat GROUP BY source, category")
def _(t: Tables) -> DataFrame:
    return analytics.breakdown(t.cat, ["source", "category"])


@query("a04_pipeline_totals", """SELECT count(*) AS total, count_if(status = 'complete') AS complete, count_if(status = 'failed') AS failed,
  count_if(status NOT IN ('complete', 'failed')) AS in_pipeline, sum(pages_extracted) AS pages, sum(concepts_extracted) AS concepts, sum(vectors_inserted) AS vectors FROM doc""", longs="complete failed in_pipeline pages concepts vectors")
def _(t: Tables) -> DataFrame:
    sums = [F.sum(c).alias(n) for n, c in (("pages", "pages_extracted"), ("concepts", "concepts_extracted"), ("vectors", "vectors_inserted"))]
    return t.doc.agg(*analytics.state_counts(t.doc), *sums)


_FLOW_SQL = "list_position([" + ", ".join(f"'{s}'" for s in state.FLOW) + "], status)"


@query("a05_status_in_flow_order", f"SELECT status, count(*) AS n, CAST({_FLOW_SQL} AS BIGINT) AS step FROM doc GROUP BY status ORDER BY step")
def _(t: Tables) -> DataFrame:
    step = F.array_position(F.array(*[F.lit(s) for s in state.FLOW]), F.col("status")).cast("long")
    return t.doc.groupBy("status").agg(F.count("*").alias("n")).withColumn("step", step).orderBy("step")


@query("a06_source_type_matrix", """SELECT c.source, CASE WHEN c.path ILIKE 'http%' THEN 'web' ELSE 'pdf' END AS type, count(DISTINCT c.hash) AS catalogued,
  count(DISTINCT CASE WHEN d.status = 'complete' THEN d.hash END) AS complete, count(DISTINCT CASE WHEN d.status NOT IN ('complete', 'failed') THEN d.hash END) AS in_pipeline,
  sum(CASE WHEN d.status = 'complete' THEN d.concepts_extracted ELSE 0 END) AS concepts
  FROM cat c LEFT JOIN doc d ON c.hash = d.hash GROUP BY 1, 2""", longs="concepts")
def _(t: Tables) -> DataFrame:
    d = t.doc.select("hash", "status", "concepts_extracted")
    # A hash is unique on both sides, so counting distinct hashes is counting rows.
    joined = t.cat.join(d, "hash", "left").withColumn("type", F.when(state.is_web(), "web").otherwise("pdf"))
    done = F.col("status") == "complete"
    return joined.groupBy("source", "type").agg(
        F.count("*").alias("catalogued"), F.count_if(done).alias("complete"), F.count_if(~F.col("status").isin(state.ENDED)).alias("in_pipeline"),
        F.sum(F.when(done, F.col("concepts_extracted")).otherwise(0)).alias("concepts"),
    )


@query("a07_global_counts", "SELECT (SELECT count(*) FROM cat) AS catalogued, (SELECT count(*) FROM doc) AS documents, (SELECT count(DISTINCT source) FROM cat) AS sources")
def _(t: Tables) -> DataFrame:
    a = t.cat.agg(F.count("*").alias("catalogued"), F.countDistinct("source").alias("sources"))
    return a.crossJoin(t.doc.agg(F.count("*").alias("documents"))).select("catalogued", "documents", "sources")


@query("a11_operation_counts", "SELECT operation, count(*) AS n FROM ops WHERE NOT is_reversed GROUP BY operation")
def _(t: Tables) -> DataFrame:
    return analytics.breakdown(t.ops.where("NOT is_reversed"), ["operation"])


@query("a14_library_sizes", "SELECT split_part(path, '/', 3) AS folder, count(*) AS n, sum(size_bytes) AS bytes FROM cat WHERE path LIKE '/library/%' GROUP BY 1", longs="bytes")
def _(t: Tables) -> DataFrame:
    rows = t.cat.where(F.col("path").startswith("/library/")).withColumn("folder", F.split_part(F.col("path"), F.lit("/"), F.lit(3)))
    return analytics.breakdown(rows, ["folder"], bytes="size_bytes")


@query("a22_distinct_categories", "SELECT DISTINCT category FROM cat ORDER BY category")
def _(t: Tables) -> DataFrame:
    return t.cat.select("category").distinct().orderBy("category")


@query("a23_footer_rollup", "SELECT source, category, count(*) AS n, sum(size_bytes) AS bytes FROM cat GROUP BY ROLLUP(source, category)", longs="bytes")
def _(t: Tables) -> DataFrame:
    return t.cat.rollup("source", "category").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"))


@query("a24_shares", """WITH s AS (SELECT source, count(*) AS n FROM cat GROUP BY source)
  SELECT source, n, round(100.0 * n / sum(n) OVER (), 6) AS pct_total, round(100.0 * n / max(n) OVER (), 6) AS pct_max FROM s""")
def _(t: Tables) -> DataFrame:
    out = analytics.shares(analytics.breakdown(t.cat, ["source"]), "n")
    return out.withColumns({c: F.round(c, 6) for c in ("pct_total", "pct_max")})


@query("j01_documents_with_source", "SELECT d.hash, d.status, c.source, c.category FROM doc d LEFT JOIN cat c ON d.hash = c.hash")
def _(t: Tables) -> DataFrame:
    return t.doc.join(t.cat.select("hash", "source", "category"), "hash", "left").select("hash", "status", "source", "category")


@query("j03_recent_complete", "SELECT d.hash, d.filename, c.source, d.doc_id FROM doc d JOIN cat c ON d.hash = c.hash WHERE d.status = 'complete' ORDER BY d.doc_id DESC LIMIT 10")
def _(t: Tables) -> DataFrame:
    return t.doc.where("status = 'complete'").join(t.cat.select("hash", "source"), "hash").orderBy(F.desc("doc_id")).limit(10).select("hash", "filename", "source", "doc_id")


@query("j04_source_pipeline", """SELECT c.source, count_if(d.status = 'complete') AS complete, count_if(d.status = 'failed') AS failed,
  count_if(d.status NOT IN ('complete', 'failed')) AS in_pipeline FROM cat c JOIN doc d ON c.hash = d.hash GROUP BY c.source""", longs="complete failed in_pipeline")
def _(t: Tables) -> DataFrame:
    joined = t.cat.select("hash", "source").join(t.doc.select("hash", "status"), "hash")
    return joined.groupBy("source").agg(*analytics.state_counts(joined)).drop("total")


@query("j06_not_started", "SELECT hash, filename FROM cat WHERE hash NOT IN (SELECT hash FROM doc)")
def _(t: Tables) -> DataFrame:
    return t.cat.join(t.doc, "hash", "left_anti").select("hash", "filename")


@query("j07_duplicate_probe", """WITH b AS (SELECT doc_id, md5(text) AS hash FROM documents WHERE doc_id % 3 = 0)
  SELECT b.doc_id, b.hash, CASE WHEN d.hash IS NULL THEN 'new' ELSE 'duplicate' END AS outcome FROM b LEFT JOIN doc d ON b.hash = d.hash""")
def _(t: Tables) -> DataFrame:
    batch = t.documents.where("doc_id % 3 = 0").select("doc_id", F.md5("text").alias("hash"))
    met = batch.join(t.doc.select("hash", F.lit(1).alias("seen")), "hash", "left")
    return met.select("doc_id", "hash", F.when(F.col("seen").isNull(), "new").otherwise("duplicate").alias("outcome"))


@query("j07_duplicate_probe_all", """WITH b AS (SELECT doc_id, md5(text) AS hash FROM documents)
  SELECT b.doc_id, b.hash, CASE WHEN d.hash IS NULL THEN 'new' ELSE 'duplicate' END AS outcome FROM b LEFT JOIN doc d ON b.hash = d.hash""")
def _(t: Tables) -> DataFrame:
    batch = t.documents.select("doc_id", F.md5("text").alias("hash"))
    met = batch.join(t.doc.select("hash", F.lit(1).alias("seen")), "hash", "left")
    return met.select("doc_id", "hash", F.when(F.col("seen").isNull(), "new").otherwise("duplicate").alias("outcome"))


@query("j10_reconcile", """WITH a AS (SELECT DISTINCT source AS name FROM documents WHERE doc_id % 2 = 0), b AS (SELECT DISTINCT source AS name FROM documents WHERE doc_id % 5 = 1)
  SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'new' WHEN a.name IS NULL THEN 'removed' ELSE 'tracked' END AS state FROM a FULL JOIN b ON a.name = b.name""")
def _(t: Tables) -> DataFrame:
    named = lambda n, r: t.documents.where(F.col("doc_id") % n == r).select(F.col("source").alias("name")).distinct()
    return analytics.reconcile(named(2, 0), named(5, 1), "name")


@query("j10_reconcile_all", """WITH a AS (SELECT DISTINCT hash AS name FROM cat), b AS (SELECT DISTINCT hash AS name FROM doc)
  SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'new' WHEN a.name IS NULL THEN 'removed' ELSE 'tracked' END AS state FROM a FULL JOIN b ON a.name = b.name""")
def _(t: Tables) -> DataFrame:
    named = lambda df: df.select(F.col("hash").alias("name")).distinct()
    return analytics.reconcile(named(t.cat), named(t.doc), "name")


@query("k01_catalogue_upsert", """WITH old AS (SELECT hash, path, filename, source, category, size_bytes FROM cat WHERE doc_id % 2 = 0),
  new AS (SELECT hash, CASE WHEN doc_id % 3 = 0 THEN concat(path, '.moved') ELSE path END AS path, filename, source, category, size_bytes FROM cat WHERE doc_id % 4 <> 1)
  SELECT coalesce(old.hash, new.hash) AS hash, coalesce(new.path, old.path) AS path, coalesce(new.filename, old.filename) AS filename, coalesce(new.source, old.source) AS source,
    coalesce(new.category, old.category) AS category, coalesce(old.size_bytes, new.size_bytes) AS size_bytes, old.path IS NOT NULL AND new.path IS NOT NULL AND old.path <> new.path AS moved
  FROM old FULL JOIN new ON old.hash = new.hash""")
def _(t: Tables) -> DataFrame:
    c = t.cat
    batch = c.where("doc_id % 4 <> 1").withColumn("path", F.when(F.col("doc_id") % 3 == 0, F.concat("path", F.lit(".moved"))).otherwise(F.col("path")))
    old = c.where("doc_id % 2 = 0").drop("doc_id")
    out = state.catalogue_upsert(old, batch, F.lit("2024-01-01").cast("timestamp_ntz"))
    return out.select("hash", "path", "filename", "source", "category", "size_bytes", F.col("path_updated_at").isNotNull().alias("moved"))


@query("k02_queue", """WITH w AS (SELECT hash FROM cat WHERE doc_id % 7 = 0 UNION SELECT md5(concat('x', CAST(n_nationkey AS VARCHAR(20)))) FROM nation)
  SELECT w.hash, c.hash IS NOT NULL AS queued, CASE WHEN c.hash IS NOT NULL THEN coalesce(d.status, 'queued') END AS status
  FROM w LEFT JOIN cat c ON w.hash = c.hash LEFT JOIN doc d ON w.hash = d.hash""")
def _(t: Tables) -> DataFrame:
    wanted = t.cat.where("doc_id % 7 = 0").select("hash").union(t.nation.select(F.md5(F.concat(F.lit("x"), F.col("n_nationkey").cast("string")))))
    return state.queue(t.cat, t.doc, wanted)


@query("k02_queue_all", """WITH w AS (SELECT hash FROM cat UNION SELECT md5(url) FROM pages)
  SELECT w.hash, c.hash IS NOT NULL AS queued, CASE WHEN c.hash IS NOT NULL THEN coalesce(d.status, 'queued') END AS status
  FROM w LEFT JOIN cat c ON w.hash = c.hash LEFT JOIN doc d ON w.hash = d.hash""")
def _(t: Tables) -> DataFrame:
    return state.queue(t.cat, t.doc, t.cat.select("hash").union(t.pages.select(F.md5("url"))))


@query("k03_transition", """SELECT hash, CASE status WHEN 'queued' THEN 'extracting' WHEN 'extracting' THEN 'extracted' WHEN 'extracted' THEN 'enriching' WHEN 'enriching' THEN 'enriched'
  WHEN 'enriched' THEN 'embedding' WHEN 'embedding' THEN 'complete' ELSE status END AS status FROM doc""")
def _(t: Tables) -> DataFrame:
    order = F.array(*[F.lit(s) for s in state.FLOW])
    step = F.array_position(order, F.col("status"))
    after = F.when(F.col("status").isin(state.ENDED), F.col("status")).otherwise(F.element_at(order, (step + 1).cast("int")))
    return state.transition(t.doc, after, F.current_timestamp()).select("hash", "status")


@query("k05_retry", "SELECT hash, CASE WHEN status = 'failed' THEN 'queued' ELSE status END AS status, CASE WHEN status = 'failed' THEN retry_count + 1 ELSE retry_count END AS retry_count FROM doc")
def _(t: Tables) -> DataFrame:
    return state.retry(t.doc).select("hash", "status", "retry_count")


@query("k08_last_wins_snapshot", """SELECT date_trunc('minute', ts) AS minute, metric_type, max_by(value, event_id) AS value FROM snap GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    rows = t.snap.select(F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("minute"), "metric_type", "value", "event_id")
    return state.last_wins(rows, ["minute", "metric_type"], "event_id").select("minute", "metric_type", "value")


@query("k09_insert_or_ignore", """WITH b AS (SELECT source, md5(text) AS hash, doc_id FROM documents), old AS (SELECT DISTINCT source, md5(text) AS hash FROM documents JOIN labels USING (doc_id))
  SELECT b.source, b.hash, min(b.doc_id) AS doc_id FROM b LEFT JOIN old ON b.source = old.source AND b.hash = old.hash WHERE old.hash IS NULL GROUP BY b.source, b.hash""")
def _(t: Tables) -> DataFrame:
    batch = t.documents.select("source", F.md5("text").alias("hash"), "doc_id")
    old = t.documents.join(t.labels.select("doc_id"), "doc_id").select("source", F.md5("text").alias("hash"))
    return state.first_wins(old, batch, ["source", "hash"], "doc_id").select("source", "hash", "doc_id")


@query("k10_append_ids", """SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY doc_id) AS id, doc_id, source, lang, n_chars FROM documents""")
def _(t: Tables) -> DataFrame:
    old = t.customer.select(F.col("c_custkey").alias("id"))
    return state.append_ids(old, t.documents.select("doc_id", "source", "lang", "n_chars", "text"), ["doc_id"]).drop("text")


@query("k11_delete_by_predicate", "SELECT hash, status FROM doc WHERE NOT (status IN ('failed', 'queued'))")
def _(t: Tables) -> DataFrame:
    return t.doc.where(~F.col("status").isin("failed", "queued")).select("hash", "status")


@query("k13_set_payload", """WITH u AS (SELECT label, concat('site-', CAST(label AS VARCHAR(20))) AS source_type FROM (SELECT DISTINCT label FROM embeddings WHERE label % 3 = 0) x)
  SELECT p.point_id, p.label, coalesce(u.source_type, p.source_type) AS source_type FROM pts p LEFT JOIN u ON p.label = u.label""")
def _(t: Tables) -> DataFrame:
    updates = t.embeddings.where("label % 3 = 0").select("label").distinct().withColumn("source_type", F.concat(F.lit("site-"), F.col("label").cast("string")))
    return state.set_payload(t.pts, updates, "label", ["source_type"]).select("point_id", "label", "source_type")


@query("k15_delete_points", "SELECT point_id, label FROM pts WHERE label NOT IN (SELECT label FROM embeddings WHERE vec_id % 97 = 0)")
def _(t: Tables) -> DataFrame:
    return state.delete_keys(t.pts, t.embeddings.where("vec_id % 97 = 0").select("label").distinct(), "label").select("point_id", "label")


@query("k22_cascade_delete", """WITH gone AS (SELECT hash FROM cat WHERE source = 'src3')
  SELECT 'catalogue' AS name, count(*) AS n FROM cat WHERE hash NOT IN (SELECT hash FROM gone) UNION ALL SELECT 'documents', count(*) FROM doc WHERE hash NOT IN (SELECT hash FROM gone)""")
def _(t: Tables) -> DataFrame:
    left = state.cascade_delete({"catalogue": t.cat, "documents": t.doc}, t.cat.where("source = 'src3'"), "hash")
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in left.items()]
    return counts[0].unionByName(counts[1])


@query("t02_page_bounds", """SELECT status, count(*) AS n, greatest(1, CAST(ceil(count(*) / 50.0) AS BIGINT)) AS total_pages, least(7, greatest(1, CAST(ceil(count(*) / 50.0) AS BIGINT))) AS page FROM doc GROUP BY status""")
def _(t: Tables) -> DataFrame:
    counts = analytics.breakdown(t.doc, ["status"])
    return counts.select("status", "n", *state.page_bounds(F.col("n"), F.lit(7), 50))


@query("t05_titles_per_status", """SELECT status, book_title, doc_id, rn FROM (SELECT status, book_title, doc_id, CAST(row_number() OVER (PARTITION BY status ORDER BY doc_id) AS INT) AS rn FROM doc
  WHERE book_title IS NOT NULL AND status NOT IN ('complete', 'failed')) x WHERE rn <= 5""")
def _(t: Tables) -> DataFrame:
    live = t.doc.where(F.col("book_title").isNotNull() & ~F.col("status").isin(state.ENDED))
    return analytics.top_n(live, ["status"], [F.col("doc_id")], 5).select("status", "book_title", "doc_id", "rn")


@query("u03_unknown_hashes", "SELECT md5(text) AS hash FROM documents EXCEPT SELECT hash FROM doc")
def _(t: Tables) -> DataFrame:
    return t.documents.select(F.md5("text").alias("hash")).distinct().join(t.doc, "hash", "left_anti").select("hash")


@query("u05_category_union", "SELECT category FROM cat UNION SELECT c_mktsegment FROM customer")
def _(t: Tables) -> DataFrame:
    return t.cat.select("category").distinct().union(t.customer.select("c_mktsegment").distinct()).distinct()
