"""Queries over stored structures: the vector index, keyed tables, and the keyword automaton."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcorpus.operators import addresses, keywords, paging, search, state, tables
from loomcorpus.operators.journal import Journal
from loomcorpus.operators.keyed import KeyedTable
from loomcorpus.operators.vector_index import VectorIndex
from loomcorpus.plans.analytics_queries import batch_sql
from loomcorpus.plans.registry import query
from loomcorpus.sources.bindings import Tables


#: Few points are dealt finely, so that a probe is a small share of them.
CELLS = 64


def _index(t: Tables) -> VectorIndex:
    """An index over all points: the even ones fitted and stored, the odd ones appended."""
    index = VectorIndex(t.spark, tables.folder(t.spark, "index")).build(t.pts.where("point_id % 2 = 0"), CELLS)
    return index.append(t.pts.where("point_id % 2 = 1"), 1)


def _asked(t: Tables) -> DataFrame:
    return t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query("v06_index_top_k", batch_sql("true"))
def _(t: Tables) -> DataFrame:
    with tables.scratch(t.spark):
        found = _index(t).search(_asked(t), 10, 8, exact=True)
        return tables.stored(found.select("query_id", "point_id", "place", F.round("score", 6).alias("score")), "found", scope=2)


@query("v06_index_recall")
def _(t: Tables) -> DataFrame:
    """Of every query how many of its ten nearest points the index finds at the number of probes that reaches nine in ten,
    and which share of the points it scores for that."""
    with tables.scratch(t.spark):
        index, asked = _index(t), tables.stored(_asked(t), "asked")
        probes, _ = index.probes_for(asked, 10, 0.9)
        want = search.top_k_batch(t.pts, asked, 10).select("query_id", "point_id", F.lit(1).alias("wanted"))
        found = index.search(asked, 10, probes).select("query_id", "point_id", "scored")
        each = want.join(found, ["query_id", "point_id"], "left").groupBy("query_id").agg(F.count("scored").alias("hits"), F.count("*").alias("wanted"), F.max("scored").alias("scored"))
        total = t.pts.agg(F.count("*").alias("n"))
        each = each.crossJoin(F.broadcast(total))  # one row
        return tables.stored(each.select("query_id", "hits", "wanted", (F.col("scored") / F.col("n")).alias("share_scored"), F.lit(probes).alias("probes")), "recall", scope=2)


@query("k01_catalogue_merge", """WITH b AS (SELECT md5(text) AS hash, doc_id, source, lang, n_chars, concat('/in/', CAST(doc_id AS VARCHAR(20))) AS path FROM documents),
  o AS (SELECT hash, min(doc_id) AS doc_id, min_by(source, doc_id) AS source, min_by(lang, doc_id) AS category, min_by(n_chars, doc_id) AS size_bytes, min_by(path, doc_id) AS path FROM b WHERE doc_id % 2 = 0 GROUP BY hash),
  n AS (SELECT hash, max(doc_id) AS doc_id, max_by(source, doc_id) AS source, max_by(lang, doc_id) AS category, max_by(n_chars, doc_id) AS size_bytes, max_by(path, doc_id) AS path FROM b WHERE doc_id % 3 = 0 GROUP BY hash)
  SELECT hash, coalesce(n.path, o.path) AS path, coalesce(n.source, o.source) AS source, coalesce(n.category, o.category) AS category, coalesce(o.size_bytes, n.size_bytes) AS size_bytes,
    coalesce(n.path <> o.path, FALSE) AS moved FROM o FULL JOIN n USING (hash)""")
def _(t: Tables) -> DataFrame:
    rows = t.documents.select(
        F.md5("text").alias("hash"), F.lit("f").alias("filename"), F.concat(F.lit("/in/"), F.col("doc_id").cast("string")).alias("path"), "source", F.col("lang").alias("category"),
        F.col("n_chars").alias("size_bytes"), F.lit(None).cast("timestamp_ntz").alias("path_updated_at"), "doc_id",
    )
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    with tables.scratch(t.spark):
        table = KeyedTable(t.spark, tables.folder(t.spark, "catalogue"), ["hash"], 16)
        table.merge(rows.where("doc_id % 2 = 0").withColumn("turn", -F.col("doc_id")), 0, "turn", rule=lambda old, new: new.drop("doc_id", "turn"))
        table.merge(rows.where("doc_id % 3 = 0"), 1, "doc_id", rule=lambda old, new: state.catalogue_upsert(old, new, stamp))
        out = table.read().select("hash", "path", "source", "category", "size_bytes", F.col("path_updated_at").isNotNull().alias("moved"))
        return tables.stored(out, "catalogue", scope=2)


@query("k08_snapshot_merge", """WITH e AS (SELECT date_trunc('minute', ts) AS minute, event_type, event_id, value FROM events)
  SELECT minute, event_type, max(event_id) AS event_id, max_by(value, event_id) AS value FROM e GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    """Metric snapshots in three batches, a later one replacing what has its minute and type."""
    rows = t.events.select(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"), "event_type", "event_id", "value")
    with tables.scratch(t.spark):
        table = KeyedTable(t.spark, tables.folder(t.spark, "snapshots"), ["minute", "event_type"], 16)
        cuts = rows.agg(*[F.percentile_approx("event_id", x) for x in (0.4, 0.7)]).first()
        low, high = cuts if cuts[0] is not None else (0, 0)
        for number, part in enumerate((rows.where(F.col("event_id") <= low), rows.where(F.col("event_id").between(low + 1, high)), rows.where(F.col("event_id") > high))):
            table.merge(part, number, "event_id")
        return tables.stored(table.read(), "snapshots", scope=2)


@query("k12_point_merge", """WITH n AS (SELECT p_size AS label, ps.vec_id AS point_id, p_partkey FROM part JOIN pts_ids ps ON ps.vec_id = p_partkey % (SELECT count(*) * 2 FROM embeddings)),
  m AS (SELECT point_id, max_by(label, p_partkey) AS label FROM n GROUP BY point_id)
  SELECT point_id, coalesce(m.label, e.label) AS label FROM (SELECT vec_id AS point_id, label FROM embeddings) e LEFT JOIN m USING (point_id)""".replace("pts_ids", "(SELECT vec_id FROM embeddings)"))
def _(t: Tables) -> DataFrame:
    """New labels for points, several of which come more than once in the batch, the last by part number winning."""
    with tables.scratch(t.spark):
        table = KeyedTable(t.spark, tables.folder(t.spark, "points"), ["point_id"], 16)
        points = t.pts.select("point_id", "label", F.lit(0).cast("long").alias("turn"))
        table.merge(points, 0, "turn")
        n = t.embeddings.count()
        batch = t.part.select((F.col("p_partkey") % (2 * n)).cast("long").alias("point_id"), F.col("p_size").cast("int").alias("label"), F.col("p_partkey").cast("long").alias("turn"))
        table.merge(batch.join(points.select("point_id"), "point_id", "left_semi"), 1, "turn")
        return tables.stored(table.read().select("point_id", "label"), "points", scope=2)


_KEYWORDS = r"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS keyword FROM benchmark"


@query("j17_document_rules", f"""WITH r AS ({_KEYWORDS}), d AS (SELECT doc_id, lower(text) AS t FROM documents),
  m AS (SELECT doc_id, min(keyword) AS first, count(*) AS n FROM d JOIN r ON contains(t, keyword) GROUP BY doc_id)
  SELECT doc_id, first AS value, coalesce(n, 0) AS n_rules FROM documents LEFT JOIN m USING (doc_id)""")
def _(t: Tables) -> DataFrame:
    """Every longer word of the benchmark as a rule, over whole documents."""
    words = t.benchmark.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), 0)).alias("keyword")).distinct()
    met = keywords.matches(t.documents.select("doc_id", "text"), words.withColumn("rule_no", F.col("keyword")), "text")
    return met.select("doc_id", F.array_min("rules").alias("value"), F.size("rules").cast("long").alias("n_rules"))


@query("j25_stored_lookup", """WITH q AS (SELECT c_custkey AS query_id, CAST(c_custkey % 1000 AS VARCHAR(20)) AS number, CASE c_custkey % 3 WHEN 0 THEN 'Main st' WHEN 1 THEN 'north st' ELSE 'OAK AVE' END AS street, CASE c_custkey % 4 WHEN 1 THEN 'or' WHEN 2 THEN 'WA' END AS state FROM customer)
  SELECT q.query_id, adr.id FROM q JOIN adr ON adr.number = q.number AND adr.street = upper(q.street) AND (q.state IS NULL OR adr.state = upper(q.state))""")
def _(t: Tables) -> DataFrame:
    """Every customer's number and street, some with a state, looked up in the stored address table."""
    k = F.col("c_custkey")
    street = F.when(k % 3 == 0, "Main st").when(k % 3 == 1, "north st").otherwise("OAK AVE")
    asked = t.customer.select(k.alias("query_id"), (k % 1000).cast("string").alias("number"), street.alias("street"), F.when(k % 4 == 1, "or").when(k % 4 == 2, "WA").alias("state"))
    with tables.scratch(t.spark):
        path = tables.folder(t.spark, "addresses")
        addresses.write(t.adr, path)
        return tables.stored(addresses.look_up_all(t.spark, path, asked).select("query_id", "id"), "found", scope=2)


@query("t02_stored_page", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50 OFFSET 1000")
def _(t: Tables) -> DataFrame:
    """The 21st page of 50 of the newest orders, from a table stored by ranges."""
    with tables.scratch(t.spark):
        path = tables.folder(t.spark, "pages")
        paging.write(t.orders.select("o_orderkey", "o_orderdate"), path, ["o_orderdate", "o_orderkey"], descending=True, rows_per_range=5000)
        return tables.stored(paging.Pages(t.spark, path, 50).page(21), "page", scope=2)


@query("l10_journalled_plan", "SELECT hash AS key, concat('moved ', filename) AS result FROM cat")
def _(t: Tables) -> DataFrame:
    """A plan over the whole catalogue, carried out in slices by two runs, the first of which ends early."""
    plan = t.cat.select("hash", "filename")
    with tables.scratch(t.spark):
        path = tables.folder(t.spark, "journal")
        size = max(1, -(-plan.count() // 3))
        Journal(t.spark, path).run(plan, "hash", _moved, size, slices=1)
        journal = Journal(t.spark, path)
        journal.run(plan, "hash", _moved, size)
        return tables.stored(journal.results().select("key", "result"), "results", scope=2)


def _moved(row: dict) -> str:
    return f"moved {row['filename']}"
