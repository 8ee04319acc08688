"""The knowledge-base tables (catalogue, documents, concepts, points, ...) over the given base tables.

Each bound table exists twice: as a DataFrame here, and as SQL text that is put as a CTE before
the checking SQL of a query.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "cat": """SELECT hash, max(doc_id) AS doc_id, max_by(source, doc_id) AS source, max_by(lang, doc_id) AS category,
      max_by(n_chars, doc_id) AS size_bytes, concat('doc_', CAST(max(doc_id) AS VARCHAR(20)), '.pdf') AS filename,
      CASE WHEN max(doc_id) % 4 = 0 THEN concat('https://site.example/', CAST(max(doc_id) AS VARCHAR(20)))
           ELSE concat('/library/', max_by(source, doc_id), '/', max_by(lang, doc_id), '/doc_', CAST(max(doc_id) AS VARCHAR(20)), '.pdf') END AS path
      FROM (SELECT md5(text) AS hash, doc_id, source, lang, n_chars FROM documents) h GROUP BY hash""",
    "doc": """SELECT hash, doc_id, filename, path,
      CASE doc_id % 8 WHEN 0 THEN 'queued' WHEN 1 THEN 'extracting' WHEN 2 THEN 'extracted' WHEN 3 THEN 'enriching'
                      WHEN 4 THEN 'enriched' WHEN 5 THEN 'embedding' WHEN 6 THEN 'complete' ELSE 'failed' END AS status,
      CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat('Title ', CAST(doc_id % 40 AS VARCHAR(20))) END AS book_title,
      CAST(doc_id % 11 AS INT) AS pages_extracted, CAST(doc_id % 7 AS INT) AS concepts_extracted,
      CASE WHEN doc_id % 8 = 6 THEN CAST(doc_id % 7 AS INT) END AS vectors_inserted, CAST(doc_id % 4 AS INT) AS retry_count
      FROM cat WHERE doc_id % 5 <> 0""",
    "con": """SELECT l.l_orderkey AS doc, l.l_linenumber AS win, p.p_type AS domain, p.p_brand AS subdomain, p.p_name AS title
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "pts": """SELECT vec_id AS point_id, embedding, label,
      CASE label % 4 WHEN 0 THEN 'document' WHEN 1 THEN 'web' WHEN 2 THEN 'transcript' ELSE 'zim' END AS source_type FROM embeddings""",
    "ops": """SELECT o_orderkey AS id, o_custkey AS doc, o_orderdate AS performed_at, o_orderstatus = 'F' AS is_reversed,
      CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'move' ELSE 'rename' END AS operation FROM orders""",
    "adr": """SELECT c_custkey AS id, CAST(c_custkey % 1000 AS VARCHAR(20)) AS number,
      CASE c_custkey % 3 WHEN 0 THEN 'MAIN ST' WHEN 1 THEN 'NORTH ST' ELSE 'OAK AVE' END AS street, n_name AS city,
      CASE c_nationkey % 4 WHEN 0 THEN 'ID' WHEN 1 THEN 'OR' WHEN 2 THEN 'WA' ELSE 'AB' END AS state,
      lpad(CAST(c_custkey % 100000 AS VARCHAR(20)), 5, '0') AS zipcode, CASE WHEN c_nationkey % 4 = 3 THEN 'CA' ELSE 'US' END AS country
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "snap": "SELECT event_id, ts, event_type AS metric_type, value, props AS data FROM events",
}
_NEEDS = {"doc": ["cat"]}


def with_views(sql: str) -> str:
    """``sql`` with the bound views that it names as leading CTEs."""
    named = [v for v in VIEWS if re.search(rf"\b(?:FROM|JOIN|,)\s+{v}\b", sql)]
    wanted = [v for v in VIEWS if v in named or any(v in _NEEDS.get(x, []) for x in named)]
    if not wanted:
        return sql
    heads = ", ".join(f"{v} AS ({VIEWS[v]})" for v in wanted)
    rest = sql.strip()
    return f"WITH {heads}, {rest[5:]}" if rest.upper().startswith("WITH ") else f"WITH {heads} {rest}"


def modulo_case(key: str, n: int, values: list[str]) -> Column:
    """The value at ``key`` modulo ``n``; the last value for all larger remainders."""
    out = F.lit(values[-1])
    for i in reversed(range(len(values) - 1)):
        out = F.when(F.col(key) % n == i, values[i]).otherwise(out)
    return out


class Tables:
    """Lazily opened base and bound tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def cat(self) -> DataFrame:
        """Catalogue: content-addressed, the last row of a hash wins."""
        h = self.documents.select(F.md5("text").alias("hash"), "doc_id", "source", "lang", "n_chars")
        last = h.groupBy("hash").agg(F.max(F.struct("doc_id", "source", "lang", "n_chars")).alias("r"))
        name = F.concat(F.lit("doc_"), F.col("r.doc_id").cast("string"), F.lit(".pdf"))
        web = F.concat(F.lit("https://site.example/"), F.col("r.doc_id").cast("string"))
        file = F.concat(F.lit("/library/"), F.col("r.source"), F.lit("/"), F.col("r.lang"), F.lit("/"), name)
        return last.select(
            "hash", "r.doc_id", "r.source", F.col("r.lang").alias("category"), F.col("r.n_chars").alias("size_bytes"), name.alias("filename"),
            F.when(F.col("r.doc_id") % 4 == 0, web).otherwise(file).alias("path"),
        )

    @cached_property
    def doc(self) -> DataFrame:
        """Documents with their processing state."""
        states = ["queued", "extracting", "extracted", "enriching", "enriched", "embedding", "complete", "failed"]
        i = F.col("doc_id")
        return self.cat.where(i % 5 != 0).select(
            "hash", "doc_id", "filename", "path", modulo_case("doc_id", 8, states).alias("status"),
            F.when(i % 3 != 0, F.concat(F.lit("Title "), (i % 40).cast("string"))).alias("book_title"),
            (i % 11).cast("int").alias("pages_extracted"), (i % 7).cast("int").alias("concepts_extracted"),
            F.when(i % 8 == 6, (i % 7).cast("int")).alias("vectors_inserted"), (i % 4).cast("int").alias("retry_count"),
        )

    @cached_property
    def con(self) -> DataFrame:
        """Concepts of documents."""
        return self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("win"), F.col("p_type").alias("domain"), F.col("p_brand").alias("subdomain"),
            F.col("p_name").alias("title"),
        )

    @cached_property
    def pts(self) -> DataFrame:
        """Vector points with a payload."""
        kind = modulo_case("label", 4, ["document", "web", "transcript", "zim"])
        return self.embeddings.select(F.col("vec_id").alias("point_id"), "embedding", "label", kind.alias("source_type"))

    @cached_property
    def ops(self) -> DataFrame:
        """File operations."""
        kind = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "move").otherwise("rename")
        return self.orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("doc"), F.col("o_orderdate").alias("performed_at"),
            (F.col("o_orderstatus") == "F").alias("is_reversed"), kind.alias("operation"),
        )

    @cached_property
    def adr(self) -> DataFrame:
        """Addresses."""
        k = F.col("c_custkey")
        return self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            k.alias("id"), (k % 1000).cast("string").alias("number"), modulo_case("c_custkey", 3, ["MAIN ST", "NORTH ST", "OAK AVE"]).alias("street"),
            F.col("n_name").alias("city"), modulo_case("c_nationkey", 4, ["ID", "OR", "WA", "AB"]).alias("state"),
            F.lpad((k % 100000).cast("string"), 5, "0").alias("zipcode"), F.when(F.col("c_nationkey") % 4 == 3, "CA").otherwise("US").alias("country"),
        )

    @cached_property
    def snap(self) -> DataFrame:
        """Metric time series."""
        return self.events.select("event_id", "ts", F.col("event_type").alias("metric_type"), "value", F.col("props").alias("data"))
