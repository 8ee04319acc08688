"""Queries over names, concept remapping, points and payloads, archives, gates and library plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.functions import names as N
from loomcorpus.functions import text as X
from loomcorpus.operators import analytics, archives, concepts, library, points, state, tables
from loomcorpus.plans import analytics_queries
from loomcorpus.plans.registry import query
from loomcorpus.sources.bindings import Tables


def _case(x: str, pairs: dict[str, str | None]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN " + (f"'{v}'" if v else "NULL") for k, v in pairs.items()) + " END"


# --- file names -------------------------------------------------------------------------------

#: Names with site segments, tags, identifiers, manual numbers, dots and accents, made from parts.
_NAMES = """SELECT p_partkey, md5(p_name) AS hash, CASE p_partkey % 9 WHEN 0 THEN concat(p_name, ' -- ', p_brand, ' -- 2nd.pdf') WHEN 1 THEN concat(p_name, ' -- ed 1999.PDF') WHEN 2 THEN concat('FM_', CAST(p_size AS VARCHAR(9)), '_7_', p_name, '.pdf')
  WHEN 3 THEN concat(replace(p_type, ' ', '.'), '.a.b.c.txt') WHEN 4 THEN concat(p_name, ' (PDFDrive) {x1}.pdf') WHEN 5 THEN concat(p_name, '_', left(md5(p_name), 8), '.pdf') WHEN 6 THEN concat(p_name, '_0123abcd')
  WHEN 7 THEN concat('Ünï ', p_name, '? "', p_brand, '"  --.pdf') ELSE concat(p_type, ' ', p_type, ' ', p_type, ' ', p_type, ' ', p_type, ' ', p_type, ' ', p_name, '.pdf') END AS name FROM part"""


def _names(t: Tables) -> DataFrame:
    k, c = F.col("p_partkey") % 9, F.concat
    name, lit = F.col("p_name"), F.lit
    long = c(*[x for _ in range(6) for x in (F.col("p_type"), lit(" "))], name, lit(".pdf"))
    made = (
        F.when(k == 0, c(name, lit(" -- "), "p_brand", lit(" -- 2nd.pdf"))).when(k == 1, c(name, lit(" -- ed 1999.PDF"))).when(k == 2, c(lit("FM_"), F.col("p_size").cast("string"), lit("_7_"), name, lit(".pdf")))
        .when(k == 3, c(F.replace("p_type", lit(" "), lit(".")), lit(".a.b.c.txt"))).when(k == 4, c(name, lit(" (PDFDrive) {x1}.pdf"))).when(k == 5, c(name, lit("_"), F.left(F.md5(name), lit(8)), lit(".pdf")))
        .when(k == 6, c(name, lit("_0123abcd"))).when(k == 7, c(lit("Ünï "), name, lit('? "'), "p_brand", lit('"  --.pdf'))).otherwise(long)
    )
    return t.part.select("p_partkey", F.md5("p_name").alias("hash"), made.alias("name"))


_SANITIZED = rf"""n AS ({_NAMES}), s1 AS (SELECT p_partkey, hash, name, regexp_extract(name, '^(.*[^.].*)\.[^.]*$', 1) AS st FROM n),
  s2 AS (SELECT p_partkey, hash, name, CASE WHEN st = '' THEN name ELSE st END AS st, CASE WHEN st = '' THEN '.pdf' ELSE lower(substr(name, length(st) + 1)) END AS ext FROM s1),
  s3 AS (SELECT * REPLACE (CASE WHEN len(string_split(st, ' -- ')) > 2 OR (len(string_split(st, ' -- ')) = 2 AND regexp_matches(split_part(st, ' -- ', 2), '(19|20)\d\d')) THEN split_part(st, ' -- ', 1) ELSE st END AS st) FROM s2),
  s4 AS (SELECT * REPLACE (regexp_replace(regexp_replace(st, '\s*\(PDFDrive\)\s*', ' ', 'g'), '\s*\{{[A-Za-z0-9]+\}}\s*', ' ', 'g') AS st) FROM s3),
  s5 AS (SELECT * REPLACE (CASE WHEN regexp_matches(st, '_[0-9a-f]{{8}}$') AND right(st, 8) = left(hash, 8) THEN left(st, length(st) - 9) ELSE st END AS st) FROM s4),
  s6 AS (SELECT * REPLACE (regexp_replace(strip_accents(st), '\bFM[-_](\d+)[-_](\d+)', 'FM \1-\2', 'g') AS st) FROM s5),
  s7 AS (SELECT * REPLACE (CASE WHEN length(st) - length(replace(st, '.', '')) >= 4 THEN regexp_replace(st, '\.([A-Za-z])', ' \1', 'g') ELSE st END AS st) FROM s6),
  s8 AS (SELECT * REPLACE (regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(st, '_', ' '), '[<>:"|?*\\/]', '', 'g'), ' {{2,}}', ' ', 'g'), '-{{2,}}', '-', 'g'), '^[. -]+|[. -]+$', '', 'g') AS st) FROM s7),
  s9 AS (SELECT *, left(st, 120 - length(ext)) AS h FROM s8),
  sane AS (SELECT p_partkey, hash, name, concat(CASE WHEN length(st) <= 120 - length(ext) THEN st
    ELSE regexp_replace(CASE WHEN contains(h, ' ') AND length(h) - position(' ' IN reverse(h)) > 0.6 * (120 - length(ext)) THEN left(h, length(h) - position(' ' IN reverse(h))) ELSE h END, '[. ,-]+$', '') END, ext) AS clean FROM s9)"""


@query("c02_sanitized_names", f"WITH {_SANITIZED} SELECT p_partkey, clean, clean <> name AS changed FROM sane")
def _(t: Tables) -> DataFrame:
    clean = N.sanitized(F.col("name"), F.col("hash"))
    return _names(t).select("p_partkey", clean.alias("clean"), (clean != F.col("name")).alias("changed"))


@query("c03_names_to_change", f"WITH {_SANITIZED} SELECT clean <> name AS changed, count(*) AS n FROM sane GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return _names(t).groupBy(N.needs_sanitizing(F.col("name"), F.col("hash")).alias("changed")).agg(F.count("*").alias("n"))


_AS_PDF = "(SELECT * REPLACE (CASE WHEN lower(name) LIKE '%.pdf' THEN name ELSE name || '.pdf' END AS name) FROM n)"


@query("c04_library_names", f"""WITH {_SANITIZED.replace("FROM n)", f"FROM {_AS_PDF})", 1)} SELECT p_partkey, concat(regexp_replace(regexp_replace(replace(left(clean, length(clean) - 4), ' ', '_'), '_{{2,}}', '_', 'g'), '^_+|_+$', '', 'g'), '.pdf') AS clean FROM sane""")
def _(t: Tables) -> DataFrame:
    return _names(t).select("p_partkey", N.library_name(F.col("name"), F.col("hash")).alias("clean"))


@query("c01_titles", r"""SELECT p_partkey, list_aggregate(list_transform(string_split(concat(p_name, ' ', lower(p_type), ' X1 2nd'), ' '), lambda w: CASE WHEN w = lower(w) THEN upper(left(w, 1)) || substr(w, 2) ELSE w END), 'string_agg', ' ') || ' (1990)' AS title FROM part""")
def _(t: Tables) -> DataFrame:
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("-"), F.replace(F.lower("p_type"), F.lit(" "), F.lit("_")), F.lit("_X1 [1990] 2nd (PDFDrive).pdf"))
    return t.part.select("p_partkey", X.title_from_filename(name).alias("title"))


@query("c05_author_names", """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN split_part(c_name, '#', 1) WHEN 1 THEN 'lee' WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 'Öberg' ELSE NULL END AS last FROM customer""")
def _(t: Tables) -> DataFrame:
    k, name = F.col("c_custkey") % 6, F.split("c_name", "#")[0]
    author = (
        F.when(k == 0, F.concat(F.lit("Ann M. "), name, F.lit(" Jr."))).when(k == 1, "lee, ann").when(k == 2, F.concat(name, F.lit(" University"))).when(k == 3, name)
        .when(k == 4, " Bo  Öberg ").otherwise("Dept of the Army")
    )
    return t.customer.select("c_custkey", X.author_last_name(author).alias("last"))


@query("c17_name_metadata", """SELECT o_orderkey, concat('Knots ', CASE o_custkey % 3 WHEN 0 THEN concat(o_custkey % 9 + 1, 'th Edition') WHEN 1 THEN concat(o_custkey % 9 + 1, ' Ed') ELSE concat('Vol ', o_custkey % 9 + 1) END,
    CASE WHEN o_orderkey % 2 = 0 THEN ' By Ann Lee' ELSE ' By Ann' END, ' (', year(o_orderdate), ')') AS title, CASE WHEN o_orderkey % 2 = 0 THEN 'Ann Lee' END AS author,
    CASE o_custkey % 3 WHEN 0 THEN concat(o_custkey % 9 + 1, 'th Edition') WHEN 1 THEN concat(o_custkey % 9 + 1, ' ed') END AS edition, CAST(year(o_orderdate) AS INT) AS year FROM orders""")
def _(t: Tables) -> DataFrame:
    n, k = (F.col("o_custkey") % 9 + 1).cast("string"), F.col("o_custkey") % 3
    edition = F.when(k == 0, F.concat(n, F.lit("th Edition"))).when(k == 1, F.concat(n, F.lit(" ed"))).otherwise(F.concat(F.lit("Vol "), n))
    author = F.when(F.col("o_orderkey") % 2 == 0, " by Ann Lee").otherwise(" By Ann")
    name = F.concat(F.lit("Knots "), edition, author, F.lit(" ("), F.year("o_orderdate").cast("string"), F.lit(").pdf"))
    return t.orders.select("o_orderkey", N.name_metadata(name).alias("m")).select("o_orderkey", "m.title", "m.author", "m.edition", "m.year")


@query("c18_field_metadata", """SELECT o_orderkey, CASE WHEN length(o_orderpriority) > 5 THEN o_orderpriority END AS title, CASE WHEN o_custkey % 3 = 0 THEN '2nd edition' WHEN o_custkey % 3 = 1 THEN '4 ed.' END AS edition,
    CASE WHEN o_custkey % 4 IN (0, 3) THEN CAST(year(o_orderdate) AS INT) WHEN o_custkey % 4 = 1 THEN 2001 END AS year FROM orders""")
def _(t: Tables) -> DataFrame:
    k, year = F.col("o_custkey") % 4, F.year("o_orderdate").cast("string")
    created = F.when(k == 0, F.concat(F.lit("D:"), year, F.lit("0101"))).when(k == 3, F.concat(year, F.lit("-01-01"))).otherwise("D:1650")
    title = F.when(F.length("o_orderpriority") > 5, F.col("o_orderpriority")).otherwise(F.lit(" ab "))
    subject = F.when(F.col("o_custkey") % 3 == 0, "Knots, 2nd edition").when(F.col("o_custkey") % 3 == 1, "4 ed. of Knots")
    m = N.field_metadata(title, F.lit("A"), subject, created, F.when(k == 1, "20010203"))
    return t.orders.select("o_orderkey", m.alias("m")).select("o_orderkey", "m.title", "m.edition", "m.year")


@query("c20_coordinates", """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN round(c_acctbal / 100, 2) END AS latitude FROM customer""")
def _(t: Tables) -> DataFrame:
    spot = F.format_string("%.2f, -7.5", F.col("c_acctbal") / 100)
    found = X.coordinates(F.when(F.col("c_custkey") % 3 != 0, spot).otherwise("7 North St"))
    return t.customer.select("c_custkey", F.round(found["latitude"], 2).alias("latitude"))


@query("c21_place_labels", """SELECT n_nationkey, concat(n_name, CASE WHEN r_name <> n_name THEN concat(', ', r_name) ELSE '' END, ', X') AS label FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _(t: Tables) -> DataFrame:
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", X.place_label(F.col("n_name"), F.col("n_name"), F.lit(""), F.col("r_name"), F.lit("X")).alias("label"))


@query("c29_shown_urls", "SELECT page_id, CASE WHEN length(url) > 40 THEN left(url, 40) || '…' ELSE url END AS shown FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.shown_url(F.col("url")).alias("shown"))


@query("c31_plain_identifiers", "SELECT DISTINCT p_brand, regexp_full_match(p_brand, '[A-Za-z_]+') OR regexp_full_match(p_brand, '[a-z0-9-]+') AS ok FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_brand", X.plain_identifier(F.col("p_brand")).alias("ok")).distinct()


@query("c84_size_labels", """WITH d AS (SELECT doc_id, n_chars * CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 997 WHEN 2 THEN 1000003 WHEN 3 THEN 1000000007 ELSE 0 END AS n FROM documents)
  SELECT doc_id, CASE WHEN n < 1024 THEN concat(n, ' B') WHEN n < 1048576 THEN concat(printf('%.1f', round(n / 1024.0, 1)), ' KB') WHEN n < 1073741824 THEN concat(printf('%.1f', round(n / 1048576.0, 1)), ' MB')
    WHEN n < 1099511627776 THEN concat(printf('%.1f', round(n / 1073741824.0, 1)), ' GB') ELSE concat(printf('%.1f', round(n / 1099511627776.0, 1)), ' TB') END AS label FROM d""")
def _(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 5
    n = F.col("n_chars") * F.when(k == 0, 1).when(k == 1, 997).when(k == 2, 1000003).when(k == 3, 1000000007).otherwise(0)
    return t.documents.select("doc_id", X.readable_size(n).alias("label"))


@query("c74_cookie_age", """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN round(epoch((SELECT max(ts) FROM events) - ts) / 3600, 4) END AS hours, event_id % 7 = 0 OR ts < (SELECT max(ts) FROM events) - INTERVAL 14 DAYS AS stale FROM events""")
def _(t: Tables) -> DataFrame:
    latest = t.events.agg(F.max("ts").alias("as_of"))
    at = F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("string")).otherwise("no time")
    age = X.age_hours(at, F.col("as_of"), 14 * 24)
    return t.events.crossJoin(F.broadcast(latest)).select("event_id", age.alias("a")).select("event_id", F.round("a.hours", 4).alias("hours"), "a.stale")


# --- concepts ---------------------------------------------------------------------------------

_CANONICAL = ["ECONOMY BRASS", "LARGE BRASS", "MEDIUM COPPER", "PROMO STEEL", "SMALL TIN", "STANDARD COPPER"]
_VARIANTS = {"ECONOMY TIN": "SMALL TIN", "LARGE COPPER": "MEDIUM COPPER", "PROMO BRASS": None}
_KEYWORDS = {"#1": "PROMO STEEL", "#23": "LARGE BRASS"}
_REMAP = f"""r AS (SELECT doc, win, CASE win % 4 WHEN 0 THEN ['Reference'] WHEN 1 THEN ['Reference', domain] ELSE [domain] END AS old, subdomain FROM con),
  m AS (SELECT *, list_contains(old, 'Reference') AS held, list_sort(list_distinct(list_filter(list_transform(old, lambda d: CASE WHEN d IN ({", ".join(f"'{c}'" for c in _CANONICAL)}) THEN d ELSE {_case("d", _VARIANTS)} END), lambda d: d IS NOT NULL))) AS new,
    list_sort(list_distinct(list_filter([CASE WHEN contains(lower(subdomain), '#1') THEN 'PROMO STEEL' END, CASE WHEN contains(lower(subdomain), '#23') THEN 'LARGE BRASS' END], lambda d: d IS NOT NULL))) AS found FROM r),
  remapped AS (SELECT *, CASE WHEN NOT held AND new = old THEN 'no_change' WHEN NOT held THEN 'variant_remapped' WHEN len(new) > 0 THEN 'reference_stripped' WHEN len(found) > 0 THEN 'subdomain_reclassified' ELSE 'needs_enrichment' END AS stat FROM m)"""


def _remapped(t: Tables) -> DataFrame:
    old = F.when(F.col("win") % 4 == 0, F.array(F.lit(concepts.PLACEHOLDER))).when(F.col("win") % 4 == 1, F.array(F.lit(concepts.PLACEHOLDER), "domain")).otherwise(F.array("domain"))
    return concepts.remap(t.con.withColumn("domain", old), _CANONICAL, _VARIANTS, _KEYWORDS)


@query("c56_remapped_domains", f"WITH {_REMAP} SELECT doc, win, stat, array_to_string(CASE stat WHEN 'variant_remapped' THEN new WHEN 'reference_stripped' THEN new WHEN 'subdomain_reclassified' THEN found ELSE old END, ',') AS domains FROM remapped")
def _(t: Tables) -> DataFrame:
    return _remapped(t).select("doc", "win", "stat", F.array_join("domain", ",").alias("domains"))


@query("a20_remap_statistics", f"WITH {_REMAP} SELECT stat, count(*) AS n FROM remapped GROUP BY stat")
def _(t: Tables) -> DataFrame:
    return _remapped(t).groupBy("stat").agg(F.count("*").alias("n"))


@query("u02_changed_sets", f"WITH {_REMAP} SELECT doc, win, stat FROM remapped WHERE list_sort(old) <> list_sort(CASE stat WHEN 'variant_remapped' THEN new WHEN 'reference_stripped' THEN new WHEN 'subdomain_reclassified' THEN found ELSE old END)")
def _(t: Tables) -> DataFrame:
    old = F.when(F.col("win") % 4 == 0, F.array(F.lit(concepts.PLACEHOLDER))).when(F.col("win") % 4 == 1, F.array(F.lit(concepts.PLACEHOLDER), "before")).otherwise(F.array("before"))
    rows = t.con.withColumn("before", F.col("domain")).withColumn("domain", old).withColumn("was", F.col("domain"))
    changed = concepts.remap(rows, _CANONICAL, _VARIANTS, _KEYWORDS).where(analytics.sets_differ(F.col("was"), F.col("domain")))
    return changed.select("doc", "win", "stat")


@query("c57_outlier_domains", f"""SELECT doc, win, array_to_string(CASE WHEN d IS NULL THEN ['Foundational'] ELSE [d] END, ',') AS domains FROM (SELECT doc, win, CASE WHEN domain IN ({", ".join(f"'{c}'" for c in _CANONICAL)}) THEN domain WHEN domain = 'ECONOMY TIN' THEN 'SMALL TIN' END AS d FROM con) x""")
def _(t: Tables) -> DataFrame:
    new = concepts.remap_outliers(F.array("domain"), _CANONICAL, {"ECONOMY TIN": "SMALL TIN"}, "Foundational")
    return t.con.select("doc", "win", F.array_join(new, ",").alias("domains"))


@query("c55_knowledge_heuristic", """WITH x AS (SELECT doc_id, lower(concat_ws(' ', source, lang, left(text, 200))) AS t FROM documents)
  SELECT doc_id, CASE WHEN regexp_matches(t, 'decision|coordinate|execute|deploy|mission|triage|under fire|in the field|real-world|scenario|assessment|plan') THEN 'operational'
    WHEN regexp_matches(t, 'how to|step-by-step|procedure|instructions|method|technique|build|make|construct|install|assemble|recipe|prepare') THEN 'procedural' ELSE 'foundational' END AS knowledge_type,
    CASE WHEN regexp_matches(t, 'introduction|what is|basic|beginner|overview|definition|simple|fundamentals') THEN 'basic' WHEN regexp_matches(t, 'advanced|expert|complex|critical|high-stakes|surgery|trauma|tactical|classified') THEN 'advanced' ELSE 'intermediate' END AS complexity FROM x""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", concepts.knowledge_labels(F.col("source"), F.array("lang"), F.col("text")).alias("k")).select("doc_id", "k.*")


@query("j19_reclassified_concepts", """WITH l AS (SELECT doc, title, min(upper(domain)) AS new FROM con WHERE win = 1 GROUP BY 1, 2)
  SELECT c.doc, c.win, c.title, CASE WHEN c.win % 3 = 0 AND l.new IS NOT NULL THEN l.new WHEN c.win % 3 = 0 THEN 'Reference' ELSE c.domain END AS domain FROM con c LEFT JOIN l ON c.doc = l.doc AND c.title = l.title""")
def _(t: Tables) -> DataFrame:
    rows = t.con.withColumn("domain", F.when(F.col("win") % 3 == 0, concepts.PLACEHOLDER).otherwise(F.col("domain")))
    labels = t.con.where("win = 1").groupBy("doc", "title").agg(F.min(F.upper("domain")).alias("domain"))
    return concepts.reclassify(rows, rows, labels, ["domain"], concepts.PLACEHOLDER, ["doc", "title"])[0].select("doc", "win", "title", "domain")


@query("a16_enrichment_outcome", """WITH w AS (SELECT l_orderkey AS doc, l_linenumber AS win, CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_quantity < 25 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS n FROM lineitem),
  g AS (SELECT doc, coalesce(sum(n), 0) AS concepts, count(*) AS windows, count_if(n IS NULL) AS failed, array_to_string(list_slice(list(win ORDER BY win) FILTER (WHERE n IS NULL), 1, 10), ', ') AS listed FROM w GROUP BY doc)
  SELECT doc, concepts, windows, failed, CASE WHEN concepts > 0 OR failed = 0 THEN 'enriched' ELSE 'failed' END AS status, CASE WHEN concepts = 0 AND failed > 0 THEN concat('all ', CAST(windows AS VARCHAR(9)), ' windows failed') WHEN concepts = 0 AND windows >= 3 THEN 'no concepts'
    WHEN failed > 0 THEN concat(CAST(failed AS VARCHAR(9)), ' of ', CAST(windows AS VARCHAR(9)), ' windows failed: ', listed) END AS message FROM g""", longs="concepts failed")
def _(t: Tables) -> DataFrame:
    n = F.when(F.col("l_returnflag") != "R", F.when(F.col("l_quantity") < 25, 0).otherwise(F.col("l_quantity").cast("long")))
    rows = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("win"), n.cast("long").alias("n"))
    sizes = rows.groupBy("doc").agg(F.count("*").alias("pages"))
    return concepts.outcome(rows.join(sizes, "doc"), "doc", "win", "n", "pages")


@query("u04_document_concepts", "SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY win, p) - 1 AS BIGINT) AS idx, concept FROM (SELECT doc, win, p, CASE p WHEN 0 THEN a ELSE b END AS concept FROM (SELECT doc, win, min(domain) AS a, min(subdomain) AS b FROM con GROUP BY doc, win) c, range(2) r(p)) x")
def _(t: Tables) -> DataFrame:
    windows = t.con.groupBy("doc", "win").agg(F.array(F.min("domain"), F.min("subdomain")).alias("concepts"))
    return archives.document_concepts(windows, "doc", "win", "concepts")


# --- points -----------------------------------------------------------------------------------

_BASE = "https://library.example/"


@query("k12_built_points", """WITH c AS (SELECT hash, CAST(doc_id % 7 AS INT) AS page, doc_id FROM cat)
  SELECT CAST(('0x' || left(md5(concat_ws(':', c.hash, c.page, 0)), 15)) AS BIGINT) AS id, c.hash, k.source, CASE WHEN d.path LIKE 'http%' THEN 'web' WHEN d.doc_id % 3 = 1 THEN 'zim' ELSE 'document' END AS source_type,
    CASE WHEN d.path NOT LIKE 'http%' AND d.doc_id % 3 = 1 THEN concat('https://archive.example/content/wiki/A/x%20y(', CAST(d.doc_id AS VARCHAR(20)), ')') WHEN d.path LIKE 'http%' THEN d.path ELSE concat('https://library.example/', substr(d.path, 2)) END AS download_url, coalesce(d.book_title, '') AS book_title
  FROM c JOIN doc d ON c.hash = d.hash JOIN cat k ON k.hash = c.hash""")
def _(t: Tables) -> DataFrame:
    """A concept of each document, with the text's hash as its content."""
    i = F.col("doc_id")
    rows = t.cat.select(F.col("hash").alias("doc_hash"), F.lit(0).alias("idx"), (i % 7).cast("int").alias("start_page"), F.col("hash").alias("content"), F.lit("t").alias("title"))
    in_archive = (i % 3 == 1) & ~F.col("path").rlike("^http")
    docs = t.doc.select(
        "hash", "filename", "path", "book_title", F.lit(None).cast("string").alias("book_author"), F.when(in_archive, "zim").alias("stated_type"),
        F.when(in_archive, F.concat(F.lit("A/x y("), i.cast("string"), F.lit(")"))).alias("article"), F.lit("wiki.zim").alias("archive_file"),
    )
    made = points.build(rows, docs, t.cat, _BASE, "https://archive.example")
    return made.select("id", F.col("payload.doc_hash").alias("hash"), *[f"payload.{c}" for c in ("source", "source_type", "download_url", "book_title")])


@query("k12_point_upsert", """WITH b AS (SELECT point_id, label + 100 AS label, 'new' AS source_type FROM pts WHERE label < 4 UNION ALL SELECT point_id + 1000000, label, 'new' FROM pts WHERE label = 9)
  SELECT point_id, label, source_type FROM b UNION ALL SELECT point_id, label, source_type FROM pts WHERE point_id NOT IN (SELECT point_id FROM b)""")
def _(t: Tables) -> DataFrame:
    rows = t.pts.select("point_id", "label", "source_type")
    again = rows.where("label < 4").withColumn("label", F.col("label") + 100)
    fresh = rows.where("label = 9").withColumn("point_id", F.col("point_id") + 1_000_000)
    return points.upsert(rows, again.unionByName(fresh).withColumn("source_type", F.lit("new")), "point_id")


@query("k14_payload_keys", "SELECT point_id, label FROM pts")
def _(t: Tables) -> DataFrame:
    rows = t.pts.select("point_id", F.struct("label", "source_type", F.lit(1).alias("skill_level")).alias("payload"))
    return points.delete_payload(rows, ["skill_level", "source_type", "unknown"]).select("point_id", "payload.*")


@query("v03_points", "SELECT point_id, len(embedding) AS dim, CASE WHEN label < 5 THEN label + 1 END AS first_index, CASE WHEN label < 5 THEN round(embedding[1], 6) END AS first_value FROM pts")
def _(t: Tables) -> DataFrame:
    rows = t.pts.select("point_id", "embedding", F.when(F.col("label") < 5, F.array(F.col("label") + 1)).alias("i"), F.slice("embedding", 1, 1).alias("v"))
    made = points.hybrid(rows, "embedding", "i", "v").select("point_id", "vector.*")
    return made.select("point_id", F.size("dense").cast("long").alias("dim"), F.get("sparse.indices", F.lit(0)).alias("first_index"), F.round(F.get("sparse.values", F.lit(0)), 6).alias("first_value"))


@query("f11_points_with_any", "SELECT point_id, source_type FROM pts WHERE source_type IN ('web', 'zim', 'none')")
def _(t: Tables) -> DataFrame:
    return points.with_any(t.pts, "source_type", ["web", "zim", "none"]).select("point_id", "source_type")


@query("f12_filtered_counts", "SELECT v.value, count(p.point_id) AS n FROM (VALUES ('web'), ('zim'), ('none')) v(value) LEFT JOIN pts p ON p.source_type = v.value GROUP BY v.value")
def _(t: Tables) -> DataFrame:
    return points.counts_of(t.pts, "source_type", ["web", "zim", "none"])


@query("f29_junk_purge", """SELECT hash, CASE WHEN path LIKE 'http%' AND doc_id % 3 = 0 THEN 'skipped' ELSE status END AS status FROM doc""")
def _(t: Tables) -> DataFrame:
    rows = t.doc.select(F.col("hash").alias("doc_hash"), "path", F.concat(F.lit("page"), (F.col("doc_id") % 3).cast("string"), F.lit(".html")).alias("filename"))
    junk = F.col("path").rlike("^http") & X.matches_any(F.col("filename"), ["PAGE0"])
    return points.purge(rows, t.doc, junk)[1].select("hash", "status")


@query("f35_shaped_results", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Untitled' ELSE concat('Title ', CAST(doc_id % 40 AS VARCHAR(20))) END AS title, CASE WHEN doc_id % 2 = 0 THEN 's' ELSE left(hash, 200) END AS summary,
    concat(CASE WHEN doc_id % 3 = 0 THEN concat('Doc ', CAST(doc_id AS VARCHAR(20))) ELSE concat('Title ', CAST(doc_id % 40 AS VARCHAR(20))) END, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN ', pp. 3' ELSE ', p. 7' END) AS citation,
    CASE WHEN doc_id % 5 = 1 THEN '' ELSE status END AS domains FROM doc""")
def _(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    rows = t.doc.select(
        (i / 1.0).alias("score"), F.col("book_title").alias("title"), F.when(i % 2 == 0, "s").alias("summary"), F.col("hash").alias("content"), "book_title", "filename",
        F.when(i % 4 == 1, "pp. 3").when(i % 4 > 1, "7").alias("page_ref"), F.when(i % 5 != 1, F.col("status")).alias("domain"),
    )
    shown = points.shaped(rows)
    return shown.select(F.col("score").cast("long").alias("doc_id"), "title", "summary", "citation", F.array_join("domains", ",").alias("domains"))


@query("f36_citations", """SELECT doc_id, concat(CASE WHEN doc_id % 3 = 0 THEN concat('Doc ', CAST(doc_id AS VARCHAR(20))) ELSE book_title END, CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN ', pp. 3' ELSE concat(', p. ', CAST(pages_extracted AS VARCHAR(9))) END) AS citation FROM doc""")
def _(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 4
    page = F.when(k == 1, "pp. 3").when(k > 1, F.col("pages_extracted").cast("string"))
    return t.doc.select("doc_id", points.citation(F.col("book_title"), F.col("filename"), page).alias("citation"))


@query("f37_index_type", "SELECT l_returnflag, count(*) AS n, CASE WHEN count(*) >= 20000 THEN 'HNSW' ELSE 'brute-force' END AS index_type FROM lineitem GROUP BY l_returnflag")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"), points.index_type(F.count("*")).alias("index_type"))


# --- archives and gates -----------------------------------------------------------------------


@query("s17_archive_articles", """WITH e AS (SELECT page_id, concat('A/', CAST(page_id AS VARCHAR(9)), CASE page_id % 5 WHEN 0 THEN '/de' WHEN 1 THEN '/en' WHEN 2 THEN '/xyz' ELSE '' END) AS path FROM pages)
  SELECT path, CASE WHEN page_id % 11 = 0 OR page_id % 7 = 0 OR page_id % 13 = 0 THEN 'ignored' WHEN page_id % 5 = 0 THEN 'foreign' END AS early FROM e""")
def _(t: Tables) -> DataFrame:
    """Every entry, with why it is ruled out before its text is read; the rest of the chain is in ``s17_archive_actions``."""
    return archives.ruled_out(*_landed(t)).select("path", "early")


def _landed(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Entries, and the paths seen before."""
    i = F.col("page_id")
    path = F.concat(F.lit("A/"), i.cast("string"), F.when(i % 5 == 0, "/de").when(i % 5 == 1, "/en").when(i % 5 == 2, "/xyz").otherwise(""))
    rows = t.pages.select(path.alias("path"), F.lit("t").alias("title"), F.when(i % 7 == 0, "image/png").otherwise("text/html").alias("mimetype"), (i % 11 == 0).alias("redirect"), "html", "page_id")
    return rows.drop("page_id"), rows.where("page_id % 13 = 0").select("path")


@query("s17_archive_actions", f"""WITH x AS ({analytics_queries.page_text_sql()}), e AS (SELECT page_id, concat('A/', CAST(page_id AS VARCHAR(9)), CASE page_id % 5 WHEN 0 THEN '/de' WHEN 1 THEN '/en' WHEN 2 THEN '/xyz' ELSE '' END) AS path, CASE WHEN length(content) >= 200 THEN md5(content) END AS hash FROM x),
  l AS (SELECT * FROM e WHERE page_id % 11 <> 0 AND page_id % 7 <> 0 AND page_id % 13 <> 0), f AS (SELECT hash, min(path) AS path FROM l WHERE page_id % 5 <> 0 AND hash IS NOT NULL GROUP BY hash),
  a AS (SELECT CASE WHEN l.path IS NULL THEN 'ignored' WHEN e.page_id % 5 = 0 THEN 'foreign' WHEN e.hash IS NULL THEN 'stub' WHEN f.path < e.path OR e.hash IN (SELECT md5(text) FROM documents) THEN 'duplicate' ELSE 'article' END AS action
    FROM e LEFT JOIN l ON l.path = e.path LEFT JOIN f ON f.hash = e.hash) SELECT action, count(*) AS n FROM a GROUP BY action""")
def _(t: Tables) -> DataFrame:
    actions = archives.article_actions(*_landed(t), t.documents.select(F.md5("text").alias("hash")))
    return actions.groupBy("action").agg(F.count("*").alias("n"))


@query("f16_language_paths", """SELECT page_id, regexp_extract(concat('/w/p', CASE page_id % 4 WHEN 0 THEN '/de' WHEN 1 THEN '/en' WHEN 2 THEN '/fr' ELSE '/abc' END), '/([a-z]{2,3})$', 1) AS lang FROM pages WHERE page_id % 4 IN (0, 2)""")
def _(t: Tables) -> DataFrame:
    k = F.col("page_id") % 4
    path = F.concat(F.lit("/w/p"), F.when(k == 0, "/de").when(k == 1, "/en").when(k == 2, "/fr").otherwise("/abc"))
    return t.pages.select("page_id", archives.path_language(path).alias("lang")).where("lang is not null")


@query("f17_language_gate", "SELECT doc_id, lang IN ('en', 'de') OR length(trim(left(text, 1500))) < 50 AS allowed FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", archives.language_allowed(F.col("text"), F.col("lang"), ["en", "de"]).alias("allowed"))


@query("f18_short_windows", "SELECT conv_id, turn, CASE WHEN length(trim(text)) < 50 THEN 0 ELSE 2 END AS n FROM conversations")
def _(t: Tables) -> DataFrame:
    kept = archives.window_concepts(F.col("text"), F.array("role", "role"))
    return t.conversations.select("conv_id", "turn", F.size(kept).alias("n"))


@query("f19_size_gate", "SELECT doc_id, CASE WHEN n_chars / 1048576.0 <= 0.002 THEN 'accept' ELSE 'reject' END AS action FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", archives.size_action(F.col("n_chars"), 0.002).alias("action"))


@query("s18_best_candidate", """WITH c AS (SELECT l_orderkey AS k, l_linenumber AS place, concat('m', CAST(l_linenumber AS VARCHAR(9))) AS method, CAST(l_quantity AS BIGINT) AS n, l_returnflag = 'A' AS ok FROM lineitem),
  r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY NOT ok, CASE WHEN ok THEN place ELSE -n END, place, n) AS rn FROM c) SELECT k, method, n FROM r WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    text = F.repeat(F.lit("x"), F.col("l_quantity").cast("int"))
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("place"), F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("method"), text.alias("text"), (F.col("l_returnflag") == "A").alias("ok"))
    return archives.best_text(rows, "k", "place", "text", "method", F.col("ok")).select("k", "method", F.length("text").cast("long").alias("n"))


@query("s34_retried_text", """SELECT doc_id, CASE WHEN length(text) > 2000 THEN 'first' WHEN doc_id % 2 = 0 THEN 'second' ELSE 'first' END AS taken FROM documents""")
def _(t: Tables) -> DataFrame:
    first, even = F.col("text"), F.col("doc_id") % 2 == 0
    second = F.when(even, F.concat(F.lit("+"), "text")).otherwise(F.substr("text", F.lit(2)))
    taken = archives.retried_text(first, second, F.length("text") > 2000)
    return t.documents.select("doc_id", F.when(taken == first, "first").otherwise("second").alias("taken"))


@query("s33_archive_metadata", """SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE r_name END AS title, CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE n_nationkey * 10 END AS article_count FROM nation JOIN region ON n_regionkey = r_regionkey""", longs="article_count")
def _(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    none = F.lit(None).cast("string")
    counter = F.when(k % 3 != 0, F.concat(F.lit("image/png=7;text/html="), (k * 10).cast("string"), F.lit(";bad=x"))).otherwise("image/png=7")
    own = t.nation.select(k.alias("k"), F.when(k % 2 == 0, F.col("n_name")).alias("title"), none.alias("description"), none.alias("language"), counter.alias("counter"))
    listed = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(k.alias("k"), F.col("r_name").alias("title"), none.alias("description"), none.alias("language"))
    return archives.archive_metadata(own, listed, "k").select("k", "title", "article_count")


_STATES = """z AS (SELECT c_nationkey AS k, count(*) AS article_count, count_if(c_acctbal > 0) AS processed, CASE c_nationkey % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'ingesting' ELSE 'detected' END AS status FROM customer GROUP BY c_nationkey),
  p AS (SELECT doc_id % 23 AS k, count(*) AS n, count_if(status NOT IN ('complete', 'failed')) AS live FROM doc GROUP BY 1),
  states AS (SELECT z.k, z.article_count, z.processed, coalesce(p.live, 0) AS in_pipeline, CASE WHEN z.status = 'complete' AND coalesce(p.live, 0) > 0 THEN 'processing' WHEN z.status = 'ingesting' THEN 'extracting' ELSE z.status END AS effective_status FROM z LEFT JOIN p ON z.k = p.k)"""


def _states(t: Tables) -> DataFrame:
    k = F.col("k") % 3
    rows = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("article_count"), F.count_if(F.col("c_acctbal") > 0).alias("processed"))
    rows = rows.withColumn("status", F.when(k == 0, "complete").when(k == 1, "ingesting").otherwise("detected"))
    return archives.archive_states(rows, t.doc.select((F.col("doc_id") % 23).alias("k"), "status"), "k")


@query("f31_effective_status", f"WITH {_STATES} SELECT k, in_pipeline, effective_status FROM states", longs="in_pipeline")
def _(t: Tables) -> DataFrame:
    return _states(t).select("k", "in_pipeline", "effective_status")


@query("a21_archive_totals", f"WITH {_STATES} SELECT count(*) AS archives, sum(article_count) AS article_count, sum(processed) AS processed, sum(in_pipeline) AS in_pipeline FROM states", longs="article_count processed in_pipeline")
def _(t: Tables) -> DataFrame:
    return archives.archive_totals(_states(t))


@query("w13_page_starts", """WITH p AS (SELECT conv_id, turn, text, sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn) - length(text) - 1 AS start FROM (SELECT conv_id, turn, concat('<', CAST(turn AS VARCHAR(9)), '> ', trim(text)) AS text FROM conversations) x)
  SELECT conv_id, turn, CAST(start AS INT) AS start FROM p""")
def _(t: Tables) -> DataFrame:
    pages = t.conversations.select("conv_id", "turn", F.concat(F.lit("<"), F.col("turn").cast("string"), F.lit("> "), F.trim("text")).alias("text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n")
    return archives.page_starts(pages, pages.groupBy("conv_id").agg(joined.alias("full")), "conv_id", "turn", "text")


@query("k18_new_windows", """WITH w AS (SELECT l_orderkey AS hash, l_linenumber % 3 AS win, min(l_partkey) AS body FROM lineitem GROUP BY 1, 2), old AS (SELECT DISTINCT l_orderkey AS hash, l_linenumber % 3 AS win FROM lineitem WHERE l_returnflag = 'R')
  SELECT w.hash, w.win, w.body FROM w LEFT JOIN old ON w.hash = old.hash AND w.win = old.win WHERE old.hash IS NULL""")
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("hash"), (F.col("l_linenumber") % 3).alias("win"), F.col("l_partkey").alias("body"), "l_returnflag")
    return archives.new_windows(rows.drop("l_returnflag"), rows.where("l_returnflag = 'R'"), ["hash", "win"])


@query("x10_remaining", "SELECT hash FROM cat WHERE hash NOT IN (SELECT hash FROM doc WHERE status IN ('complete', 'failed'))")
def _(t: Tables) -> DataFrame:
    return archives.remaining(t.cat.select("hash"), t.doc.where(F.col("status").isin(state.ENDED)), "hash")


@query("j12_orphans", "SELECT hash, 'text' AS kind FROM cat WHERE hash NOT IN (SELECT hash FROM doc)")
def _(t: Tables) -> DataFrame:
    return archives.orphans(t.cat.select("hash", F.lit("text").alias("kind")), t.doc)


@query("l12_validation", """WITH a AS (SELECT hash FROM cat WHERE doc_id % 4 <> 0), b AS (SELECT hash FROM cat WHERE doc_id % 9 <> 0)
  SELECT d.hash, CASE WHEN status IN ('extracted', 'enriching', 'enriched', 'embedding', 'complete') AND a.hash IS NULL THEN 'text_missing' ELSE 'concepts_missing' END AS issue FROM doc d LEFT JOIN a ON a.hash = d.hash LEFT JOIN b ON b.hash = d.hash
    WHERE (status IN ('extracted', 'enriching', 'enriched', 'embedding', 'complete') AND a.hash IS NULL) OR (status IN ('enriched', 'embedding', 'complete') AND b.hash IS NULL)
  UNION ALL SELECT hash, 'bad_window' FROM doc WHERE doc_id % 6 = 0 UNION ALL SELECT hash, 'orphan_text' FROM a WHERE hash NOT IN (SELECT hash FROM doc) UNION ALL SELECT hash, 'orphan_concepts' FROM b WHERE hash NOT IN (SELECT hash FROM doc)""")
def _(t: Tables) -> DataFrame:
    kinds = F.array_compact(F.array(F.when(F.col("doc_id") % 4 != 0, "text"), F.when(F.col("doc_id") % 9 != 0, "concepts")))
    there = t.cat.select("hash", F.explode(kinds).alias("kind"))
    return archives.validation(t.doc, there, t.doc.select("hash", (F.col("doc_id") % 6 != 0).alias("valid")))


@query("f40_health", "SELECT CASE WHEN count_if(c_acctbal < 0 AND c_mktsegment = 'BUILDING') > 0 THEN 'unhealthy' WHEN count_if(c_acctbal < 0) > 0 THEN 'degraded' ELSE 'healthy' END AS status FROM customer")
def _(t: Tables) -> DataFrame:
    return archives.health(t.customer.select(F.col("c_mktsegment").alias("name"), (F.col("c_acctbal") >= 0).alias("up")), "BUILDING")


# --- labels and counts ------------------------------------------------------------------------


@query("f41_job_buckets", "SELECT CASE WHEN status = 'complete' THEN 'complete' WHEN status IN ('failed', 'queued') THEN 'ended' ELSE 'active' END AS bucket, count(*) AS n FROM doc GROUP BY 1")
def _(t: Tables) -> DataFrame:
    groups = {"complete": ["complete"], "ended": ["failed", "queued"]}
    return t.doc.groupBy(analytics.bucket(F.col("status"), groups, "active").alias("bucket")).agg(F.count("*").alias("n"))


@query("f42_channel_labels", "SELECT c_custkey, CASE WHEN count(o_orderkey) > 0 THEN 'syncing' ELSE 'new' END AS label FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY c_custkey")
def _(t: Tables) -> DataFrame:
    counts = t.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.join(counts, "c_custkey", "left").select("c_custkey", F.when(F.col("n") > 0, "syncing").otherwise("new").alias("label"))


@query("a18_status_report", "SELECT 'catalogue' AS tbl, 'known' AS status, count(*) AS n FROM cat UNION ALL SELECT 'documents', status, count(*) FROM doc GROUP BY status")
def _(t: Tables) -> DataFrame:
    known = t.cat.agg(F.lit("catalogue").alias("tbl"), F.lit("known").alias("status"), F.count("*").alias("n"))
    return known.unionByName(t.doc.groupBy("status").agg(F.count("*").alias("n")).withColumn("tbl", F.lit("documents")))


@query("a25_throughput", """SELECT o_custkey, round(CAST(count(*) AS DOUBLE) / 60, 6) AS per_second, round((100 - count(*)) / (CAST(count(*) AS DOUBLE) / 60), 4) AS remaining FROM orders GROUP BY o_custkey""")
def _(t: Tables) -> DataFrame:
    rate = analytics.throughput(F.col("n"), F.lit(100), F.lit(60.0))
    rows = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).select("o_custkey", rate.alias("r"))
    return rows.select("o_custkey", F.round("r.per_second", 6).alias("per_second"), F.round("r.remaining_seconds", 4).alias("remaining"))


@query("a28_backlog_groups", "SELECT o_custkey, count_if(o_orderstatus IN ('O', 'P')) AS waiting FROM orders GROUP BY o_custkey", longs="waiting")
def _(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    states = F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n")))
    return counts.groupBy("o_custkey").agg(states.alias("s")).select("o_custkey", analytics.backlog(F.col("s"), ["O", "P"]).alias("waiting"))


@query("a29_distinct_results", "SELECT source, hash, rn FROM (SELECT source, hash, CAST(row_number() OVER (PARTITION BY source ORDER BY hash) AS INT) AS rn FROM (SELECT DISTINCT source, md5(text) AS hash FROM documents) d) x WHERE rn <= 5")
def _(t: Tables) -> DataFrame:
    return analytics.top_n(t.documents.select("source", F.md5("text").alias("hash")).distinct(), ["source"], [F.col("hash")], 5)


@query("f07_moved_paths", """SELECT hash FROM doc WHERE doc_id % 3 = 0""")
def _(t: Tables) -> DataFrame:
    moved = t.doc.withColumn("path", F.when(F.col("doc_id") % 3 == 0, F.concat("path", F.lit(".moved"))).otherwise(F.col("path")))
    batch = moved.select("hash", "filename", "path", F.lit("s").alias("source"), F.lit("c").alias("category"), F.lit(1).cast("long").alias("size_bytes"))
    old = t.cat.drop("doc_id")
    return state.catalogue_upsert(old, batch, F.lit("2024-01-01").cast("timestamp_ntz")).where("path_updated_at is not null").select("hash")


@query("k06_synced_paths", """SELECT d.hash, c.path, false AS flagged FROM doc d JOIN cat c ON d.hash = c.hash""")
def _(t: Tables) -> DataFrame:
    stale = t.doc.withColumn("path", F.lit("old")).withColumn("path_updated_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    return state.sync_paths(stale, t.cat).select("hash", "path", F.col("path_updated_at").isNotNull().alias("flagged"))


@query("k07_organized", "SELECT hash, status = 'complete' AND doc_id % 2 = 0 AS organized FROM doc")
def _(t: Tables) -> DataFrame:
    rows = t.doc.withColumn("organized_at", F.when(F.col("status") == "failed", F.lit("2020-01-01").cast("timestamp_ntz")))
    done = state.mark_organized(rows, (F.col("status") == "complete") & (F.col("doc_id") % 2 == 0), F.lit("2024-01-01").cast("timestamp_ntz"))
    return state.clear_organized(done, F.col("status") == "failed").select("hash", F.col("organized_at").isNotNull().alias("organized"))


# --- library plans ----------------------------------------------------------------------------


def _domains(t: Tables) -> DataFrame:
    return t.cat.select("hash", F.when(F.col("category") != "en", F.col("category")).alias("domain"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("subdomain"))


_PLAN = """f AS (SELECT c.hash, c.path, c.doc_id, d.status, d.book_title, CASE WHEN c.category <> 'en' THEN c.category END AS domain, CASE WHEN c.doc_id % 2 = 0 THEN upper(left(c.source, 1)) || substr(c.source, 2) ELSE 'General' END AS sub FROM cat c LEFT JOIN doc d ON c.hash = d.hash),
  g AS (SELECT *, CASE WHEN domain IS NOT NULL THEN concat('/library/', upper(left(domain, 1)) || substr(domain, 2), '/', sub) END AS folder, CASE WHEN book_title IS NOT NULL THEN concat(replace(book_title, ' ', '_'), '.pdf') ELSE concat('doc_', CAST(doc_id AS VARCHAR(20)), '.pdf') END AS name FROM f)"""


@query("l04_organise_actions", f"""WITH {_PLAN} SELECT hash, CASE WHEN domain IS NULL THEN 'skip_unclassified' WHEN path = concat(folder, '/doc ', CAST(doc_id AS VARCHAR(20)), '.pdf') THEN 'already_organized' ELSE 'would_move' END AS action,
  CASE WHEN domain IS NOT NULL THEN concat(folder, '/doc ', CAST(doc_id AS VARCHAR(20)), '.pdf') END AS target FROM g""")
def _(t: Tables) -> DataFrame:
    rows = t.cat.join(_domains(t), "hash")
    target = F.concat(library.target_folder("/library", F.col("domain"), F.col("subdomain")), F.lit("/"), N.sanitized(F.col("filename"), F.col("hash")))
    return rows.select("hash", library.organise_action(F.col("domain"), F.col("path"), target, F.lit(True)).alias("action"), target.alias("target"))


@query("l04_manifest_actions", """SELECT hash, CASE WHEN doc_id % 5 = 1 OR doc_id % 7 = 0 THEN 'skipped' WHEN doc_id % 3 = 0 THEN 'already_organized' WHEN category = 'fr' THEN 'not_found' ELSE 'moved' END AS action FROM cat""")
def _(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    target = F.when(i % 5 == 1, "").when(i % 3 == 0, F.col("path")).otherwise(F.concat("path", F.lit(".new")))
    return t.cat.select("hash", library.manifest_action(target, F.col("filename"), i % 7 == 0, F.col("path"), F.col("category") != "fr").alias("action"))


@query("l05_filing", f"""WITH {_PLAN} SELECT hash, CASE WHEN domain IS NULL THEN 'skip_unclassified' WHEN status IS NULL THEN 'error' ELSE 'would_file' END AS action, CASE WHEN domain IS NOT NULL THEN concat(folder, '/doc ', CAST(doc_id AS VARCHAR(20)), '.epub') END AS target FROM g""")
def _(t: Tables) -> DataFrame:
    rows = t.cat.join(_domains(t), "hash").join(t.doc.select("hash", "status"), "hash", "left")
    source = F.concat(F.lit("/hopper/x.y/in"), F.col("doc_id").cast("string"), F.lit(".EPUB"))
    target = library.filing_target("/library", F.col("domain"), F.col("subdomain"), F.col("filename"), F.col("hash"), source)
    action = library.filing_action(F.lit(True), F.col("domain"), F.col("status").isNotNull(), source, target)
    return rows.select("hash", action.alias("action"), target.alias("target"))


@query("l06_ingest_phases", """SELECT c.hash, CASE WHEN d.status = 'complete' THEN 'duplicate' ELSE 'acquired' END AS acquire, CASE WHEN c.doc_id % 4 = 0 THEN 'skip_not_ingest' WHEN c.category = 'en' THEN 'skip_unclassified' WHEN c.category <> 'de' THEN 'skip_wrong_domain' WHEN c.doc_id % 3 = 0 THEN 'duplicate_review' ELSE 'placed' END AS place
  FROM cat c LEFT JOIN doc d ON c.hash = d.hash""")
def _(t: Tables) -> DataFrame:
    rows = t.cat.join(t.doc.select("hash", "status"), "hash", "left").join(_domains(t), "hash")
    place = library.place_action(F.col("path"), "/library/", F.col("domain"), "de", F.when(F.col("doc_id") % 3 == 0, 4).otherwise(1))
    return rows.select("hash", library.acquire_action(F.col("status")).alias("acquire"), place.alias("place"))


@query("l07_migration_stats", f"""WITH {_PLAN}, s AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN concat(folder, '/', name) WHEN doc_id % 3 = 1 THEN concat(folder, '/x.pdf') ELSE path END AS here FROM g)
  SELECT CASE WHEN status IS NULL THEN 'not_catalogued' WHEN domain IS DISTINCT FROM 'de' THEN 'domain_mismatch' WHEN doc_id % 3 = 0 THEN 'already_correct' WHEN doc_id % 7 = 0 THEN 'duplicates' WHEN doc_id % 3 = 1 THEN 'renamed' ELSE 'moved' END AS stat, count(*) AS n FROM s GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    rows = t.cat.join(t.doc.select("hash", "status", "book_title"), "hash", "left").join(_domains(t), "hash")
    i, folder = F.col("doc_id"), library.target_folder("/library", F.col("domain"), F.col("subdomain"))
    rows = library.with_planned_name(rows.withColumn("folder", folder), "book_title", "filename", "hash")
    here = F.when(i % 3 == 0, F.concat("folder", F.lit("/"), "name")).when(i % 3 == 1, F.concat("folder", F.lit("/x.pdf"))).otherwise(F.col("path"))
    stat = library.migration_stat(F.col("status").isNotNull(), F.col("domain"), "de", here, F.col("folder"), F.col("name"), F.when(i % 7 == 0, 4).otherwise(1))
    return rows.groupBy(stat.alias("stat")).agg(F.count("*").alias("n"))


@query("l09_sweep_plan", f"""WITH {_PLAN}, h AS (SELECT *, CASE WHEN status IS NULL THEN 'rescue' WHEN status IN ('queued', 'extracting', 'enriching', 'embedding') THEN 'skip_in_progress' WHEN status = 'failed' THEN 'skip_failed' WHEN status <> 'complete' THEN 'skip_other_status'
    WHEN book_title IS NULL THEN 'skip_garbage' WHEN domain IS NULL THEN 'unclassified' ELSE 'relocate' END AS action, list_extract(string_split(path, '/'), -1) AS base FROM g)
  SELECT hash, action, CASE action WHEN 'rescue' THEN '/library/_acquired' WHEN 'unclassified' THEN '/library/_unclassified' WHEN 'relocate' THEN folder END AS folder,
    CASE WHEN action = 'rescue' THEN base WHEN action = 'unclassified' THEN name WHEN action = 'relocate' AND doc_id % 4 = 2 THEN concat(left(name, length(name) - 4), '_Lee.pdf') WHEN action = 'relocate' THEN name END AS name, CASE WHEN action = 'relocate' THEN CASE WHEN doc_id % 4 = 2 THEN 2 ELSE 1 END END AS step FROM h""")
def _(t: Tables) -> DataFrame:
    docs = t.doc.select("hash", "status", "filename", "book_title", F.when(F.col("doc_id") % 4 == 2, "Ann Lee").alias("book_author"))
    with tables.scratch(t.spark):
        plan = library.sweep_plan(t.cat.select("hash", "path"), docs, _domains(t), "/library").select("hash", "action", "folder", "name", "step")
        return tables.stored(plan, "plan", scope=2)


@query("l09_sweep_statistics", f"""WITH {_PLAN}, h AS (SELECT *, CASE WHEN status IS NULL THEN 'rescue' WHEN status IN ('queued', 'extracting', 'enriching', 'embedding') THEN 'skip_in_progress' WHEN status = 'failed' THEN 'skip_failed' WHEN status <> 'complete' THEN 'skip_other_status'
    WHEN book_title IS NULL THEN 'skip_garbage' WHEN domain IS NULL THEN 'unclassified' ELSE 'relocate' END AS action FROM g)
  SELECT 'action' AS kind, action AS value, count(*) AS n FROM h GROUP BY action UNION ALL SELECT 'step', '1', count(*) FROM h WHERE action = 'relocate' HAVING count(*) > 0""")
def _(t: Tables) -> DataFrame:
    docs = t.doc.select("hash", "status", "filename", "book_title", F.lit(None).cast("string").alias("book_author"))
    with tables.scratch(t.spark):
        plan = library.sweep_plan(t.cat.select("hash", "path"), docs, _domains(t), "/library")
        return tables.stored(library.sweep_statistics(plan), "statistics", scope=2)


@query("l13_book_routing", """SELECT p_partkey, CASE WHEN p_size % 13 = 0 THEN 'rejected' WHEN p_partkey % 7 = 0 THEN 'duplicate' WHEN p_retailprice / 100 > 12 THEN 'content_failure' WHEN p_size % 5 = 0 THEN 'skip_empty' WHEN p_brand = 'Brand#11' THEN 'level4_duplicate' ELSE 'accepted' END AS action FROM part""")
def _(t: Tables) -> DataFrame:
    size = F.col("p_size")
    action = library.book_action(size % 13 != 0, F.col("p_retailprice") / 100, 12, size % 5, F.col("p_partkey") % 7 == 0, F.col("p_brand") == "Brand#11")
    return t.part.select("p_partkey", action.alias("action"))


@query("l15_window_repairs", """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'already_valid' WHEN d.doc_id IS NULL THEN 'no_source_text' ELSE 'would_repair' END AS action FROM lineitem LEFT JOIN documents d ON d.doc_id = l_orderkey""")
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.documents.select(F.col("doc_id").alias("l_orderkey"), "text"), "l_orderkey", "left")
    return rows.select("l_orderkey", "l_linenumber", library.repair_action(F.col("l_returnflag") == "N", F.col("text")).alias("action"))
