"""Queries over concepts, captions, time series, points and texts."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.functions import markup
from loomcorpus.functions import text as X
from loomcorpus.functions import vectors as V
from loomcorpus.operators import analytics, concepts, keywords, library, search
from loomcorpus.plans.registry import query
from loomcorpus.sources.bindings import Tables


def _top(column: str) -> str:
    return f"SELECT doc, {column} AS v, count(*) AS n, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, {column}) AS k FROM c WHERE {column} IS NOT NULL GROUP BY doc, {column}"


@query("a10_dominant_domain", f"""WITH c AS (SELECT doc, CASE WHEN win % 5 = 0 THEN NULL ELSE domain END AS domain, subdomain FROM con), d AS ({_top("domain")}), s AS ({_top("subdomain")}), n AS (SELECT doc, count(*) AS n FROM c GROUP BY doc),
  t AS (SELECT n.doc, n.n AS total, x.v AS domain, x.n AS a, coalesce(y.n, 0) AS b, s.v AS subdomain FROM n LEFT JOIN d x ON n.doc = x.doc AND x.k = 1 LEFT JOIN d y ON n.doc = y.doc AND y.k = 2 LEFT JOIN s ON n.doc = s.doc AND s.k = 1)
  SELECT doc, CASE WHEN b < 0.8 * a AND CAST(a AS DOUBLE) / total >= 0.4 THEN domain END AS domain, CASE WHEN b < 0.8 * a AND CAST(a AS DOUBLE) / total >= 0.4 THEN subdomain END AS subdomain,
    round(coalesce(CAST(a AS DOUBLE) / total, 0), 6) AS confidence FROM t""")
def _(t: Tables) -> DataFrame:
    """Concepts of every fifth window have no domain; they count in the share."""
    rows = t.con.withColumn("domain", F.when(F.col("win") % 5 != 0, F.col("domain")))
    return concepts.dominant(rows, "doc", "domain", "subdomain").withColumn("confidence", F.round("confidence", 6))


@query("a08_facets", """SELECT 'label' AS facet, CAST(label AS VARCHAR) AS value, count(*) AS n FROM pts GROUP BY label
  UNION ALL SELECT 'source_type', source_type, count(*) FROM pts GROUP BY source_type""")
def _(t: Tables) -> DataFrame:
    return analytics.facets(t.pts, ["label", "source_type"])


@query("a09_centroids", """WITH c AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) r(i) GROUP BY label, i)
  SELECT label, CAST(i - 1 AS INTEGER) AS i, round(x, 6) AS x FROM c""")
def _(t: Tables) -> DataFrame:
    means = V.centroids(t.embeddings, "label", "embedding")
    return means.select("label", F.posexplode("centroid").alias("i", "x")).withColumn("x", F.round("x", 6))


@query("a12_title_frequency", "SELECT title, count(*) AS n FROM con GROUP BY title ORDER BY n DESC, title LIMIT 50")
def _(t: Tables) -> DataFrame:
    return t.con.groupBy("title").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "title").limit(50)


@query("a13_action_histogram", "SELECT operation, count_if(is_reversed) AS reversed, count_if(NOT is_reversed) AS live FROM ops GROUP BY operation", longs="reversed live")
def _(t: Tables) -> DataFrame:
    return t.ops.groupBy("operation").agg(F.count_if("is_reversed").alias("reversed"), F.count_if(~F.col("is_reversed")).alias("live"))


@query("a15_method_map", """WITH p AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2)
  SELECT conv_id, string_agg(role || '=' || n, ';' ORDER BY role) AS methods, sum(n) AS pages FROM p GROUP BY conv_id""", longs="pages")
def _(t: Tables) -> DataFrame:
    counts = t.conversations.groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    pair = F.concat("role", F.lit("="), F.col("n").cast("string"))
    return counts.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list(pair)), ";").alias("methods"), F.sum("n").alias("pages"))


@query("a19_mapping_distribution", """SELECT domain AS old, CASE WHEN length(subdomain) % 2 = 0 THEN domain ELSE upper(subdomain) END AS new, count(*) AS n FROM con GROUP BY 1, 2 ORDER BY n DESC, old, new LIMIT 30""")
def _(t: Tables) -> DataFrame:
    new = F.when(F.length("subdomain") % 2 == 0, F.col("domain")).otherwise(F.upper("subdomain"))
    return t.con.groupBy(F.col("domain").alias("old"), new.alias("new")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "old", "new").limit(30)


@query("a26_cost_estimate", "SELECT source, count(*) AS n, round(sum(ceil(n_chars / 4.0) * 0.10 + 60 * 0.40) / 1000000, 9) AS dollars FROM documents GROUP BY source")
def _(t: Tables) -> DataFrame:
    """A prompt of each text (four characters a token) and an answer of 60 tokens."""
    cost = analytics.call_cost(F.ceil(F.col("n_chars") / 4.0), F.lit(60), 0.10, 0.40)
    return t.documents.groupBy("source").agg(F.count("*").alias("n"), F.round(F.sum(cost), 9).alias("dollars"))


@query("a27_metadata_vote", """WITH s AS (SELECT p_partkey AS doc, 'title' AS field, 1 AS pr, p_type AS v FROM part UNION ALL SELECT p_partkey, 'title', 2, CASE WHEN p_size % 2 = 0 THEN upper(p_type) ELSE p_brand END FROM part
  UNION ALL SELECT p_partkey, 'title', 3, CASE WHEN p_size % 3 = 0 THEN 'null' ELSE p_brand END FROM part),
  g AS (SELECT doc, field, lower(trim(v)) AS norm, count(*) AS n, min(pr) AS pr, arg_min(v, pr) AS v FROM s WHERE lower(trim(v)) NOT IN ('', 'null') GROUP BY 1, 2, 3),
  k AS (SELECT *, row_number() OVER (PARTITION BY doc, field ORDER BY CASE WHEN n >= 2 THEN -n ELSE 0 END, pr) AS k FROM g)
  SELECT doc, field, v, CASE WHEN n >= 2 THEN 'voted' ELSE 'priority' END AS provenance FROM k WHERE k = 1""")
def _(t: Tables) -> DataFrame:
    p = t.part
    values = F.array(
        F.struct(F.lit(1).alias("pr"), F.col("p_type").alias("v")),
        F.struct(F.lit(2).alias("pr"), F.when(F.col("p_size") % 2 == 0, F.upper("p_type")).otherwise(F.col("p_brand")).alias("v")),
        F.struct(F.lit(3).alias("pr"), F.when(F.col("p_size") % 3 == 0, "null").otherwise(F.col("p_brand")).alias("v")),
    )
    rows = p.select(F.col("p_partkey").alias("doc"), F.lit("title").alias("field"), F.explode(values).alias("x")).select("doc", "field", "x.*")
    return analytics.vote(rows, "doc", "field", "v", "pr")


@query("a30_distinct_sample", """SELECT domain, subdomain, doc, win FROM (SELECT domain, subdomain, doc, win, row_number() OVER (PARTITION BY domain, subdomain ORDER BY doc, win) AS k FROM con) x WHERE k = 1 ORDER BY domain, subdomain LIMIT 20""")
def _(t: Tables) -> DataFrame:
    first = t.con.groupBy("domain", "subdomain").agg(F.min(F.struct("doc", "win")).alias("f"))
    return first.select("domain", "subdomain", "f.doc", "f.win").orderBy("domain", "subdomain").limit(20)


@query("w01_name_collisions", """WITH f AS (SELECT p_partkey, concat('dir', CAST(p_size % 5 AS VARCHAR(20))) AS folder, concat(CASE WHEN p_partkey % 2 = 0 THEN upper(p_brand) ELSE p_brand END, '.pdf') AS name, md5(p_name) AS hash FROM part)
  SELECT p_partkey, folder, CASE WHEN row_number() OVER (PARTITION BY folder, lower(name) ORDER BY p_partkey) = 1 THEN name
    ELSE concat(left(regexp_replace(name, '\\.pdf$', ''), 120 - 4 - 9), ' [', left(hash, 6), ']', '.pdf') END AS final_name FROM f""".replace("\\\\", "\\"))
def _(t: Tables) -> DataFrame:
    name = F.concat(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")), F.lit(".pdf"))
    folder = F.concat(F.lit("dir"), (F.col("p_size") % 5).cast("string"))
    files = t.part.select("p_partkey", folder.alias("folder"), name.alias("name"), F.md5("p_name").alias("hash"))
    return library.resolve_collisions(files, "folder", "name", "hash", "p_partkey").select("p_partkey", "folder", "final_name")


@query("w02_repeated_cues", """SELECT user_id, event_id, event_type FROM (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) x WHERE b IS DISTINCT FROM event_type""")
def _(t: Tables) -> DataFrame:
    return analytics.without_repeats(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id", "event_type")


@query("w03_latest_operation", """SELECT doc, id, operation FROM (SELECT doc, id, operation, row_number() OVER (PARTITION BY doc ORDER BY performed_at DESC, id DESC) AS k FROM ops WHERE NOT is_reversed) x WHERE k = 1""")
def _(t: Tables) -> DataFrame:
    live = t.ops.where("NOT is_reversed").groupBy("doc").agg(F.max(F.struct("performed_at", "id", "operation")).alias("l"))
    return live.select("doc", "l.id", "l.operation")


@query("w04_keep_newest", """SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) x WHERE k <= 3""")
def _(t: Tables) -> DataFrame:
    return analytics.top_n(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id")


@query("w05_cue_offsets", """SELECT conv_id, turn, coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM conversations""", longs='"offset"')
def _(t: Tables) -> DataFrame:
    return analytics.offsets(t.conversations, "conv_id", "turn", "text").select("conv_id", "turn", "offset")


@query("w06_page_windows", """SELECT conv_id, CAST(floor(turn / 5) AS BIGINT) AS win, string_agg(concat('--- Page ', CAST(turn + 1 AS VARCHAR(20)), ' ---', chr(10), text), chr(10) || chr(10) ORDER BY turn) AS content,
  min(turn + 1) AS start_page, count(*) AS n_pages FROM conversations GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    pages = t.conversations.select("conv_id", (F.col("turn") + 1).alias("page_no"), "text")
    return analytics.page_windows(pages, "conv_id", "page_no", "text", 5)


@query("w07_concept_index", "SELECT doc, win, title, CAST(row_number() OVER (PARTITION BY doc ORDER BY win, title) - 1 AS INTEGER) AS idx FROM con")
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("doc").orderBy("win", "title")
    return t.con.select("doc", "win", "title", (F.row_number().over(order) - 1).alias("idx"))


@query("w10_checkpoint_delta", "SELECT user_id, event_id, round(value - lag(value, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id), 6) AS delta FROM events")
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    before = F.lag("value", 1, 0.0).over(Window.partitionBy("user_id").orderBy("event_id"))
    return t.events.select("user_id", "event_id", F.round(F.col("value") - before, 6).alias("delta"))


@query("w11_trend", """SELECT event_id, CASE WHEN p IS NULL OR value = p THEN 'flat' WHEN value > p THEN 'up' ELSE 'down' END AS trend FROM (SELECT event_id, value, lag(value) OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS p FROM events) x""")
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    before = F.lag("value").over(Window.partitionBy("event_type", "user_id").orderBy("event_id"))
    rows = t.events.withColumn("p", before)
    return rows.select("event_id", F.when(F.col("p").isNull() | (F.col("value") == F.col("p")), "flat").when(F.col("value") > F.col("p"), "up").otherwise("down").alias("trend"))


@query("j15_as_of", """WITH c AS (SELECT user_id, ts, max(event_id) AS cue FROM events WHERE event_type = 'view' GROUP BY 1, 2), p AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase')
  SELECT p.event_id, p.user_id, coalesce((SELECT max_by(cue, c.ts) FROM c WHERE c.user_id = p.user_id AND c.ts <= p.ts), (SELECT min_by(cue, c.ts) FROM c WHERE c.user_id = p.user_id)) AS cue FROM p""")
def _(t: Tables) -> DataFrame:
    cues = t.events.where("event_type = 'view'").groupBy("user_id", F.col("ts").alias("cue_ts")).agg(F.max("event_id").alias("cue"))
    marks = t.events.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    return analytics.as_of(marks, cues, "user_id", "ts", "cue_ts", "cue").select("event_id", "user_id", "cue")


_RULES = [(1, "steel", "Metalwork"), (2, "copper", "Metalwork"), (3, "small", "Handicraft"), (4, "red", "Pigments"), (5, "large", "Construction")]
_RULES_SQL = ", ".join(f"({n}, '{k}', '{v}')" for n, k, v in _RULES)


@query("j17_first_rule", f"""WITH r(no, kw, v) AS (VALUES {_RULES_SQL})
  SELECT p_partkey, p_name, (SELECT min_by(v, no) FROM r WHERE contains(lower(p_name), kw)) AS value FROM part""")
def _(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame(_RULES, "rule_no int, keyword string, value string")
    return keywords.first_rule(t.part.select("p_partkey", "p_name"), rules, "p_name")


@query("j18_variant_map", """WITH m AS (SELECT p_type AS variant, CASE WHEN min(p_partkey) % 5 = 0 THEN NULL ELSE upper(left(p_type, 5)) END AS canonical FROM part GROUP BY p_type)
  SELECT doc, string_agg(canonical, ',' ORDER BY canonical) AS mapped FROM (SELECT DISTINCT c.doc, m.canonical FROM con c JOIN m ON c.domain = m.variant WHERE m.canonical IS NOT NULL) x GROUP BY doc""")
def _(t: Tables) -> DataFrame:
    names = t.part.groupBy("p_type").agg(F.min("p_partkey").alias("k"))
    mapping = names.select(F.col("p_type").alias("variant"), F.when(F.col("k") % 5 != 0, F.upper(F.left("p_type", F.lit(5)))).alias("canonical"))
    return analytics.remap(t.con, mapping, "doc", "domain")


@query("j25_address_lookup", "SELECT id, number, street, city, state, zipcode, country FROM adr WHERE number = '13' AND street = upper('north st') ORDER BY id LIMIT 5")
def _(t: Tables) -> DataFrame:
    hit = t.adr.where((F.col("number") == "13") & (F.col("street") == "north st".upper()))
    return hit.orderBy("id").limit(5)


@query("t01_top_k", """WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 7)
  SELECT point_id, source_type, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(v AS DOUBLE[]), CAST(v AS DOUBLE[])))), 6) AS score
  FROM pts, q WHERE source_type = 'web' ORDER BY score DESC, point_id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    query_vector = t.embeddings.where("vec_id = 7")
    return search.top_k(t.pts, query_vector, 10, F.col("source_type") == "web").select("point_id", "source_type", F.round("score", 6).alias("score"))


def batch_sql(where: str) -> str:
    """Every vector whose id is divisible by 50 against all points, or those that meet ``where``."""
    return f"""WITH q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE vec_id % 50 = 0),
  s AS (SELECT query_id, point_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(v AS DOUBLE[]), CAST(v AS DOUBLE[])))), 10) AS score
    FROM pts, q WHERE {where}),
  r AS (SELECT query_id, point_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS INT) AS place FROM s)
  SELECT query_id, point_id, place, round(score, 6) AS score FROM r WHERE place <= 10"""


def _batch(t: Tables, where: Column | None = None) -> DataFrame:
    asked = t.embeddings.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return search.top_k_batch(t.pts, asked, 10, where).withColumn("score", F.round("score", 6))


@query("t01_top_k_batch", batch_sql("true"))
def _(t: Tables) -> DataFrame:
    return _batch(t)


@query("t01_top_k_batch_web", batch_sql("source_type = 'web'"))
def _(t: Tables) -> DataFrame:
    return _batch(t, F.col("source_type") == "web")


_ROUTED = "CASE WHEN vec_id % 97 = 0 THEN NULL WHEN vec_id % 89 = 0 THEN list_transform(embedding, lambda x: CAST(0 AS FLOAT)) ELSE embedding END"


@query("v05_router_all", f"""WITH e AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2),
  c AS (SELECT label, list(x ORDER BY i) AS v FROM e GROUP BY label),
  p AS (SELECT vec_id, {_ROUTED} AS v FROM embeddings),
  s AS (SELECT p.vec_id, c.label, coalesce(round(CASE WHEN vec_id % 89 = 0 THEN 0 ELSE list_cosine_similarity(CAST(p.v AS DOUBLE[]), c.v) END, 10), 0) AS s FROM p, c),
  b AS (SELECT vec_id, max(s) AS s, min_by(label, (-s, label)) AS label FROM s GROUP BY vec_id)
  SELECT vec_id AS point_id, CASE WHEN s < 0.1 THEN -1 ELSE label END AS route, round(greatest(s, 0), 6) AS score FROM b""")
def _(t: Tables) -> DataFrame:
    rows = t.embeddings.withColumnRenamed("vec_id", "point_id")
    k = F.col("point_id")
    vector = F.when(k % 97 == 0, None).when(k % 89 == 0, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))).otherwise(F.col("embedding"))
    return search.route(rows.withColumn("embedding", vector), rows, "label", -1, 0.1).withColumn("score", F.round("score", 6))


@query("c80_point_ids", "SELECT doc, win, CAST(('0x' || left(md5(concat_ws(':', doc, win, title)), 15)) AS BIGINT) AS id FROM con")
def _(t: Tables) -> DataFrame:
    return t.con.select("doc", "win", V.point_id(F.col("doc").cast("string"), F.col("win").cast("string"), F.col("title")).alias("id"))


#: A text between white space of several kinds, which all must go.
_PADDED = "concat(chr(10), chr(9), ' ', text, chr(13), chr(10), ' ')"
_BARE = rf"regexp_replace({_PADDED}, '^[\s\x0b]+|[\s\x0b]+$', '', 'g')"


def _padded() -> Column:
    return F.concat(F.lit("\n\t "), "text", F.lit("\r\n "))


@query("f14_text_quality", rf"""WITH w AS (SELECT doc_id, {_BARE} AS t, list_filter(regexp_split_to_array(text, '[\s\x0b]+'), lambda x: x <> '') AS ws FROM documents)
  SELECT doc_id, length(t) >= 50 AND 10 * len(list_filter(ws, lambda x: len(regexp_extract_all(x, '[A-Za-z]')) >= 2)) >= 6 * len(ws) AND 10 * len(regexp_extract_all(t, '[a-z][A-Z]')) <= len(ws) AS ok FROM w""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.quality_ok(_padded()).alias("ok"))


@query("f13_embeddable", f"SELECT doc_id, md5(left({_BARE}, 8192)) AS content_md5 FROM documents WHERE length({_BARE}) >= 10")
def _(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", X.embeddable(_padded()).alias("content")).where("content IS NOT NULL")
    return rows.select("doc_id", F.md5("content").alias("content_md5"))


@query("c41_word_count", "SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n_words FROM documents".replace("\\\\", "\\"))
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.word_count(F.col("text")).cast("long").alias("n_words"))


@query("c06_last_year", """SELECT o_orderkey, nullif(list_extract(regexp_extract_all(concat_ws(' ', concat('vol ', CAST(o_custkey + 1500 AS VARCHAR(20))), concat('(', CAST(year(o_orderdate) AS VARCHAR(20)), ')')), '\\b(1[89]\\d{2}|20\\d{2})\\b', 1), -1), '') AS year FROM orders""".replace("\\\\", "\\"))
def _(t: Tables) -> DataFrame:
    name = F.concat(F.lit("vol "), (F.col("o_custkey") + 1500).cast("string"))
    title = F.concat(F.lit("("), F.year("o_orderdate").cast("string"), F.lit(")"))
    return t.orders.select("o_orderkey", X.last_year(name, title).alias("year"))


@query("c07_folder_names", """SELECT p_partkey, list_aggregate(list_transform(list_filter(string_split(replace(p_type, '&', 'and'), ' '), lambda w: w <> ''),
  lambda w: CASE WHEN lower(w) IN ('and', 'of', 'the', 'to', 'for', 'in', 'on', 'at') THEN lower(w) ELSE upper(left(w, 1)) || lower(substr(w, 2)) END), 'string_agg', '-') AS folder FROM part""")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.folder_name(F.col("p_type")).alias("folder"))


@query("c12_page_filenames", """SELECT page_id, concat(left(regexp_replace(concat(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/', '_')), '[^A-Za-z0-9_.-]', '_', 'g'), 200), '.html') AS filename FROM pages""")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.url_filename(F.col("url")).alias("filename"))


@query("c13_slugs", "SELECT n_nationkey, left(regexp_replace(regexp_replace(lower(concat(n_name, '! (x)')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 50) AS slug FROM nation")
def _(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", X.slug(F.concat("n_name", F.lit("! (x)"))).alias("slug"))


@query("s03_text_hash", "SELECT doc_id, md5(text) AS hash FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5("text").alias("hash"))


@query("s11_page_titles", """SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, length(html) >= 100 AS long_enough FROM pages""")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.html_title(F.col("html")).alias("title"), (F.length("html") >= 100).alias("long_enough"))


def page_text_sql() -> str:
    """Character references as the HTML standard reads them: the names and the apostrophe's number with or without a
    semicolon, the longest name first, within one stretch of text. Those of ``<``, ``>`` and ``&`` wait as noncharacters
    until the tags are gone."""
    x = "html"
    heads = ("nbsp", "lt", "gt", "quot", "amp", "LT", "GT", "QUOT", "AMP")
    waiting = {"<": 64976, ">": 64977, "&": 64978}
    names = sorted((n for n in html5 if n.startswith(heads)), key=len, reverse=True)
    # Twice: the character behind one reference may begin the next.
    for _ in range(2):
        x = rf"regexp_replace({x}, '&#0*39(;|([^0-9;])|$)', chr(39) || '\2', 'g')"
    for name in names:
        plain = " || ".join(f"chr({waiting.get(c, ord(c))})" for c in html5[name])
        x = f"replace({x}, '&{name}', {plain})"
    for tag in sorted(markup.DROPPED):
        x = rf"regexp_replace({x}, '(?is)<{tag}\b.*?</{tag}\s*>', '', 'g')"
    for pattern, plain in ((r"(?i)<br\s*/?>", "chr(10)"), (r"(?i)<li\b[^>]*>", "'- '"), ("(?i)</li>", "chr(10)"), (r"(?s)<!--.*?-->", "''"), (r"(?s)<[^>]+>", "''")):
        x = f"regexp_replace({x}, '{pattern}', {plain}, 'g')"
    for plain, code in waiting.items():
        x = f"replace({x}, chr({code}), '{plain}')"
    x = rf"regexp_replace(regexp_replace({x}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
    blank = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
    return rf"SELECT page_id, regexp_replace({x}, '^{blank}|{blank}$', '', 'g') AS content FROM pages"


@query("c23_page_text", page_text_sql())
def _(t: Tables) -> DataFrame:
    """The parser's text; on the well-formed pages of the tables SQL's regular expressions give the same."""
    return t.pages.select("page_id", markup.html_text(F.col("html")).alias("content"))


@query("c40_chunk_pages", r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_replace(text, '^[\s\x0b]+|[\s\x0b]+$', '', 'g') AS t FROM documents),
  n AS (SELECT doc_id, t, len(list_filter(regexp_split_to_array(t, '[\s\x0b]+'), lambda x: x <> '')) AS words FROM w),
  q AS (SELECT doc_id, CASE WHEN 2 * words > 3 * 400 THEN regexp_split_to_array(regexp_replace(t, '([.!?])[\s\x0b]+', '\1' || chr(1), 'g'), chr(1)) WHEN t <> '' THEN [t] ELSE [] END AS ps FROM n),
  p AS (SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM q),
  m AS (SELECT doc_id, i, piece, len(list_filter(regexp_split_to_array(piece, '[\s\x0b]+'), lambda x: x <> '')) AS k FROM p),
  f AS (SELECT doc_id, i, k, 1 AS page, k AS held FROM m WHERE i = 1
    UNION ALL SELECT m.doc_id, m.i, m.k, CASE WHEN f.held + m.k > 400 THEN f.page + 1 ELSE f.page END, CASE WHEN f.held + m.k > 400 THEN m.k ELSE f.held + m.k END FROM f JOIN m ON m.doc_id = f.doc_id AND m.i = f.i + 1)
  SELECT f.doc_id, CAST(f.page AS INT) AS page_no, string_agg(m.piece, chr(10) || chr(10) ORDER BY f.i) AS content FROM f JOIN m ON f.doc_id = m.doc_id AND f.i = m.i GROUP BY f.doc_id, f.page
  UNION ALL SELECT doc_id, 1, text FROM documents WHERE regexp_replace(text, '[\s\x0b]+', '', 'g') = ''""")
def _(t: Tables) -> DataFrame:
    pages = F.posexplode(X.chunk_pages(F.col("text"), 400)).alias("pos", "content")
    return t.documents.select("doc_id", pages).select("doc_id", (F.col("pos") + 1).alias("page_no"), "content")


@query("c59_json_fields", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("c71_minute_truncation", "SELECT event_type, date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")).agg(F.count("*").alias("n"))


@query("x08_history_range", """SELECT event_id, metric_type, value FROM snap WHERE ts > (SELECT max(ts) FROM snap) - INTERVAL 168 HOURS""")
def _(t: Tables) -> DataFrame:
    latest = t.snap.agg(F.max("ts").alias("as_of"))
    recent = t.snap.join(F.broadcast(latest), F.col("ts") > F.col("as_of") - F.expr("INTERVAL 168 HOURS"))
    return recent.select("event_id", "metric_type", "value")


@query("x15_tumbling_windows", """SELECT event_type, time_bucket(INTERVAL 10 MINUTES, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    grouped = t.events.groupBy("event_type", F.window("ts", "10 minutes").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return grouped.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "total")


@query("x15_sessions", """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS s FROM events),
  b AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM a) SELECT user_id, min(ts) AS start, count(*) AS n FROM b GROUP BY user_id, k""")
def _(t: Tables) -> DataFrame:
    grouped = t.events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return grouped.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("l02_collision_ladder", """WITH f AS (SELECT md5(p_name) AS hash, concat('dir', CAST(p_size % 3 AS VARCHAR(20))) AS folder, p_brand AS title, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE left(p_type, 4) END AS author,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(1900 + p_size AS INTEGER) END AS year, p_partkey FROM part),
  g AS (SELECT hash, min(folder) AS folder, min(title) AS title, min(author) AS author, min(year) AS year FROM f GROUP BY hash),
  e AS (SELECT folder, name, min(hash) AS hash FROM (SELECT folder, concat(title, '.pdf') AS name, hash FROM g WHERE left(hash, 1) < '8' UNION ALL SELECT folder, concat(title, '_', author, '.pdf'), hash FROM g WHERE author IS NOT NULL AND left(hash, 1) < '4') x GROUP BY 1, 2),
  s AS (SELECT g.hash, g.folder, concat(title, '.pdf') AS n1, CASE WHEN author IS NOT NULL THEN concat(title, '_', author, '.pdf') END AS n2,
    CASE WHEN author IS NOT NULL AND year IS NOT NULL THEN concat(title, '_', author, '_', CAST(year AS VARCHAR(20)), '.pdf') END AS n3 FROM g),
  j AS (SELECT s.*, coalesce(e1.hash, s.hash) = s.hash AS f1, n2 IS NOT NULL AND coalesce(e2.hash, s.hash) = s.hash AS f2, n3 IS NOT NULL AND coalesce(e3.hash, s.hash) = s.hash AS f3 FROM s
    LEFT JOIN e e1 ON e1.folder = s.folder AND e1.name = n1 LEFT JOIN e e2 ON e2.folder = s.folder AND e2.name = n2 LEFT JOIN e e3 ON e3.folder = s.folder AND e3.name = n3)
  SELECT hash, folder, CAST(CASE WHEN f1 THEN 1 WHEN f2 THEN 2 WHEN f3 THEN 3 ELSE 4 END AS INTEGER) AS step, CASE WHEN f1 THEN n1 WHEN f2 THEN n2 WHEN f3 THEN n3 END AS name FROM j""")
def _(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    f = t.part.select(
        F.md5("p_name").alias("hash"), F.concat(F.lit("dir"), (F.col("p_size") % 3).cast("string")).alias("folder"), F.col("p_brand").alias("title"),
        F.when(p % 4 != 0, F.left("p_type", F.lit(4))).alias("author"), F.when(p % 3 != 0, 1900 + F.col("p_size")).alias("year"),
    )
    g = f.groupBy("hash").agg(*[F.min(c).alias(c) for c in ("folder", "title", "author", "year")])
    lead = F.left("hash", F.lit(1))
    taken = g.where(lead < "8").select("folder", F.concat("title", F.lit(".pdf")).alias("name"), "hash").union(
        g.where(F.col("author").isNotNull() & (lead < "4")).select("folder", F.concat("title", F.lit("_"), "author", F.lit(".pdf")), "hash")
    )
    return library.ladder(g, taken)


@query("l08_sweep_actions", """WITH f AS (SELECT c.hash, d.status, d.book_title, c.path, CASE WHEN c.category = 'en' THEN NULL ELSE c.category END AS domain FROM cat c LEFT JOIN doc d ON c.hash = d.hash)
  SELECT CASE WHEN status IS NULL THEN 'rescue' WHEN status IN ('queued', 'extracting', 'enriching', 'embedding') THEN 'skip_in_progress' WHEN status = 'failed' THEN 'skip_failed' WHEN status <> 'complete' THEN 'skip_other_status'
    WHEN book_title IS NULL OR length(trim(book_title)) < 4 OR lower(trim(book_title)) IN ('title 7') OR contains(trim(book_title), 'e 13') THEN 'skip_garbage' WHEN domain IS NULL THEN 'unclassified'
    WHEN path = concat('/library/', domain) THEN 'no_op' ELSE 'relocate' END AS action, count(*) AS n FROM f GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    rows = t.cat.join(t.doc.select("hash", "status", "book_title"), "hash", "left")
    domain = F.when(F.col("category") != "en", F.col("category"))
    garbage = X.garbage_title(F.col("book_title"), ["title 7"], ["e 13"])
    action = library.sweep_action(F.col("status"), garbage, domain, F.col("path"), F.concat(F.lit("/library/"), domain))
    return rows.groupBy(action.alias("action")).agg(F.count("*").alias("n"))


@query("l11_verify", """WITH m AS (SELECT o.id, c.path AS target, d.path AS db, concat('/old/', c.filename) AS source FROM ops o LEFT JOIN cat c ON o.doc = c.doc_id LEFT JOIN doc d ON c.hash = d.hash WHERE NOT o.is_reversed),
  f AS (SELECT path FROM cat WHERE category <> 'es' UNION SELECT concat('/old/', filename) FROM cat WHERE source = 'src2')
  SELECT m.id, CASE WHEN a.path IS NULL THEN 'target_missing' WHEN b.path IS NOT NULL THEN 'source_still_exists' WHEN m.db IS DISTINCT FROM m.target THEN 'db_path_mismatch' ELSE 'ok' END AS result
  FROM m LEFT JOIN f a ON a.path = m.target LEFT JOIN f b ON b.path = m.source""")
def _(t: Tables) -> DataFrame:
    """Operations that moved files out of an old folder, against the files and the documents' paths; files that aren't catalogued have no target."""
    moved = t.ops.where(~F.col("is_reversed")).join(t.cat, t.ops["doc"] == t.cat["doc_id"], "left").select(
        "id", "hash", F.col("path").alias("target"), F.concat(F.lit("/old/"), "filename").alias("source")
    )
    there = t.cat.where("category <> 'es'").select("path").union(t.cat.where("source = 'src2'").select(F.concat(F.lit("/old/"), "filename")))
    return library.verify(moved, there, t.doc.select("hash", "path")).select("id", "result")


@query("l12_missing_artefacts", """SELECT d.hash, CASE WHEN d.status IN ('extracted', 'enriching', 'enriched', 'embedding', 'complete') AND d.pages_extracted = 0 THEN 'text_missing'
  WHEN d.status IN ('enriched', 'embedding', 'complete') AND d.concepts_extracted = 0 THEN 'concepts_missing' END AS issue FROM doc d""")
def _(t: Tables) -> DataFrame:
    issue = library.missing_artefacts(F.col("status"), F.col("pages_extracted") > 0, F.col("concepts_extracted") > 0)
    return t.doc.select("hash", issue.alias("issue"))
