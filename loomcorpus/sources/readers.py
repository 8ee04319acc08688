"""Sources: library files, pages, captions, feeds, JSON windows, sidecars, lists, tables, intel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcorpus.functions import semistructured as J
from loomcorpus.functions import text as X

INTEL = "source string, category string, content string, region string, timestamp string, summary string, key_facts array<string>, _corrupt_record string"
CONCEPT = (
    "content string, summary string, title string, domain variant, subdomain array<string>, keywords array<string>, knowledge_type string, complexity string, "
    "key_facts array<string>, page_ref string, _window int, _start_page int, _doc_hash string"
)


def library_files(spark: SparkSession, root: str, extension: str = "pdf") -> DataFrame:
    """Catalogue rows of a folder tree: content hash, size, source and category from the path.

    Folders whose name starts with ``_`` are pruned; only files of the wanted extension (any case) are opened.
    """
    named = "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in extension)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", named).load(root)
    root_path = root.split("://", 1)[-1].rstrip("/")
    relative = F.regexp_replace(F.regexp_replace("path", r"^[a-z]+:/+", "/"), "^" + root_path.replace(".", r"\.") + "/", "")
    source, category = X.source_and_category(F.col("relative"))
    rows = files.withColumn("relative", relative).where(~F.col("relative").rlike("(^|/)_[^/]*/"))
    return rows.select(
        F.md5("content").alias("hash"), F.element_at(F.split("relative", "/"), -1).alias("filename"), F.col("path"), F.col("length").alias("size_bytes"),
        source.alias("source"), category.alias("category"), F.col("modificationTime").alias("modified_at"),
    )


def stable(files: DataFrame, as_of: Column, seconds: int, modified: str = "modified_at") -> DataFrame:
    """Files not modified in the last ``seconds``."""
    return files.where(F.col(modified) <= as_of - F.make_dt_interval(secs=F.lit(seconds)))


def page_files(spark: SparkSession, root: str) -> DataFrame:
    """``(hash, page_no, text)`` of ``<hash>/page_NNNN.txt`` files."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="page_*.txt").select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("text"))
    return files.select(
        F.regexp_extract("p", r"([^/]+)/page_\d+\.txt$", 1).alias("hash"), F.regexp_extract("p", r"page_(\d+)\.txt$", 1).try_cast("int").alias("page_no"), "text"
    ).where("page_no IS NOT NULL")


def concept_windows(spark: SparkSession, root: str) -> DataFrame:
    """Concept rows of ``<hash>/window_NNNN.json`` files: arrays, of which members that are no objects are dropped, single
    objects, and what can be repaired of either (``repaired``); other files give one row with ``bad``."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="window_*.json").select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("raw"))
    parsed = raw.withColumn("whole", F.try_parse_json("raw").isNotNull()).withColumn("fixed", J.repair(F.col("raw")))
    kind = F.coalesce(F.schema_of_variant(F.try_parse_json("fixed")), F.lit("bad"))
    listed = F.when(kind.startswith("OBJECT"), F.concat(F.lit("["), F.col("fixed"), F.lit("]"))).when(kind.startswith("ARRAY"), F.col("fixed"))
    members = F.filter(F.from_json(listed, "array<string>"), lambda x: F.ltrim(x).startswith("{"))
    concepts = F.transform(members, lambda x: F.from_json(x, f"struct<{_struct_fields()}>"))
    good = kind.startswith("ARRAY") | kind.startswith("OBJECT")
    return parsed.select(
        F.regexp_extract("p", r"([^/]+)/window_\d+\.json$", 1).alias("hash"), F.regexp_extract("p", r"window_(\d+)\.json$", 1).try_cast("int").alias("win"),
        concepts.alias("concepts"), (~good).alias("bad"), (good & ~F.col("whole")).alias("repaired"),
    )


def _struct_fields() -> str:
    return "content:string,summary:string,title:string,domain:string,subdomain:array<string>,keywords:array<string>,knowledge_type:string,complexity:string,key_facts:array<string>,page_ref:string"


def hopper_pairs(files: DataFrame) -> DataFrame:
    """Content files with the ``<base>.meta.json`` beside them, if there is one.

    One content file per base: the first by extension. Pairs are marked by ``has_meta``.
    """
    base = F.regexp_replace("filename", r"(\.meta)?\.[^.]+$", "")
    rows = files.withColumn("base", base).withColumn("meta", F.col("filename").endswith(".meta.json"))
    content = rows.where("NOT meta").groupBy("base").agg(F.min(F.struct(F.regexp_extract("filename", r"\.([^.]+)$", 1), "filename")).alias("f"))
    sidecars = rows.where("meta").groupBy("base").agg(F.min("filename").alias("meta_file"))
    joined = content.join(sidecars, "base", "left")
    return joined.select("base", F.col("f.filename").alias("filename"), "meta_file", F.col("meta_file").isNotNull().alias("has_meta"))


def url_list(spark: SparkSession, path: str, limit: int = 50) -> DataFrame:
    """URLs of a text file, blanks and ``#`` comments dropped, at most ``limit`` of a request."""
    lines = spark.read.text(path).select(F.trim("value").alias("url"))
    return lines.where("url <> '' AND NOT startswith(url, '#')").limit(limit)


def tsv_first_column(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t").select(F.col("_c0").alias("key"))


def opds_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(uuid, title, name, flavour, language, category, summary, article_count, zim_filename)`` of the entries of an Atom/OPDS
    feed: the id without its scheme, a blank category as null, a missing count as 0, and the archive's
    file name from the first link to HTML."""
    link = "struct<_href:string,_type:string>"
    schema = f"id string, title string, name string, flavour string, language string, category string, summary string, articleCount string, link array<{link}>"
    rows = spark.read.format("xml").option("rowTag", "entry").schema(schema).load(path)
    page = F.filter(F.coalesce("link", F.array().cast(f"array<{link}>")), lambda x: x["_type"] == "text/html")
    last = F.element_at(F.split(F.get(page, F.lit(0))["_href"], "/"), -1)
    return rows.select(
        F.replace("id", F.lit("urn:uuid:"), F.lit("")).alias("uuid"), "title", "name", "flavour", "language", F.nullif("category", F.lit("")).alias("category"), "summary",
        F.coalesce(F.col("articleCount").try_cast("int"), F.lit(0)).alias("article_count"), F.concat(F.nullif(last, F.lit("")), F.lit(".zim")).alias("zim_filename"),
    )


def intel_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Valid intel rows, and those that lack source, category or content."""
    rows = spark.read.schema(INTEL).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    ok = F.col("source").isNotNull() & F.col("category").isNotNull() & F.col("content").isNotNull() & F.col("_corrupt_record").isNull()
    return rows.where(ok).drop("_corrupt_record"), rows.where(~ok)


def markdown_table(spark: SparkSession, path: str) -> DataFrame:
    """``(title, hash)`` of the rows of a Markdown table whose cells hold an MD5."""
    cells = F.transform(F.split("value", r"\|"), lambda c: F.trim(c))
    rows = spark.read.text(path).where(F.col("value").startswith("|")).select(cells.alias("c"))
    hashes = F.filter("c", lambda c: c.rlike("^`?[0-9a-f]{32}`?$"))
    return rows.where(F.size(hashes) > 0).select(F.col("c")[1].alias("title"), F.regexp_replace(hashes[0], "`", "").alias("hash"))


def vtt_cues(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """``(key, pos, start, text)`` of WebVTT bodies: one row per cue, tags stripped, blanks and
    repeats of the cue before dropped."""
    blocks = F.split(F.regexp_replace(body, "\r", ""), r"\n{2,}")
    rows = bodies.select(key, F.posexplode(blocks).alias("pos", "block"))
    start = F.regexp_extract("block", r"((?:\d+:)?\d\d:\d\d\.\d{3}) --> ", 1)
    text = F.regexp_replace(F.regexp_extract("block", r"(?s) --> [^\n]*\n(.*)", 1), "<[^>]+>", "")
    cues = rows.select(key, "pos", start.alias("stamp"), F.trim(F.regexp_replace(text, r"\s+", " ")).alias("text")).where("stamp <> '' AND text <> ''")
    from loomcorpus.operators.analytics import without_repeats

    return without_repeats(cues, key, "pos", "text").select(key, "pos", X.cue_seconds(F.col("stamp")).alias("start"), "text")


def caption_choice(captions: DataFrame, key: str) -> DataFrame:
    """Per video the first English caption, else the first of any language."""
    rank = F.struct((F.col("lang") != "en").alias("other"), F.col("pos"))
    return captions.groupBy(key).agg(F.min_by(F.struct("lang", "path"), rank).alias("c")).select(key, "c.lang", "c.path")


SIDECAR = "source_type string, url string, page_timestamps map<string,double>, article_path string, zim_name string, zim_file string"


def sidecars(spark: SparkSession, root: str) -> DataFrame:
    """``(base, source_type, url, page_timestamps, ...)`` of ``<base>.meta.json`` and ``<base>/meta.json`` files; broken ones give nulls."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*meta.json").select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("raw"))
    meta = F.from_json("raw", SIDECAR)
    return raw.select(F.regexp_extract("p", r"([^/]+?)[./]meta\.json$", 1).alias("base"), meta.alias("m")).select("base", "m.*")


def with_sidecar(documents: DataFrame, meta: DataFrame, key: str = "hash") -> DataFrame:
    """Documents with what their sidecar states (null where there is none), as ``points.build`` reads it."""
    stated = meta.select(
        F.col("base").alias(key), F.col("source_type").alias("stated_type"), F.col("url").alias("stated_url"), F.col("article_path").alias("article"),
        F.col("zim_name").alias("archive"), F.col("zim_file").alias("archive_file"), "page_timestamps",
    )
    return documents.join(stated, key, "left")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; lines that are no JSON are dropped."""
    broken = "_corrupt_record"
    rows = spark.read.schema(f"{schema}, {broken} string").option("mode", "PERMISSIVE").json(path)
    return rows.where(F.col(broken).isNull()).drop(broken)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a plan: a JSON array of objects. The target is the sanitized path or else the proposed one."""
    schema = "hash string, current_path string, sanitized_path string, proposed_path string, sanitized_filename string, filename string, ambiguous boolean"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select(
        "hash", "current_path", F.coalesce("sanitized_path", "proposed_path").alias("target"), F.coalesce("sanitized_filename", "filename").alias("name"),
        F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"),
    )


def uploads(files: DataFrame, catalogue: DataFrame, waiting: DataFrame, allowed: list[str]) -> DataFrame:
    """``(filename, hash, action)`` of uploaded files (filename, content): only the allowed extensions, nothing
    empty, nothing that the catalogue or the hopper holds already, and of equal uploads the first name."""
    rows = files.select("filename", F.md5("content").alias("hash"), F.length("content").alias("size"))
    known = catalogue.select("hash").union(waiting.select("hash")).distinct().withColumn("known", F.lit(True))
    first = rows.groupBy("hash").agg(F.min("filename").alias("first"))
    out = rows.join(known, "hash", "left").join(first, "hash")
    ending = F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1))
    action = (
        F.when(~ending.isin([a.lower() for a in allowed]), "bad_type").when(F.col("size") == 0, "empty").when(F.col("known"), "duplicate")
        .when(F.col("first") < F.col("filename"), "duplicate").otherwise("accepted")
    )
    return out.select("filename", "hash", action.alias("action"))


def write_pages(pages: DataFrame, path: str, key: str = "hash", number: str = "page_no") -> None:
    """Pages as one Parquet table, the pages of a document next to each other and in order."""
    pages.repartitionByRange(key, number).sortWithinPartitions(key, number).write.mode("overwrite").parquet(path)


def write_report(plan: DataFrame, statistics: DataFrame, folder: str, top: DataFrame) -> None:
    """A plan as JSON lines, and beside it a Markdown report of its statistics (kind, value, n) and of the
    50 most frequent titles (title, n), which are all that comes to one task."""
    plan.write.mode("overwrite").json(f"{folder}/plan")
    line = lambda *cols: F.concat(F.lit("| "), F.concat_ws(" | ", *cols), F.lit(" |"))
    rows = statistics.select(F.lit(1).alias("part"), F.concat_ws(" ", "kind", "value").alias("name"), "n").unionByName(top.orderBy(F.desc("n"), "title").limit(50).select(F.lit(2).alias("part"), F.col("title").alias("name"), "n"))
    heads = plan.sparkSession.createDataFrame([(1, -1, "| what | n |"), (1, 0, "|-|-|"), (2, -1, "| title | n |"), (2, 0, "|-|-|")], "part int, at long, value string")
    body = rows.select("part", F.lit(1).cast("long").alias("at"), "n", "name", line("name", F.col("n").cast("string")).alias("value"))
    full = heads.withColumns({"n": F.lit(0).cast("long"), "name": F.lit("")}).unionByName(body)
    full.orderBy("part", "at", F.desc("n"), "name").coalesce(1).select("value").write.mode("overwrite").text(f"{folder}/report")
