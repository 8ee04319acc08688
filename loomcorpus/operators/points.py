"""Vector points: payloads built from concepts, documents and catalogue, upserts, filters and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.functions import text as X
from loomcorpus.functions import vectors as V
from loomcorpus.operators import state

# What every new point says of itself.
DEFAULTS = {"verification_status": "unverified", "credibility_score": 0.7, "language": "en"}
# The concept fields that a payload takes over.
FIELDS = [
    "content", "summary", "title", "domain", "subdomain", "keywords", "knowledge_type", "complexity", "key_facts", "scenario_applicable",
    "cross_domain_tags", "chapter", "page_ref", "notes", "_window", "_start_page",
]
#: Points from which an index is worth more than a scan of all vectors.
INDEX_FROM = 20_000
#: Values of a membership filter that are put into the plan; more are joined.
MAX_LISTED = 1000
_SAFE = "/:@!$&()*+,;=-._~"


def source_type(stated: Column, path: Column) -> Column:
    """What the sidecar states, else ``web`` for http paths, else ``document``."""
    return F.coalesce(F.nullif(stated, F.lit("")), F.when(path.rlike("^https?://"), "web").otherwise("document"))


def quoted(path: Column) -> Column:
    """``path`` percent-encoded, but for characters that have a meaning in paths."""
    out = F.replace(F.url_encode(path), F.lit("+"), F.lit("%20"))
    for c in _SAFE:
        if c not in "-._*":
            out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return out


def point_url(kind: Column, article: Column, archive: Column, archive_file: Column, path: Column, stated: Column, library_url: str, archive_url: str) -> Column:
    """An archive article's address, else one made from the path, else the stated one, else ''."""
    name = F.coalesce(F.nullif(archive, F.lit("")), F.regexp_replace(archive_file, r"\.zim$", ""), F.lit(""))
    in_archive = (kind == "zim") & (F.coalesce(article, F.lit("")) != "")
    return (
        F.when(in_archive, F.concat(F.lit(f"{archive_url}/content/"), name, F.lit("/"), quoted(article)))
        .when(F.coalesce(path, F.lit("")) != "", X.download_url(path, library_url)).otherwise(F.coalesce(stated, F.lit("")))
    )


def build(concepts: DataFrame, documents: DataFrame, catalogue: DataFrame, library_url: str, archive_url: str) -> DataFrame:
    """``(id, content, payload)`` of every concept that can be embedded.

    ``concepts``: doc_hash, idx, start_page, content and any of ``FIELDS``. ``documents``: hash, filename,
    path, book_title, book_author and, where they are known, stated_type, stated_url, article, archive and archive_file.
    ``catalogue``: hash, source. The id depends on hash, page and index alone, so building again overwrites.
    """
    optional = ["stated_type", "stated_url", "article", "archive", "archive_file"]
    docs = documents.select(
        F.col("hash").alias("doc_hash"), "filename", "path", "book_title", "book_author",
        *[(F.col(c) if c in documents.columns else F.lit(None).cast("string")).alias(c) for c in optional],
    )
    rows = concepts.withColumn("content", X.embeddable(F.col("content"))).where("content is not null").join(docs, "doc_hash")
    rows = rows.join(catalogue.select(F.col("hash").alias("doc_hash"), "source"), "doc_hash", "left")
    kind = source_type(F.col("stated_type"), F.col("path"))
    url = point_url(kind, *[F.col(c) for c in ("article", "archive", "archive_file", "path", "stated_url")], library_url, archive_url)
    own = [F.col(c) for c in FIELDS if c in concepts.columns]
    payload = F.struct(
        "doc_hash", "filename", F.coalesce("book_title", F.lit("")).alias("book_title"), F.coalesce("book_author", F.lit("")).alias("book_author"),
        F.coalesce("source", F.lit("")).alias("source"), url.alias("download_url"), kind.alias("source_type"), *[F.lit(v).alias(k) for k, v in DEFAULTS.items()], *own,
    )
    return rows.select(V.point_id(F.col("doc_hash"), F.col("start_page").cast("string"), F.col("idx").cast("string")).alias("id"), "content", payload.alias("payload"))


def hybrid(points: DataFrame, dense: str, indices: str | None = None, values: str | None = None) -> DataFrame:
    """Points with a dense vector and, where indices and values of equal number are there, a sparse one."""
    if indices is None:
        sparse = F.lit(None).cast("struct<indices:array<int>,values:array<float>>")
    else:
        whole = (F.size(indices) > 0) & (F.size(indices) == F.size(values))
        sparse = F.when(whole, F.struct(F.col(indices).cast("array<int>").alias("indices"), F.col(values).cast("array<float>").alias("values")))
    return points.withColumn("vector", F.struct(F.col(dense).alias("dense"), sparse.alias("sparse"))).drop(*{dense, indices, values} - {None})


def upsert(points: DataFrame, batch: DataFrame, id_col: str = "id", order: str | None = None) -> DataFrame:
    """``points`` with the rows of ``batch`` in place of those of the same id.

    Of rows of ``batch`` that repeat an id the one of greatest ``order`` wins, by default the greatest by its
    other columns (which then must be comparable: no maps). Rows without an id are not stored.
    """
    new = batch.where(F.col(id_col).isNotNull())
    rest = [c for c in batch.columns if c != id_col]
    last = state.last_wins(new, [id_col], order or rest[0]) if rest else new.distinct()
    return points.join(last.select(id_col), id_col, "left_anti").unionByName(last, allowMissingColumns=True)


def delete_payload(points: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """Points whose payload has lost the keys (unknown keys are ignored)."""
    known = [k for k in keys if k in points.schema[payload].dataType.names]
    return points.withColumn(payload, F.col(payload).dropFields(*known)) if known else points


def with_any(points: DataFrame, column: str, values: DataFrame | Sequence[str]) -> DataFrame:
    """Points whose scalar or list ``column`` holds any of the values: a list in the plan, or a table's first column."""
    listed = points.schema[column].dataType.simpleString().startswith("array")
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(values.columns[0]).alias("_wanted")).distinct()
        if not listed:
            return points.join(wanted, points[column] == wanted["_wanted"], "left_semi")
        # The lists that are met, not the rows, so rows need no number.
        lists = points.select(F.array_distinct(column).alias("_list")).distinct()
        met = lists.select("_list", F.explode("_list").alias("_wanted")).join(wanted, "_wanted", "left_semi").select("_list").distinct()
        return points.join(met, F.array_distinct(points[column]) == met["_list"], "left_semi")
    if len(values) > MAX_LISTED:
        raise ValueError(f"more than {MAX_LISTED} values: pass a table")
    wanted = F.array(*[F.lit(v) for v in values])
    return points.where(F.arrays_overlap(column, wanted) if listed else F.col(column).isin(list(values)))


def counts_of(points: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """``(value, n)``: the exact number of points with each of the values, 0 where there is none."""
    listed = points.schema[column].dataType.simpleString().startswith("array")
    rows = points.select((F.explode(F.array_distinct(column)) if listed else F.col(column)).alias("value")).where(F.col("value").isin(list(values)))
    asked = points.sparkSession.createDataFrame([(v,) for v in values], "value string")
    return asked.join(rows.groupBy("value").agg(F.count("*").alias("n")), "value", "left").select("value", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def index_type(n: Column) -> Column:
    return F.when(n >= INDEX_FROM, "HNSW").otherwise("brute-force")


def citation(book_title: Column, filename: Column, page: Column) -> Column:
    """The book's title, else one made from the file name, and the page: ``p. 7``, or as it is if it begins with ``p``."""
    title = F.coalesce(F.nullif(book_title, F.lit("")), X.title_from_filename(F.coalesce(filename, F.lit("Unknown"))))
    shown = F.when(F.startswith(page, F.lit("p")), page).otherwise(F.concat(F.lit("p. "), page))
    return F.when(F.coalesce(page, F.lit("")) == "", title).otherwise(F.concat(title, F.lit(", "), shown))


def shaped(found: DataFrame) -> DataFrame:
    """Search results as they are shown: defaults for what a payload lacks, the first 200 characters of
    the content for a missing summary, and the domain as a list."""

    def field(name: str, default: str = "") -> Column:
        return F.coalesce(F.col(name) if name in found.columns else F.lit(None).cast("string"), F.lit(default)).alias(name)

    kind = found.schema["domain"].dataType.simpleString()
    blank = F.array().cast("array<string>")
    domains = F.coalesce("domain", blank) if kind.startswith("array") else F.when(F.coalesce("domain", F.lit("")) == "", blank).otherwise(F.array("domain"))
    page = F.col("page_ref") if "page_ref" in found.columns else F.lit(None).cast("string")
    return found.select(
        "score", field("title", "Untitled"), F.coalesce("summary", F.left("content", F.lit(200)), F.lit("")).alias("summary"),
        citation(F.col("book_title"), F.col("filename"), page.cast("string")).alias("citation"), field("download_url"), field("source_type", "document"),
        field("knowledge_type"), field("complexity"), domains.alias("domains"),
    )


def purge(points: DataFrame, documents: DataFrame, junk: Column, doc_hash: str = "doc_hash") -> tuple[DataFrame, DataFrame]:
    """The points without those that ``junk`` holds for, and the documents with theirs marked ``skipped``."""
    gone = points.where(junk).select(F.col(doc_hash).alias("hash")).distinct()
    marked = documents.join(gone.withColumn("_gone", F.lit(True)), "hash", "left")
    status = F.when(F.col("_gone"), "skipped").otherwise(F.col("status"))
    return points.where(~F.coalesce(junk, F.lit(False))), marked.withColumn("status", status).select(*documents.columns)
