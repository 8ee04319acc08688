"""Articles of archives, page texts and the gates they pass, over landed tables of paths and HTML."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcorpus.functions import text as X
from loomcorpus.functions.markup import html_text

# Language codes that mark translated articles (all but English).
LANGUAGES = (
    "aa ab af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el eo es et eu fa ff fi fj fo fr fy "
    "ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv "
    "mg mh mi mk ml mn mo mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw "
    "sa sc sd se sg sh si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()
#: Characters below which an article is a stub.
STUB = 200


def path_language(path: Column) -> Column:
    """The language code at the end of a path, null where it ends in none of ``LANGUAGES``."""
    code = F.regexp_extract(path, "/([a-z]{2,3})$", 1)
    return F.when(code.isin(LANGUAGES), code)


def landed(entries: DataFrame) -> DataFrame:
    """Container entries as ``article_actions`` takes them: HTML as text, of which broken bytes are replaced; other content is left out."""
    html = F.when(F.col("mimetype") == "text/html", F.make_valid_utf8(F.col("content").cast("string")))
    return entries.select("archive", "path", "title", "mimetype", "redirect", html.alias("html"))


def ruled_out(entries: DataFrame, seen: DataFrame) -> DataFrame:
    """Every archive entry with ``early``, why it is ruled out before its text is read: redirects, other types and paths
    seen before are ``ignored``, then translations ``foreign``; null for the others."""
    plain = ~F.coalesce("redirect", F.lit(False)) & (F.col("mimetype") == "text/html")
    known = seen.select("path", F.lit(True).alias("_seen")).distinct()
    live = F.coalesce(plain, F.lit(False)) & F.col("_seen").isNull()
    early = F.when(~live, "ignored").when(path_language(F.col("path")).isNotNull(), "foreign")
    return entries.join(known, "path", "left").withColumn("early", early).drop("_seen")


def article_actions(entries: DataFrame, seen: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``(path, title, action, hash, content)`` of every archive entry.

    ``entries``: path, title, mimetype, redirect, html; ``seen``: path; ``catalogue``: hash. The first that
    fits: ``ignored`` and ``foreign`` as in ``ruled_out``; then ``stub``, and
    ``duplicate`` of the catalogue or of an entry with a smaller path; else ``article``.
    """
    # Python gets the pages that are read, and nulls for the others.
    live = ruled_out(entries, seen).withColumn("content", html_text(F.when(F.col("early").isNull(), F.col("html"))))
    live = live.withColumn("hash", F.when(F.length("content") >= STUB, F.md5("content")))
    first = live.where("hash is not null").groupBy("hash").agg(F.min("path").alias("_first"))
    live = live.join(first, "hash", "left").join(catalogue.select("hash", F.lit(True).alias("_known")).distinct(), "hash", "left")
    action = F.when(F.col("early").isNotNull(), F.col("early")).when(F.col("hash").isNull(), "stub").when(F.col("_known") | (F.col("_first") < F.col("path")), "duplicate").otherwise("article")
    return live.select("path", "title", action.alias("action"), "hash", "content")


def article_pages(articles: DataFrame, budget: int = 2000) -> DataFrame:
    """``(hash, page_no, text)`` of the kept articles."""
    pages = F.posexplode(X.chunk_pages(F.col("content"), budget)).alias("pos", "text")
    return articles.where("action = 'article'").select("hash", pages).select("hash", (F.col("pos") + 1).alias("page_no"), "text")


def archive_metadata(own: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Archives with what they say of themselves, else what their catalogue says; articles are counted from ``counter``."""
    both = own.join(listed.select(key, *[F.col(c).alias(f"_{c}") for c in ("title", "description", "language")]), key, "left")
    count = F.coalesce(F.try_element_at(X.counter_map(F.col("counter")), F.lit("text/html")), F.lit(0))
    return both.select(key, *[F.coalesce(c, f"_{c}").alias(c) for c in ("title", "description", "language")], count.cast("long").alias("article_count"))


def effective_status(status: Column, documents: Column, in_pipeline: Column) -> Column:
    """A complete archive is processing while its documents are; one that is ingested is extracting."""
    return F.when((status == "complete") & (documents > 0) & (in_pipeline > 0), "processing").when(status == "ingesting", "extracting").otherwise(status)


def archive_states(archives: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """``archives`` (key, status, article_count, processed) with in_pipeline and effective_status, from the documents' key and status."""
    live = F.count_if(~F.col("status").isin("complete", "failed"))
    counts = documents.groupBy(key).agg(F.count("*").alias("documents"), live.alias("in_pipeline"))
    out = archives.join(counts, key, "left").fillna(0, ["documents", "in_pipeline"])
    return out.withColumn("effective_status", effective_status(F.col("status"), F.col("documents"), F.col("in_pipeline")))


def archive_totals(states: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return states.agg(F.count("*").alias("archives"), total("article_count"), total("processed"), total("in_pipeline"))


def language_allowed(sample: Column, lang: Column, allowed: Sequence[str], least: int = 50) -> Column:
    """Whether a text passes: its first page too short or its language unknown, or in ``allowed``."""
    return F.coalesce((F.length(X.strip(F.left(sample, F.lit(1500)))) < least) | lang.isin(list(allowed)), F.lit(True))


def window_concepts(text: Column, concepts: Column, least: int = 50) -> Column:
    """The concepts of a window; none for a window of under ``least`` characters."""
    return F.when(F.length(X.strip(text)) < least, F.slice(concepts, 1, 0)).otherwise(concepts)


def size_action(size_bytes: Column, largest_mb: float) -> Column:
    return F.when(size_bytes / 1048576 <= largest_mb, "accept").otherwise("reject")


def best_text(candidates: DataFrame, key: str, place: str, text: str, method: str, usable: Column) -> DataFrame:
    """``(key, method, text)``: of the candidates in order the first usable one, else the longest (ties: the first)."""
    rank = F.struct((~F.coalesce(usable, F.lit(False))).alias("bad"), F.when(usable, F.col(place)).otherwise(-F.coalesce(F.length(text), F.lit(0))).alias("by"), F.col(place).alias("p"))
    best = candidates.groupBy(key).agg(F.min(F.struct(rank.alias("rank"), F.col(method).alias("method"), F.col(text).alias("text"))).alias("b"))
    return best.select(key, F.col("b.method").alias("method"), F.col("b.text").alias("text"))


def retried_text(first: Column, second: Column, usable: Column) -> Column:
    """The first reading if usable, else the second if it is at least as long."""
    longer = F.length(second) >= F.coalesce(F.length(first), F.lit(0))
    return F.when(F.coalesce(usable, F.lit(False)), first).when(F.coalesce(longer, F.lit(False)), second).otherwise(first)


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The starts of each document's pages in its full text, every page looked for behind the one before."""
    for batch in batches:
        starts = []
        for full, heads in zip(batch.column("full").to_pylist(), batch.column("heads").to_pylist(), strict=True):
            at, own = 0, []
            for head in heads:
                found = full.find(head, at) if full is not None and head else -1
                own.append(found if found >= 0 else at)
                at = own[-1] + len(head or "")
            starts.append(own)
        yield pa.record_batch([batch.column("key"), batch.column("numbers"), pa.array(starts, pa.list_(pa.int32()))], names=["key", "numbers", "starts"])


def page_starts(pages: DataFrame, full: DataFrame, key: str, number: str, text: str) -> DataFrame:
    """``(key, number, start)``: where each page begins in the full text (``full``) of its key.

    Pages are looked for by their first 200 characters, each behind the one before; a page that isn't
    found starts where the last one found ended. A full text is searched once, from its begin to its end.
    """
    head = X.strip(F.left(F.coalesce(F.col(text), F.lit("")), F.lit(200)))
    listed = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), head.alias("head")))).alias("pages"))
    rows = full.join(listed, key).select(F.col(key).alias("key"), "full", F.col("pages.n").alias("numbers"), F.col("pages.head").alias("heads"))
    kinds = f"key {full.schema[key].dataType.simpleString()}, numbers array<{pages.schema[number].dataType.simpleString()}>, starts array<int>"
    placed = rows.mapInArrow(_located, kinds).select("key", F.explode(F.arrays_zip("numbers", "starts")).alias("p"))
    return placed.select(F.col("key").alias(key), F.col("p.numbers").alias(number), F.col("p.starts").alias("start"))


def new_windows(fresh: DataFrame, existing: DataFrame, keys: Sequence[str] = ("hash", "window")) -> DataFrame:
    """The windows to write: a window that is there is never written again; of repeated new ones the first by content stays."""
    rest = [c for c in fresh.columns if c not in keys]
    new = fresh.join(existing.select(*keys), list(keys), "left_anti")
    return new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def document_concepts(windows: DataFrame, key: str, number: str, concepts: str) -> DataFrame:
    """``(key, idx, concept)``: all concepts of a document, counted on through its windows in order."""
    sized = windows.withColumn("_n", F.coalesce(F.size(concepts), F.lit(0)))
    before = Window.partitionBy(key).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    sized = sized.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    each = sized.select(key, "_before", F.posexplode(concepts).alias("_pos", "concept"))
    return each.select(key, (F.col("_before") + F.col("_pos")).cast("long").alias("idx"), "concept")


def remaining(plan: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is left of a plan after the ids of its checkpoint."""
    return plan.join(done.select(key).distinct(), key, "left_anti")


def orphans(artefacts: DataFrame, documents: DataFrame, key: str = "hash") -> DataFrame:
    """Artefacts (key, kind) of no document."""
    return artefacts.join(documents.select(key), key, "left_anti")


def validation(documents: DataFrame, artefacts: DataFrame, windows: DataFrame, key: str = "hash") -> DataFrame:
    """``(key, issue)``: every fault of the pipeline's artefacts; no rows mean that it passes.

    ``artefacts``: key, kind (``text`` or ``concepts``); ``windows``: key, valid. Documents miss what their
    status promises, windows are broken, and artefacts belong to no document.
    """
    from loomcorpus.operators.library import missing_artefacts

    has = artefacts.groupBy(key).agg(F.bool_or(F.col("kind") == "text").alias("_text"), F.bool_or(F.col("kind") == "concepts").alias("_concepts"))
    no = F.lit(False)
    issue = missing_artefacts(F.col("status"), F.coalesce("_text", no), F.coalesce("_concepts", no))
    missing = documents.join(has, key, "left").select(key, issue.alias("issue")).where("issue is not null")
    broken = windows.where(~F.coalesce("valid", no)).select(key, F.lit("bad_window").alias("issue")).distinct()
    lost = orphans(artefacts, documents, key).select(key, F.concat(F.lit("orphan_"), F.col("kind")).alias("issue")).distinct()
    return missing.unionByName(broken).unionByName(lost)


def health(components: DataFrame, vital: str = "storage") -> DataFrame:
    """``(status)`` of components (name, up): unhealthy if the vital one is down, degraded if another is."""
    down = ~F.coalesce("up", F.lit(False))
    bad = F.coalesce(F.bool_or(down & (F.col("name") == vital)), F.lit(False))
    return components.agg(F.when(bad, "unhealthy").when(F.coalesce(F.bool_or(down), F.lit(False)), "degraded").otherwise("healthy").alias("status"))
