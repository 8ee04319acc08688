"""Library planning: target paths, the collision ladder, sweep classification and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcorpus.functions.names import extension, library_name, sanitized, stem
from loomcorpus.functions.text import author_last_name, blank_to_null, folder_name, garbage_title, last_year, strip
from loomcorpus.operators.tables import fresh, scratch, stored, with_prefix_sums

NAME_LIMIT = 120


def capped_name(stem: Column, suffix: Column, extension: str = ".pdf") -> Column:
    """``stem`` cut so that stem, suffix and extension fit the name limit."""
    room = F.lit(NAME_LIMIT - len(extension)) - F.length(suffix)
    return F.concat(F.left(stem, room), suffix, F.lit(extension))


def resolve_collisions(rows: DataFrame, folder: str, name: str, key: str, order: str) -> DataFrame:
    """Within a folder the first bearer of a name (whatever the case) keeps it, others get `` [key6]``."""
    place = F.row_number().over(Window.partitionBy(folder, F.lower(name)).orderBy(order))
    stem = F.regexp_replace(name, r"\.pdf$", "")
    suffix = F.concat(F.lit(" ["), F.left(key, F.lit(6)), F.lit("]"))
    return rows.withColumn("final_name", F.when(place == 1, F.col(name)).otherwise(capped_name(stem, suffix)))


def ladder(files: DataFrame, existing: DataFrame, author_first: bool = False) -> DataFrame:
    """The first free name for each file: title, title_author, title_author_year, else review (step 4).

    ``files``: hash, folder, title, author, year. ``existing``: folder, name, hash. A name that
    belongs to the same hash counts as free. With ``author_first``, files that have an author begin
    with the second name.
    """
    title, author, year = F.col("title"), F.col("author"), F.col("year")
    names = {
        1: F.when(author.isNull(), title) if author_first else title,
        2: F.when(author.isNotNull(), F.concat_ws("_", title, author)),
        3: F.when(author.isNotNull() & year.isNotNull(), F.concat_ws("_", title, author, year.cast("string"))),
    }
    out = files
    for step, name in names.items():
        taken = existing.groupBy("folder", F.col("name").alias(f"_name{step}")).agg(F.min("hash").alias(f"_by{step}"))
        out = out.withColumn(f"_name{step}", F.concat(name, F.lit(".pdf"))).join(taken, ["folder", f"_name{step}"], "left")
    step = F.lit(4)
    for i in (3, 2, 1):
        free = F.col(f"_name{i}").isNotNull() & (F.col(f"_by{i}").isNull() | (F.col(f"_by{i}") == F.col("hash")))
        step = F.when(free, i).otherwise(step)
    target = F.when(step == 1, F.col("_name1")).when(step == 2, F.col("_name2")).when(step == 3, F.col("_name3"))
    return out.select("hash", "folder", step.cast("int").alias("step"), target.alias("name"))


def target_folder(root: str, domain: Column, subdomain: Column) -> Column:
    """``root/Domain/Subdomain``; ``General`` without a subdomain, null without a domain."""
    inner = F.when(blank_to_null(subdomain).isNull(), "General").otherwise(folder_name(subdomain))
    return F.when(domain.isNotNull(), F.concat(F.lit(f"{root}/"), folder_name(domain), F.lit("/"), inner))


def with_planned_name(rows: DataFrame, book_title: str, filename: str, doc_hash: str, name: str = "name") -> DataFrame:
    """``rows`` with the library name of the title, else of the file name, else the file name itself.

    A name is made once for each row; only where a title gives none is it made again.
    """
    titled = F.concat(F.nullif(F.col(book_title), F.lit("")), F.lit(".pdf"))
    rows = rows.withColumn("_source", F.coalesce(titled, F.col(filename)))
    with scratch(rows.sparkSession):
        # Stored, so that the long name expressions are planned and computed once.
        first = stored(rows.withColumn(name, library_name(F.col("_source"), F.col(doc_hash))), "named")
        again = first.where(F.col(name).isNull() & (F.col("_source") != F.col(filename)))
        again = again.withColumn(name, library_name(F.col(filename), F.col(doc_hash)))
        out = first.where(F.col(name).isNotNull() | F.coalesce(F.col("_source") == F.col(filename), F.lit(True))).unionByName(again)
        return stored(out.withColumn(name, F.coalesce(name, filename)).drop("_source"), "planned", scope=2)


def sweep_plan(files: DataFrame, documents: DataFrame, domains: DataFrame, root: str) -> DataFrame:
    """``(hash, path, action, folder, name, step)``: what a sweep does with every file.

    ``files``: hash, path. ``documents``: hash, status, filename, book_title, book_author. ``domains``:
    hash, domain, subdomain. Files that are not catalogued go to ``_acquired``, those without a
    domain to ``_unclassified``; relocated files with an author begin with the name that has it. Names are
    checked against the files as they are now, so two plans can meet; that shows when a slice is run.
    """
    rows = files.join(documents.withColumnRenamed("filename", "own_name"), "hash", "left").join(domains, "hash", "left")
    base = F.element_at(F.split("path", "/"), -1)
    rows = rows.withColumns({"folder": target_folder(root, F.col("domain"), F.col("subdomain")), "_file": F.coalesce("own_name", base)})
    rows = with_planned_name(rows, "book_title", "_file", "hash").drop("_file")
    action = sweep_action(F.col("status"), garbage_title(F.col("book_title")), F.col("domain"), F.col("path"), F.concat("folder", F.lit("/"), F.col("name")))
    rows = rows.withColumn("action", action)
    moving = rows.where("action = 'relocate'")
    year = last_year(F.col("own_name"), F.col("book_title"))
    wanted = moving.select("hash", "folder", stem(F.col("name")).alias("title"), author_last_name(F.col("book_author")).alias("author"), year.alias("year"))
    there = files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), base.alias("name"), "hash")
    placed = ladder(wanted, there, author_first=True).select("hash", "step", F.col("name").alias("final"))
    out = rows.join(placed.dropDuplicates(["hash"]), "hash", "left")
    aside = F.when(F.col("action") == "rescue", f"{root}/_acquired").when(F.col("action") == "unclassified", f"{root}/_unclassified")
    goes = F.col("action").isin("rescue", "unclassified", "relocate")
    folder = F.when(goes, F.coalesce(aside, F.col("folder")))
    name = F.when(F.col("action") == "rescue", base).when(goes, F.coalesce("final", "name"))
    return out.select("hash", "path", "action", folder.alias("folder"), name.alias("name"), "step")


def sweep_statistics(plan: DataFrame) -> DataFrame:
    """``(kind, value, n)``: the actions and collision steps of a plan, in one pass."""
    pairs = F.array(F.struct(F.lit("action").alias("kind"), F.col("action").alias("value")), F.struct(F.lit("step").alias("kind"), F.col("step").cast("string").alias("value")))
    return plan.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").groupBy("kind", "value").agg(F.count("*").alias("n"))


def organise_action(domain: Column, current: Column, target: Column, known: Column) -> Column:
    """What organising one document does (dry run)."""
    return F.when(~known, "skip").when(domain.isNull(), "skip_unclassified").when(target == current, "already_organized").otherwise("would_move")


def manifest_action(target: Column, name: Column, ambiguous: Column, current: Column, exists: Column) -> Column:
    """What a manifest entry comes to: entries without a target or marked ambiguous are skipped."""
    return (
        F.when(blank_to_null(target).isNull() | blank_to_null(name).isNull() | F.coalesce(ambiguous, F.lit(False)), "skipped").when(target == current, "already_organized")
        .when(~F.coalesce(exists, F.lit(False)), "not_found").otherwise("moved")
    )


def filing_target(root: str, domain: Column, subdomain: Column, filename: Column, doc_hash: Column, source: Column) -> Column:
    """Where a processed item is filed: its portable name with the extension of the source file."""
    name = sanitized(filename, doc_hash)
    end = F.lower(extension(F.element_at(F.split(source, "/"), -1)))
    return F.concat(target_folder(root, domain, subdomain), F.lit("/"), F.when(end == "", name).otherwise(F.concat(stem(name), end)))


def filing_action(exists: Column, domain: Column, known: Column, source: Column, target: Column) -> Column:
    return (
        F.when(~exists, "error").when(domain.isNull(), "skip_unclassified").when(~known, "error").when(source == target, "skip_already_filed").otherwise("would_file")
    )


def acquire_action(status: Column) -> Column:
    """The first phase of an ingest: files of a complete document are duplicates, all others are acquired."""
    return F.when(F.coalesce(status, F.lit("")) == "complete", "duplicate").otherwise("acquired")


def place_action(path: Column, ingest: str, domain: Column, pilot: str | None, step: Column) -> Column:
    """The second phase: only from the ingest folder, only the pilot domain if there is one, and a file that
    finds no free name is queued for review."""
    other = F.lit(False) if pilot is None else domain != pilot
    return (
        F.when(blank_to_null(path).isNull(), "error").when(~F.contains(path, F.lit(ingest)), "skip_not_ingest").when(domain.isNull(), "skip_unclassified")
        .when(other, "skip_wrong_domain").when(step == 4, "duplicate_review").otherwise("placed")
    )


def migration_stat(known: Column, domain: Column, wanted: str, path: Column, folder: Column, name: Column, step: Column) -> Column:
    """What a domain's migration does with a file (dry run): moved, or only renamed within its folder."""
    here = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return (
        F.when(~known, "not_catalogued").when(~F.equal_null(domain, F.lit(wanted)), "domain_mismatch").when(path == F.concat(folder, F.lit("/"), name), "already_correct")
        .when(step == 4, "duplicates").when(here == folder, "renamed").otherwise("moved")
    )


def book_action(readable: Column, size_mb: Column, largest_mb: float, pages: Column, known: Column, same_book: Column) -> Column:
    """Where an unread book goes: rejected, a duplicate by hash, over the size limit or empty, a duplicate by its metadata, or in."""
    return (
        F.when(~readable, "rejected").when(known, "duplicate").when(size_mb > largest_mb, "content_failure").when(pages == 0, "skip_empty")
        .when(same_book, "level4_duplicate").otherwise("accepted")
    )


def repair_action(valid: Column, source: Column) -> Column:
    """What is to be done with a concept window that may be broken."""
    return F.when(valid, "already_valid").when(blank_to_null(source).isNull(), "no_source_text").otherwise("would_repair")


def sweep_action(status: Column, title_is_garbage: Column, domain: Column, current: Column, target: Column) -> Column:
    """What a sweep does with a file on disk; a null status means it is not catalogued."""
    return (
        F.when(status.isNull(), "rescue")
        .when(status.isin("queued", "extracting", "enriching", "embedding"), "skip_in_progress")
        .when(status == "failed", "skip_failed")
        .when(status != "complete", "skip_other_status")
        .when(title_is_garbage, "skip_garbage")
        .when(domain.isNull(), "unclassified")
        .when(target == current, "no_op")
        .otherwise("relocate")
    )


def verify_action(target_exists: Column, source_exists: Column, db_path: Column, target: Column) -> Column:
    return (
        F.when(~target_exists, "target_missing").when(source_exists, "source_still_exists").when(~F.equal_null(db_path, target), "db_path_mismatch").otherwise("ok")
    )


def path_check(path: Column, target: Column) -> Column:
    """Whether a document lies where its last operation put it; a null path is of an unknown document."""
    return F.when(path.isNull(), "unknown").when(path == target, "ok").otherwise("path_mismatch")


def verify(operations: DataFrame, there: DataFrame, documents: DataFrame) -> DataFrame:
    """``operations`` (hash, source, target) with ``result``: the files that are there (path) and the
    documents' paths (hash, path) against what the operation should have left."""
    paths = there.select("path").distinct()
    out = operations.join(paths.select(F.col("path").alias("target"), F.lit(True).alias("_target")), "target", "left")
    out = out.join(paths.select(F.col("path").alias("source"), F.lit(True).alias("_source")), "source", "left")
    out = out.join(documents.select("hash", F.col("path").alias("_db")), "hash", "left")
    no = F.lit(False)
    result = verify_action(F.coalesce("_target", no), F.coalesce("_source", no), F.col("_db"), F.col("target"))
    return out.withColumn("result", result).drop("_target", "_source", "_db")


def plan_slice(plan: DataFrame, order: str, start: int, size: int) -> DataFrame:
    """Rows ``start`` to ``start + size`` of a plan in order.

    The ranks come from counts of ranges, so a deep slice sorts no more than its ranges.
    """
    rank = fresh(plan, "rank")
    return with_prefix_sums(plan, [order], rank=rank).where(F.col(rank).between(start, start + size - 1)).drop(rank)


def rejects(files: DataFrame, readable: Column, reason: Column, review: str, path: str = "path", meta: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The files that can be read, and those that can't as a side table: ``(path, reason, review_path, removed_meta)``, where a
    file is to be kept for review, why, and the sidecar that goes. A file of which nobody knows whether it can be read is a reject."""
    ok = F.coalesce(readable, F.lit(False))
    target = F.concat(F.lit(f"{review}/"), F.element_at(F.split(path, "/"), -1))
    sidecar = F.col(meta) if meta else F.lit(None).cast("string")
    return files.where(ok), files.where(~ok).select(F.col(path).alias("path"), F.coalesce(reason, F.lit("unreadable")).alias("reason"), target.alias("review_path"), sidecar.alias("removed_meta"))


def ingestion_decision(captions: Column, text: Column, known: Column) -> Column:
    return F.when(~captions, "none").when(F.length(strip(text)) < 50, "too_short").when(known, "duplicate").otherwise("extracted")


def missing_artefacts(status: Column, has_text: Column, has_concepts: Column) -> Column:
    """The artefact a status promises that is not there, or null."""
    needs_text = status.isin("extracted", "enriching", "enriched", "embedding", "complete")
    needs_concepts = status.isin("enriched", "embedding", "complete")
    return F.when(needs_text & ~has_text, "text_missing").when(needs_concepts & ~has_concepts, "concepts_missing")
