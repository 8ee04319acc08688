"""Keyed state: merges, status transitions, filters and listings over the catalogue and documents.

State is never updated in place. Every mutation is a projection or a keyed join that gives the
next version of a table, so it can be rerun, and a lost executor costs nothing but its tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from loomcorpus.operators.tables import fresh, with_prefix_sums

FLOW = ["queued", "extracting", "extracted", "enriching", "enriched", "embedding", "complete", "failed"]
ENDED = ["complete", "failed"]
#: The timestamp column that a status stamps.
STAMPS = {"extracted": "extracted_at", "enriched": "enriched_at", "complete": "embedded_at"}


def last_wins(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one of greatest ``order``; map-side combined, no window.

    A null order comes before all others. Rows of one key and order are told apart by the rest of
    their fields, the greatest in column order, so the result doesn't depend on how rows are dealt.
    Maps can't be compared; tables with such columns need an order without ties.
    """
    rest = [c for c in rows.columns if c not in keys]
    row = F.struct(order, F.struct(*rest).alias("_r"))
    plain = not any(isinstance(rows.schema[c].dataType, MapType) for c in rest)
    best = F.max(row) if plain else F.max_by(row, F.struct(F.col(order).isNotNull(), order))
    top = rows.groupBy(*keys).agg(best.alias("_t"))
    return top.select(*keys, *[F.col(f"_t._r.`{c}`").alias(c) for c in rest]).select(*rows.columns)


def catalogue_upsert(current: DataFrame, batch: DataFrame, as_of: Column, order: str | None = None) -> DataFrame:
    """Insert new hashes; for known ones take path, filename, source and category, and stamp
    ``path_updated_at`` only where the path changed. Of rows that repeat a hash in ``batch`` the one of greatest
    ``order`` wins (none named: the greatest by its fields), as if they came one after the other; rows without a hash are ignored."""
    fields = ["filename", "path", "source", "category"]
    new = last_update(batch, ["hash"], [*fields, "size_bytes"], order).select("hash", F.struct(*fields, "size_bytes").alias("new"))
    old = current.select("hash", F.struct(*[c for c in current.columns if c != "hash"]).alias("old"))
    met = old.join(new, "hash", "full_outer")
    moved = F.col("new").isNotNull() & F.col("old").isNotNull() & (F.col("old.path") != F.col("new.path"))
    stamp = F.col("old.path_updated_at") if "path_updated_at" in current.columns else F.lit(None).cast("timestamp_ntz")
    return met.select(
        "hash", *[F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in fields],
        F.coalesce("old.size_bytes", "new.size_bytes").alias("size_bytes"), F.when(moved, as_of).otherwise(stamp).alias("path_updated_at"),
    )


def first_wins(current: DataFrame, batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows of ``batch`` whose key is new, the first of each by ``order`` (null first; ties by the other fields)."""
    rest = [c for c in batch.columns if c not in keys]
    new = batch.join(current.select(*keys), list(keys), "left_anti").groupBy(*keys).agg(F.min(F.struct(order, F.struct(*rest).alias("_r"))).alias("_t"))
    return new.select(*keys, *[F.col(f"_t._r.`{c}`").alias(c) for c in rest])


def queue(catalogue: DataFrame, documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted hash whether it is known, and the status its document has afterwards.

    A new document starts queued; an existing one keeps its status.
    """
    known = catalogue.select("hash", F.lit(True).alias("known"))
    out = wanted.select("hash").distinct().join(known, "hash", "left").join(documents.select("hash", "status"), "hash", "left")
    ok = F.coalesce("known", F.lit(False))
    return out.select("hash", ok.alias("queued"), F.when(ok, F.coalesce("status", F.lit("queued"))).alias("status"))


def transition(rows: DataFrame, to: Column | str, as_of: Column, **changes: Column) -> DataFrame:
    """Set ``status`` and further columns, and stamp the column that belongs to the new status."""
    status = F.lit(to) if isinstance(to, str) else to
    stamps = {c: F.when(status == s, as_of).otherwise(F.col(c)) for s, c in STAMPS.items() if c in rows.columns}
    return rows.withColumns({"status": status} | stamps | changes)


def mark_failed(rows: DataFrame, message: Column) -> DataFrame:
    return rows.withColumns({"status": F.lit("failed"), "error_message": F.left(message, F.lit(1000))})


def retry(rows: DataFrame) -> DataFrame:
    """Failed rows go back to the queue with one more retry and no message; others stay."""
    failed = F.col("status") == "failed"
    out = rows.withColumn("retry_count", F.when(failed, F.col("retry_count") + 1).otherwise(F.col("retry_count")))
    if "error_message" in rows.columns:
        out = out.withColumn("error_message", F.when(~failed, F.col("error_message")))
    return out.withColumn("status", F.when(failed, "queued").otherwise(F.col("status")))


def append_ids(existing: DataFrame, rows: DataFrame, order: Sequence[str], id_col: str = "id") -> DataFrame:
    """``rows`` with gapless new ids after the greatest existing one, in ``order`` (which must be unique).

    Ids come from per-partition counts of stored ranges, so no task numbers all rows.
    """
    rank = fresh(rows, "rank")
    top = fresh(rows, "top")
    ranked = with_prefix_sums(rows, order, rank=rank)
    out = ranked.crossJoin(F.broadcast(existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias(top))))  # one row
    own = [F.col(f"`{c}`") for c in rows.columns if c != id_col]
    return out.select(*own, (F.col(top) + F.col(rank) + 1).alias(id_col))


def set_payload(points: DataFrame, updates: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Points with the non-null fields of the update of their key; fields without one stay.

    Of updates that repeat a key ``last_update`` chooses one; a null key updates nothing.
    """
    new = last_update(updates, [key], fields).select(key, F.struct(*fields).alias(fresh(points, "update")))
    update = new.columns[1]
    out = points.join(new, key, "left")
    return out.select(*[F.coalesce(F.col(f"{update}.`{c}`"), F.col(f"`{c}`")).alias(c) if c in fields else F.col(f"`{c}`") for c in points.columns])


def last_update(updates: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str | None = None) -> DataFrame:
    """One row for each key: the update of greatest ``order``, by default of greatest fields from left to right.

    Without an order there is no last one among updates of a key, so the choice is only made the same
    whatever the partitions. Rows with a null key update nothing.
    """
    row = F.struct(*([order] if order else []), *fields)
    known = updates.where(" and ".join(f"`{k}` is not null" for k in keys))
    return known.groupBy(*keys).agg(F.max(row).alias("_row")).select(*keys, *[F.col(f"_row.`{f}`").alias(f) for f in fields])


def delete_keys(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return rows.join(gone.select(key), key, "left_anti").select(*rows.columns)


def cascade_delete(tables: dict[str, DataFrame], gone: DataFrame, key: str) -> dict[str, DataFrame]:
    """Every table without the rows of the removed keys."""
    return {name: delete_keys(df, gone, key) for name, df in tables.items()}


def reverse_operation(operations: DataFrame) -> DataFrame:
    """The inverse rows of operations that aren't reversed yet."""
    rows = operations.where(~F.col("is_reversed"))
    return rows.withColumns({"source_path": F.col("target_path"), "target_path": F.col("source_path")})


def listing(rows: DataFrame, where: Sequence[Column] = (), order: Sequence[Column] = (), limit: int | None = None, offset: int = 0) -> DataFrame:
    """Any conditions, an order and a page; conditions on partition or row-group statistics reach the scan."""
    for condition in where:
        rows = rows.where(condition)
    if order:
        rows = rows.orderBy(*order)
    if offset:
        rows = rows.offset(offset)
    return rows if limit is None else rows.limit(limit)


def page_bounds(total: Column, page: Column, size: int) -> list[Column]:
    """Number of pages (at least 1) and the page clamped into them."""
    pages = F.greatest(F.lit(1), F.ceil(total / size)).cast("long")
    return [pages.alias("total_pages"), F.least(F.greatest(page, F.lit(1)), pages).cast("long").alias("page")]


def is_web(path: str = "path") -> Column:
    return F.col(path).ilike("http%")


def document_type(path: str = "path", source: str = "source") -> Column:
    """transcript, wiki, web or pdf, by source first, then by path."""
    return (
        F.when(F.col(source) == "transcripts", "transcript").when(F.col(source) == "wiki", "wiki").when(is_web(path), "web").otherwise("pdf")
    )


def stale(rows: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    """Enriching rows whose extraction is older than ``hours``, missing or unreadable go back to extracted."""
    at = F.try_to_timestamp(F.col("extracted_at").cast("string"))
    old = F.coalesce(at < as_of - F.expr(f"INTERVAL {hours} HOURS"), F.lit(True))
    return rows.withColumn("status", F.when((F.col("status") == "enriching") & old, "extracted").otherwise(F.col("status")))


def sync_paths(documents: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Documents with their catalogue path and file name, and the flag of a path change cleared."""
    new = catalogue.select("hash", F.col("path").alias("_path"), F.col("filename").alias("_filename"))
    out = documents.join(new, "hash", "left")
    flag = F.when(F.col("_path").isNull(), F.col("path_updated_at"))
    return out.withColumns({"path": F.coalesce("_path", "path"), "filename": F.coalesce("_filename", "filename"), "path_updated_at": flag}).select(*documents.columns)


def mark_organized(rows: DataFrame, where: Column, as_of: Column) -> DataFrame:
    return rows.withColumn("organized_at", F.when(where, as_of).otherwise(F.col("organized_at")))


def clear_organized(rows: DataFrame, where: Column) -> DataFrame:
    """The reverse of an operation takes the mark off."""
    return rows.withColumn("organized_at", F.when(~F.coalesce(where, F.lit(False)), F.col("organized_at")))
