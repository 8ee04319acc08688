"""Aggregates, votes, facets and ordered-row operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcorpus.operators import tables

#: Rows of a dictionary that are broadcast at most.
MAX_SENT = 100_000


def breakdown(rows: DataFrame, keys: Sequence[str], **sums: str) -> DataFrame:
    """Row count and sums per key combination."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()])


def state_counts(rows: DataFrame, status: str = "status") -> list[Column]:
    """Global conditional counts of complete, failed and in-pipeline rows."""
    s = F.col(status)
    return [
        F.count("*").alias("total"), F.count_if(s == "complete").alias("complete"), F.count_if(s == "failed").alias("failed"),
        F.count_if(~s.isin("complete", "failed")).alias("in_pipeline"),
    ]


def call_cost(tokens_in: Column, tokens_out: Column, rate_in: float, rate_out: float) -> Column:
    """Price of a model call; rates are for a million tokens."""
    return (tokens_in * rate_in + tokens_out * rate_out) / 1_000_000


def backlog(counts: Column, waiting: Sequence[str]) -> Column:
    """The sum of a state-to-count map over the states that still wait."""
    held = F.map_filter(counts, lambda k, v: k.isin(list(waiting)))
    return F.aggregate(F.map_values(held), F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x, F.lit(0)))


def bucket(status: Column, groups: dict[str, Sequence[str]], otherwise: str) -> Column:
    """The first group that lists the status."""
    out = F.lit(otherwise)
    for name, members in reversed(groups.items()):
        out = F.when(status.isin(list(members)), name).otherwise(out)
    return out


def throughput(done: Column, total: Column, seconds: Column) -> Column:
    """``struct(per_second, remaining_seconds)``; null while nothing is done."""
    rate = F.when((done > 0) & (seconds > 0), done / seconds)
    return F.struct(rate.alias("per_second"), ((total - done) / rate).alias("remaining_seconds"))


def folder_statistics(files: DataFrame, folder: str = "folder", name: str = "filename", size: str = "size_bytes", kinds: Sequence[str] = ("mp4", "webm", "mkv")) -> DataFrame:
    """``(folder, files, bytes, of_kinds, extensions)``: of each folder its files, their bytes, how many have an extension of ``kinds``,
    and the number for each extension (lower-case; '' for none)."""
    ending = F.lower(F.regexp_extract(F.col(name), r"\.([^./]+)$", 1))
    each = files.groupBy(folder, ending.alias("_x")).agg(F.count("*").alias("_n"), F.coalesce(F.sum(size), F.lit(0)).alias("_b"))
    return each.groupBy(folder).agg(
        F.sum("_n").alias("files"), F.sum("_b").alias("bytes"), F.coalesce(F.sum(F.when(F.col("_x").isin(list(kinds)), F.col("_n"))), F.lit(0)).alias("of_kinds"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("_x", "_n")))).alias("extensions"),
    )


def dashboard(documents: DataFrame, catalogue: DataFrame, order: Sequence[str], recent: str, limit: int = 10) -> DataFrame:
    """One row with the state of everything: ``totals`` (documents, complete, failed, in_pipeline, not_started, concepts, vectors,
    pages, catalogued), ``pipeline`` (status, n) in flow order, ``sources`` (source, n) by falling number, and the titles of the
    ``limit`` complete documents that are newest by ``recent``.

    ``documents``: hash, status, book_title, pages_extracted, concepts_extracted, vectors_inserted; ``catalogue``: hash, source.
    Each part is an aggregate of a bounded number of rows: states, sources, titles.
    """
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (("concepts", "concepts_extracted"), ("vectors", "vectors_inserted"), ("pages", "pages_extracted"))]
    totals = documents.agg(F.count("*").alias("documents"), F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(~F.col("status").isin("complete", "failed")).alias("in_pipeline"), *sums)
    idle = catalogue.join(documents.select("hash"), "hash", "left_anti").agg(F.count("*").alias("not_started"))
    held = catalogue.agg(F.count("*").alias("catalogued"))
    totals = totals.crossJoin(idle).crossJoin(held).select(F.struct("documents", "complete", "failed", "in_pipeline", "not_started", "concepts", "vectors", "pages", "catalogued").alias("totals"))
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("status"))
    states = documents.groupBy("status").agg(F.count("*").alias("n"))
    states = states.agg(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("at"), "status", "n"))), lambda x: F.struct(x["status"].alias("status"), x["n"].alias("n"))).alias("pipeline"))
    sources = catalogue.groupBy("source").agg(F.count("*").alias("n"))
    sources = sources.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "source"))), lambda x: F.struct(x["source"].alias("source"), (-x["less"]).alias("n"))).alias("sources"))
    newest = documents.where("status = 'complete'").orderBy(F.desc(recent), "hash").limit(limit)
    newest = newest.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col(recent)).alias("less"), "hash", F.coalesce("book_title", F.lit("Untitled")).alias("title")))), lambda x: x["title"]).alias("recent"))
    # One row each.
    return totals.crossJoin(states).crossJoin(sources).crossJoin(newest)


def facets(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(facet, value, n)`` of several columns in one pass; nulls and blanks are not counted."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])
    long_ = rows.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null and value <> ''")
    return long_.groupBy("facet", "value").agg(F.count("*").alias("n"))


def vote(rows: DataFrame, key: str, field: str, value: str, priority: str) -> DataFrame:
    """Per key and field the value that most sources agree on (case and blanks aside), at least two;
    else the value of the first source. ``provenance`` says which."""
    clean = F.nullif(F.lower(F.trim(value)), F.lit("null"))
    live = rows.where(clean.isNotNull() & (clean != "")).withColumn("_norm", clean)
    groups = live.groupBy(key, field, "_norm").agg(F.count("*").alias("n"), F.min(F.struct(priority, value)).alias("first"))
    best = groups.groupBy(key, field).agg(
        F.min(F.struct(F.when(F.col("n") >= 2, -F.col("n")).otherwise(0).alias("k"), F.col(f"first.{priority}").alias("p"), F.col(f"first.{value}").alias("v"))).alias("b")
    )
    return best.select(key, field, F.col("b.v").alias(value), F.when(F.col("b.k") < 0, "voted").otherwise("priority").alias("provenance"))


def top_n(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group; Spark limits groups before the shuffle."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rn") <= n)


def shares(rows: DataFrame, value: str) -> DataFrame:
    """Share of the total and of the maximum in percent, 0 where they are 0.

    ``rows`` is an aggregate; the totals are one row and are joined, not windowed.
    """
    totals = rows.agg(F.sum(value).alias("_sum"), F.max(value).alias("_max"))
    pct = lambda of: F.when(F.col(of) == 0, 0.0).otherwise(100.0 * F.col(value) / F.col(of))
    return rows.crossJoin(F.broadcast(totals)).select(*rows.columns, pct("_sum").alias("pct_total"), pct("_max").alias("pct_max"))


def without_repeats(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Rows whose value differs from the one before in the group."""
    before = F.lag(value).over(Window.partitionBy(group).orderBy(order))
    return rows.withColumn("_before", before).where(~F.equal_null(F.col("_before"), F.col(value))).drop("_before")


def offsets(rows: DataFrame, group: str, order: str, text: str, joint: int = 1) -> DataFrame:
    """Character offset of each row in the joined text of its group."""
    ahead = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum(F.length(text) + joint).over(ahead), F.lit(0)).cast("long"))


def page_windows(pages: DataFrame, key: str, number: str, text: str, size: int) -> DataFrame:
    """Every ``size`` pages joined, each under a header with its number."""
    block = F.concat(F.lit("--- Page "), F.col(number).cast("string"), F.lit(" ---\n"), F.coalesce(F.col(text), F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), block.alias("t"))))
    grouped = pages.groupBy(key, F.floor((F.col(number) - 1) / size).cast("long").alias("win"))
    return grouped.agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n\n").alias("content"), F.min(number).alias("start_page"), F.count("*").alias("n_pages"))


def as_of(rows: DataFrame, cues: DataFrame, key: str, at: str, cue_at: str, value: str) -> DataFrame:
    """Each row with the value of the last cue of its key at or before it, else of the first cue.

    Rows and cues are sorted together once per key; nothing is joined by a range.
    """
    left = rows.select("*", F.col(at).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(cues.schema[value].dataType).alias("_v"))
    right = cues.select(key, F.col(cue_at).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    both = left.unionByName(right, allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy("_t", "_side", "_v")
    last = F.last("_v", ignorenulls=True).over(order)
    first = F.first("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return both.withColumn(value, F.coalesce(last, first)).where("_side = 1").select(*rows.columns, value)


def reconcile(listed: DataFrame, tracked: DataFrame, key: str) -> DataFrame:
    """Each key as new, tracked or removed."""
    a, b = listed.select(key, F.lit(1).alias("_a")), tracked.select(key, F.lit(1).alias("_b"))
    state = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "removed").otherwise("tracked")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def remap(rows: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the sorted set of canonical values; variants mapped to null or unknown are dropped."""
    # A dictionary of few rows is sent to the tasks, a longer one is shuffled.
    few = mapping.limit(MAX_SENT + 1).count() <= MAX_SENT
    met = rows.join(F.broadcast(mapping) if few else mapping, rows[value] == mapping["variant"]).where("canonical is not null")
    return met.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("canonical")), ",").alias("mapped"))


def sets_differ(a: Column, b: Column) -> Column:
    """Whether two lists hold different values, whatever the order and repeats."""
    return ~F.equal_null(F.array_sort(F.array_distinct(a)), F.array_sort(F.array_distinct(b)))


def round_robin(rows: DataFrame, order: Sequence[str], n: int, name: str) -> DataFrame:
    """``rows`` with a number from 0 to ``n - 1``, dealt in ``order`` (unique) over all rows; no task numbers more than a range."""
    rank = tables.fresh(rows, "rank")
    ranked = tables.with_prefix_sums(rows, order, rank=rank)
    return ranked.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col(rank) % n).cast("int").alias(name))
