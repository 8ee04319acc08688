"""Line dedup over line-ID sequences: suffix ranks by prefix doubling, later copies of runs deleted.

Every non-blank line gets an id (a 128-bit hash of the trimmed line) and a number within its document;
documents follow each other by id. The rank of a line is the place of its id among the sorted ids
that occur twice or more. A repeated run holds repeated lines only, so of each document the stretches of
repeated lines are kept that reach ``min_words`` words; all else leaves before the first round.

Round by round, suffixes are ranked by their first 1, 2, 4, ... lines: the rank of a run of ``2 k``
lines is the place of the pair (rank of its first ``k`` lines, rank of the next ``k``) among the sorted
pairs that occur twice or more. Suffixes that share their first ``k`` lines with no other leave after
round ``k``, and so do those that lie in no run that still has to be looked up; no window or group
ever holds a whole bucket.

The suffixes that share a prefix of ``l`` lines form an LCP interval of depth ``l`` of the suffix array;
as two overlapping runs of ``2 ** floor(log2 l)`` lines cover the prefix, the interval is named by the
ranks of those two. For every line the shortest run of ``min_words`` words that starts there, and the
shortest that ends there, are looked up; the first member of an interval in document order stays, the
others are later copies. The later copies that overlap or touch are merged, and the merged runs deleted.

The deleted lines are those of all maximal repeated runs: let R be a later copy of a run of at least
``min_words`` words. Each part of R is a later copy too. Let s be the last line from which R still has
``min_words`` words; every line of R up to the end of the shortest such run at s lies in a shortest run
that starts at or before s inside R, and for every line behind it the shortest run that ends there begins
at or behind s, hence inside R. So the shortest runs inside R cover R; and a shortest run that is
a later copy is itself part of a maximal repeated run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcorpus.llm.common import cleaned, sent, stored

#: Words a repeated run must have.
MIN_WORDS = 50
#: Rows of ranks, intervals or deleted runs that are broadcast at most; more are joined by a shuffle.
MAX_SENT = 500_000
_BLANKS = " \t\n\x0b\f\r"
_KEY = ["doc", "h"]


def _blank(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS)) == ""


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, h, line, words, a, b)`` of every non-blank line; ``line`` counts them within a text from 0,
    ``h`` is the hash of the text, and ``a`` and ``b`` are the id of the line."""
    base = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("doc is not null and text is not null")

    def named(line: Column) -> Column:
        bare = F.trim(line, F.lit(_BLANKS))
        return F.struct(F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"), F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(7), bare).alias("b"))

    own = F.filter(F.transform(F.split("text", "\n"), named), lambda x: x["words"] > 0)
    return base.select("doc", F.xxhash64("text").alias("h"), F.posexplode(own).alias("line", "x")).select("doc", "h", "line", "x.words", "x.a", "x.b")


def _ranks(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``(first, second, place)`` of the pairs that occur twice or more; places rise with the pairs."""
    pairs = rows.groupBy(first, second).count().where("count > 1").select(first, second)
    pairs = pairs.repartitionByRange(first, second).sortWithinPartitions(first, second)
    return stored(pairs.withColumn("place", F.monotonically_increasing_id()), "ranks")


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """``(doc, h, line, rank, ahead, back, need)`` of the lines in stretches of repeated lines.

    ``ahead`` and ``back`` are the lines of the shortest run of ``min_words`` words from, or up to, this
    line (null if the stretch holds none); ``need`` bounds the length of such runs around it.
    """
    ranks = _ranks(lines, "a", "b")
    rows = lines.join(sent(ranks, MAX_SENT), ["a", "b"]).select(*_KEY, "line", "words", F.col("place").alias("rank"))
    order = Window.partitionBy(*_KEY).orderBy("line")
    # Rows of one id and text are one document.
    rows = rows.withColumn("before", F.lag("line").over(order)).where("before is null or before <> line")
    rows = rows.withColumn("island", F.col("line") - F.row_number().over(order))
    island = Window.partitionBy(*_KEY, "island")
    rows = rows.withColumns({"sum": F.sum("words").over(island.orderBy("line")), "total": F.sum("words").over(island)})
    rows = rows.where(F.col("total") >= min_words).withColumn("start", F.col("sum") - F.col("words"))
    # Every line has words, so the sums rise and a range of words is a run of lines.
    ahead = F.count("*").over(island.orderBy("start").rangeBetween(0, min_words - 1))
    back = F.count("*").over(island.orderBy("sum").rangeBetween(-(min_words - 1), 0))
    rows = rows.withColumns(
        {"ahead": F.when(F.col("start") + min_words <= F.col("total"), ahead).cast("int"), "back": F.when(F.col("sum") >= min_words, back).cast("int")}
    )
    # No run has more than min_words lines.
    near = [F.max("ahead").over(island.orderBy("line").rowsBetween(1 - min_words, 0)), F.max("back").over(island.orderBy("line").rowsBetween(0, min_words - 1))]
    rows = rows.withColumn("need", F.greatest(*near))
    return stored(rows.select(*_KEY, "line", "rank", "ahead", "back", "need"), "stretches")


@cleaned
def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc, h, first, last)``: the merged later copies of runs of at least ``min_words`` words, by
    id, text hash, and first and last non-blank line of the text. Rows with a null id or text have none; an empty
    table, like one without repeats, gives no rows."""
    rows = _stretches(stored(_lines(docs, id_col, text_col), "lines"), min_words)
    runs = rows.where("ahead is not null").select(*_KEY, "line", F.col("ahead").alias("n"))
    runs = stored(runs.union(rows.where("back is not null").select(*_KEY, F.col("line") - F.col("back") + 1, "back")).distinct(), "runs")
    longest = runs.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    suffixes, length = rows.select(*_KEY, "line", "rank", "need"), 1
    later = runs.select(*_KEY, "line", "n").limit(0)
    while length <= longest:
        # Runs of length to 2 length - 1 lines: covered by a ranked run at their start and one at their end.
        own = runs.where(F.col("n").between(length, 2 * length - 1))
        head = suffixes.select(*_KEY, "line", F.col("rank").alias("head"))
        if length > 1:
            tail = suffixes.select(*_KEY, F.col("line").alias("last"), F.col("rank").alias("tail"))
            own = own.withColumn("last", F.col("line") + F.col("n") - length).join(tail, [*_KEY, "last"])
        own = own.join(head, [*_KEY, "line"]).withColumn("tail", F.col("tail" if length > 1 else "head"))
        own = stored(own.select(*_KEY, "line", "n", "head", "tail"), "own")
        intervals = own.groupBy("head", "tail", "n").agg(F.min(F.struct(*_KEY, "line")).alias("first"), F.count("*").alias("members")).where("members > 1")
        intervals = stored(intervals.drop("members"), "intervals")
        copies = own.join(sent(intervals, MAX_SENT), ["head", "tail", "n"]).where(F.struct(*_KEY, "line") > F.col("first"))
        later = later.union(stored(copies.select(*_KEY, "line", "n"), "copies"))
        if 2 * length > longest:
            break
        wanted = suffixes.where(F.col("need") >= 2 * length)
        follow = wanted.select(*_KEY, (F.col("line") - length).alias("line"), F.col("rank").alias("next"))
        pairs = stored(wanted.join(follow, [*_KEY, "line"]), "pairs")
        ranked = pairs.join(sent(_ranks(pairs, "rank", "next"), MAX_SENT), ["rank", "next"])
        suffixes = stored(ranked.select(*_KEY, "line", F.col("place").alias("rank"), "need"), "suffixes")
        length *= 2
    # Copies that overlap or touch are one run.
    order = Window.partitionBy(*_KEY).orderBy("line", "n")
    later = later.withColumn("last", F.col("line") + F.col("n") - 1)
    later = later.withColumn("reached", F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    later = later.withColumn("run", F.count_if(F.coalesce(F.col("line") > F.col("reached") + 1, F.lit(True))).over(order))
    return later.groupBy(*_KEY, "run").agg(F.min("line").alias("first"), F.max("last").alias("last")).drop("run")


def _without(text: Column, runs: Column) -> Column:
    """``text`` without the non-blank lines of ``runs`` (sorted, apart from each other). Bound to lambda
    variables, the lines and their places are computed once; each line is then copied once."""

    def cut(lines: Column) -> Column:
        def joined(places: Column) -> Column:
            spot = lambda i: F.get(places, i) + 1

            def part(run: Column, i: Column) -> Column:
                begin = F.when(i > 0, spot(F.get(runs, i - 1)["last"]) + 1).otherwise(F.lit(1))
                kept = F.slice(lines, begin, spot(run["first"]) - begin)
                return F.concat(kept, F.filter(F.slice(lines, spot(run["first"]), spot(run["last"]) - spot(run["first"]) + 1), _blank))

            end = spot(F.element_at(runs, -1)["last"])
            return F.array_join(F.concat(F.flatten(F.transform(runs, part)), F.slice(lines, end + 1, F.size(lines) - end)), "\n")

        places = F.filter(F.transform(lines, lambda x, i: F.when(~_blank(x), i)), lambda i: i.isNotNull())
        return F.get(F.transform(F.array(places), joined), F.lit(0))

    return F.get(F.transform(F.array(F.split(text, "\n")), cut), F.lit(0))


def _cut(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``(row, new_text, lines_before, lines_gone)`` of every row, ``row`` being a struct of its columns."""
    runs = repeated_runs(docs, id_col, text_col, min_words).groupBy(*_KEY)
    runs = stored(runs.agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs")), "runs")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("h"))
    few = runs.agg(F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()[0] <= MAX_SENT
    rows = rows.join(F.broadcast(runs) if few else runs, _KEY, "left")
    text = F.col(f"row.`{text_col}`")
    before = F.when(text.isNull(), 0).otherwise(F.size(F.filter(F.split(text, "\n"), lambda x: ~_blank(x)))).cast("long")
    gone = F.aggregate(F.coalesce("runs", F.array().cast(runs.schema["runs"].dataType)), F.lit(0), lambda n, x: n + x["last"] - x["first"] + 1)
    return rows.select("row", F.when(F.col("runs").isNull(), text).otherwise(_without(text, F.col("runs"))).alias("new_text"), before.alias("lines_before"), gone.cast("long").alias("lines_gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with the later copies of repeated runs cut from the text, and
    ``n_lines`` (non-blank lines before) and ``n_deleted`` (in place of columns of these names).

    Runs are compared by trimmed non-blank lines; documents come in id order, and a copy may overlap
    the run it repeats. Null, empty and blank texts stay as they are; rows with a null id are neither
    changed nor counted as copies. Rows that repeat id and text are one document and get the same result; rows of one id
    with different texts are documents of their own, in the order of a hash of the text. A text whose
    lines are all deleted is left with its blank lines. Empty tables give empty results.
    """
    rows = _cut(docs, id_col, text_col, min_words)
    new = {text_col: "new_text", "n_lines": "lines_before", "n_deleted": "lines_gone"}
    columns = [F.col(new[c]).alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns]
    return rows.select(*columns, *[F.col(new[c]).alias(c) for c in ("n_lines", "n_deleted") if c not in docs.columns])


def keep_new_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of runs deleted, and without the rows that lost every non-blank line;
    ``n_chars``, where there is such a column, is that of the new text. See ``dedup_lines``."""
    rows = _cut(docs, id_col, text_col, min_words).where("lines_gone = 0 or lines_gone < lines_before")
    size = F.when(F.col("lines_gone") > 0, F.length("new_text").cast("long"))
    new = {text_col: F.col("new_text"), "n_chars": F.coalesce(size, F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


SQL = r"""
WITH ls AS (SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents
), e AS (SELECT doc_id, unnest(raw) AS t, generate_subscripts(raw, 1) - 1 AS spot FROM ls WHERE text IS NOT NULL
), n AS (SELECT doc_id, spot, regexp_replace(t, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM e
), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY spot) AS i, sum(w) OVER (PARTITION BY doc_id ORDER BY spot) AS s FROM n WHERE w > 0
), l AS (SELECT doc_id, list(t ORDER BY i) AS ts, count(*) AS n_lines FROM r GROUP BY doc_id
), u AS (
  SELECT r.doc_id, r.i AS lo, min(q.i) AS hi FROM r JOIN r q ON q.doc_id = r.doc_id AND q.i BETWEEN r.i AND r.i + 49 AND q.s - r.s + r.w >= 50 GROUP BY r.doc_id, r.i
  UNION SELECT r.doc_id, max(q.i), r.i FROM r JOIN r q ON q.doc_id = r.doc_id AND q.i BETWEEN r.i - 49 AND r.i AND r.s - q.s + q.w >= 50 GROUP BY r.doc_id, r.i
), k AS (SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY array_to_string(list_slice(ts, lo, hi), chr(10)) ORDER BY doc_id, lo) AS place FROM u JOIN l USING (doc_id)
), g AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS i FROM k WHERE place > 1
), gone AS (SELECT doc_id, list(spot) AS gone FROM g JOIN r USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(raw, lambda x, j: NOT list_contains(gone, j - 1)), chr(10)) END AS text,
  coalesce(n_lines, 0) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_deleted
FROM ls LEFT JOIN l USING (doc_id) LEFT JOIN gone USING (doc_id)
"""
