"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text becomes the array of its words' hashes. Of every ``WINDOW - GRAM + 1`` consecutive k-grams the
least hash is a fingerprint, so two texts that share ``WINDOW`` words in a row share a fingerprint
inside them. Fingerprints of all documents are joined with those of the benchmark; in the few
documents that meet one, each hit is extended to the windows around it and these are looked up
by a 128-bit hash in the benchmark's windows. Items too short for a window are one window of their
own length; their first ``SHORT`` words, or all of fewer, are their fingerprint, and the windows of all
lengths that begin like one are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import cleaned, stored

WINDOW = 13
GRAM = 8
#: Words of the fingerprint of a short item.
SHORT = 4
#: Rows of a benchmark or candidate table that are broadcast at most; larger ones are shuffled.
MAX_SENT = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text after A-Z are lower-cased: runs of digits, a-z and non-ASCII; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _runs(size: Column, width: int) -> Column:
    """Starts (from 1) of the runs of ``width`` among ``size`` places; none if there are too few."""
    return F.when(size >= width, F.sequence(F.lit(1), size - (width - 1))).otherwise(F.array().cast("array<int>"))


def _grams(hashes: str, width: int) -> Column:
    """Hash of every run of ``width`` words, which also tells runs of another width apart."""
    return F.transform(_runs(F.size(hashes), width), lambda i: F.xxhash64(F.slice(hashes, i, width)))


def _winnowed(grams: str) -> Column:
    width = WINDOW - GRAM + 1
    return F.array_distinct(F.transform(_runs(F.size(grams), width), lambda i: F.array_min(F.slice(grams, i, width))))


def _fingerprints(rows: DataFrame, widths: list[int]) -> DataFrame:
    """``rows`` (with ``hashes``) with ``prints``: winnowed k-grams, and all runs as wide as short fingerprints."""
    rows = rows.withColumn("grams", _grams("hashes", GRAM))
    prints = F.concat(_winnowed("grams"), *[F.array_distinct(_grams("hashes", n)) for n in widths])
    return rows.withColumn("prints", prints)


def _spans(starts: Column, width: int) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(width).alias("n")))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_SENT else df


@cleaned
def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(id_col, n_words, n_hit, n_items, items_sha256, contaminated)`` of every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window of the benchmark, ``n_items`` the
    item ids whose windows occur; a row is contaminated if words were hit, and they are at least one
    in twenty. Null and wordless texts have no hits and no contamination. Items without words or id are ignored, items
    that repeat an id count once. Repeated rows of ``docs`` each get their result;
    rows with a null id are returned without hits. Other columns are ignored.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), _word_hashes(F.col(item_text)).alias("hashes"))
    items = stored(items.where("item is not null and size(hashes) > 0").withColumn("n", F.least(F.size("hashes"), F.lit(WINDOW))), "items")
    short = sorted(r.n for r in items.where(F.col("n") < WINDOW).select("n").distinct().collect())
    widths = sorted({min(n, SHORT) for n in short})
    windows = items.select("item", "n", "hashes", F.explode(F.sequence(F.lit(1), F.size("hashes") - F.col("n") + 1)).alias("at"))
    windows = stored(windows.select("item", "n", *_names(F.slice("hashes", F.col("at"), F.col("n")))).distinct(), "windows")
    prints = _fingerprints(items.where(F.col("n") == WINDOW), []).select(F.explode("prints").alias("print"))
    brief = items.where(F.col("n") < WINDOW).select(F.xxhash64(F.slice("hashes", 1, F.least("n", F.lit(SHORT)))).alias("print"))
    prints = _small(stored(prints.union(brief).distinct(), "prints"))

    key = [F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash")]
    marked = _fingerprints(docs.select(*key, _word_hashes(F.col(text_col)).alias("hashes")), widths)
    marked = stored(marked.select("id", "text_hash", F.size("hashes").cast("long").alias("n_words"), "prints"), "prints")
    met = marked.select("id", "text_hash", F.explode("prints").alias("print")).join(prints, "print")
    met = met.where("id is not null").groupBy("id", "text_hash").agg(F.collect_set("print").alias("met"))
    met = stored(met, "met")

    texts = docs.select(*key, F.col(text_col).alias("text")).join(_small(met), ["id", "text_hash"]).dropDuplicates(["id", "text_hash"])
    found = texts.select("id", "text_hash", "met", _word_hashes(F.col("text")).alias("hashes")).withColumn("grams", _grams("hashes", GRAM))
    # A k-gram that was met lies in the windows that start up to WINDOW - GRAM words before it.
    # (Zipped, as an array looked up inside the lambda would be computed again for every element.)
    pairs = F.arrays_zip(_runs(F.size("hashes"), GRAM).alias("at"), F.col("grams").alias("gram"))
    hit = F.transform(F.filter(pairs, lambda x: F.array_contains("met", x["gram"])), lambda x: x["at"])
    around = F.array_distinct(F.flatten(F.transform(hit, lambda i: F.sequence(F.greatest(i - (WINDOW - GRAM), F.lit(1)), i))))
    starts = F.filter(around, lambda i: i + (WINDOW - 1) <= F.size("hashes"))
    spans = [_spans(starts, WINDOW)]
    for width in widths:
        begun = F.filter(F.arrays_zip(_runs(F.size("hashes"), width).alias("at"), _grams("hashes", width).alias("gram")), lambda x: F.array_contains("met", x["gram"]))
        found = found.withColumn(f"begun_{width}", F.transform(begun, lambda x: x["at"]))
    for n in short:
        spans.append(_spans(F.filter(f"begun_{min(n, SHORT)}", lambda i: i + (n - 1) <= F.size("hashes")), n))
    found = found.select("id", "text_hash", "hashes", F.concat(*spans).alias("spans"))
    named = F.transform("spans", lambda s: F.struct(s["at"].alias("at"), s["n"].alias("n"), *_names(F.slice("hashes", s["at"], s["n"]))))
    spots = found.select("id", "text_hash", F.explode(named).alias("s")).select("id", "text_hash", "s.*")
    known = _small(windows.select("n", "name_a", "name_b").distinct())
    spots = stored(spots.join(known, ["n", "name_a", "name_b"]), "spots")

    # Words inside the union of the spans of a text, left to right.
    sorted_spans = F.array_sort(F.collect_list(F.struct("at", "n")))
    first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["at"] + s["n"]).alias("end"), (acc["hit"] + F.greatest(s["at"] + s["n"] - F.greatest(acc["end"], s["at"]), F.lit(0))).alias("hit")
    )
    hits = spots.groupBy("id", "text_hash").agg(F.aggregate(sorted_spans, first, step)["hit"].alias("n_hit"))
    owners = spots.select("id", "text_hash", "n", "name_a", "name_b").distinct().join(_small(windows), ["n", "name_a", "name_b"])
    owners = owners.select("id", "text_hash", "item").distinct().groupBy("id", "text_hash")
    owners = owners.agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("listed"))
    result = marked.select("id", "text_hash", "n_words").join(hits, ["id", "text_hash"], "left").join(owners, ["id", "text_hash"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return result.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("listed", F.lit("")), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _names(run: Column) -> list[Column]:
    return [F.xxhash64(run).alias("name_a"), F.xxhash64(F.lit(7), run).alias("name_b")]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows (all rows of an id of which one is). Rows with a null id or text stay, and so do all
    rows if the benchmark is empty; an empty table stays empty."""
    bad = decontaminate(docs, benchmark, id_col, text_col).where("contaminated").select(id_col).distinct()
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)


SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), bl AS (SELECT item_id, w, least(len(w), 13) AS n FROM bw WHERE len(w) > 0
), bs AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM bl
), win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS g FROM bs
), lens AS (SELECT DISTINCT n FROM win
), ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM dw, lens WHERE len(w) >= n
), hit AS (SELECT doc_id, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS g FROM ds WHERE array_to_string(list_slice(w, k, k + n - 1), ' ') IN (SELECT g FROM win)
), hw AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS p FROM hit
), nh AS (SELECT doc_id, count(*) AS n_hit FROM hw GROUP BY doc_id
), it AS (SELECT DISTINCT h.doc_id, CAST(item_id AS VARCHAR) AS item FROM hit h JOIN win USING (g, n)
), ni AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM it GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN nh USING (doc_id) LEFT JOIN ni USING (doc_id)
"""
