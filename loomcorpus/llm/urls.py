"""URL rules by host and path prefix, through a blocked Bloom filter and an exact hash join.

Listed entries are canonical URLs without scheme: a host and the start of a path. A page url can only
meet an entry whose host is its own host or a parent domain and whose path is a prefix of its path;
these candidate keys (domain suffixes times listed path lengths) are tested against a Bloom filter
with one 64-bit block per key. What passes is joined exactly with the list, which removes the false
positives; the longest entry wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most blocks of the filter that are broadcast (some 40 bytes each); a longer filter and the candidate keys are dealt by block.
MAX_BLOCKS = 1 << 20
#: Listed entries that are broadcast for the exact join at most; a longer list is shuffled.
MAX_SENT_ENTRIES = 100_000
_PROBES = 4


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    """The bits of a key inside its block: some 6-bit slices of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(_PROBES):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return mask


def rules_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``(verdict, host/path prefix)`` pairs as ``(key, verdict)`` rows."""
    return spark.createDataFrame([(entry, verdict) for verdict, entry in rules], "key string, verdict string")


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` of every row.

    ``listed`` has ``key`` (host in lower case, then the path prefix with its ``/``) and ``verdict``.
    The longest fitting key decides, of equal ones the greater; without one, rule is null and the
    verdict ``default``. A null url, or one without ``://``, has an empty host and path. Repeated
    rows each get their verdict; repeated keys count once (the greatest verdict holds). Other columns are ignored.
    """
    listed = listed.where("key is not null").groupBy("key").agg(F.max("verdict").alias("verdict"))
    lengths = listed.select(F.length(F.regexp_extract("key", r"(?s)^[^/]*(.*)$", 1)).alias("n"))
    sizes = lengths.agg(F.count("*").alias("keys"), F.sort_array(F.collect_set("n")).alias("lengths")).first()
    blocks = max(1, 16 * sizes["keys"] // 64 + 1)  # 16 bits a key
    bloom = listed.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("key"))).alias("bits"))

    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.", -1)
    # Keys of one url: every domain suffix of the host with every listed length of the path.
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in sizes["lengths"]]).cast("array<int>"), lambda n: n <= F.length("path"))
    keys = F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(fitting, lambda n: F.concat(s, F.substr(F.col("path"), F.lit(1), n))))))
    # Equal urls are judged once, so a host with a third of all pages costs no more than its urls.
    urls = rows.select("host", "path").distinct()
    probes = urls.where("host <> ''").select("host", "path", F.explode(keys).alias("key"))
    # One block for each row of the filter, so its join has no hot key on that side.
    hits = probes.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(bloom) if blocks <= MAX_BLOCKS else bloom, "block")
    hits = hits.where(F.col("bits").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key"))).select("host", "path", "key")
    exact = F.broadcast(listed) if sizes["keys"] <= MAX_SENT_ENTRIES else listed
    best = hits.join(exact, "key").groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

SQL = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, rule, rhost, rpath) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
         ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), fits AS (
  SELECT p.page_id, p.host, p.path, r.rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS k
  FROM parts p LEFT JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""
