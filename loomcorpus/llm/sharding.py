"""Contiguous shards of near equal size, from global prefix sums of the rows' byte sizes.

The narrow rows (id, size, checksum) are range-partitioned by id; the totals of the partitions,
one row each, give every partition its offset, and a running sum inside it the global prefix of each
row. A row belongs to the shard into whose equal share of all bytes the middle of the row falls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import cleaned, stored, with_prefix_sums

OVERHEAD = 16


def text_size(text: str | Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus a fixed overhead for each row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


@cleaned
def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, size, text_crc32, law, shard, slot, grown_shard)`` of every row.

    Law ``bytes``: shards are contiguous in id order and their sizes differ from an equal share by
    less than the rows at their two ends. Slots number the rows of a shard from 0 in that order.
    Repeated ids are kept, ordered by checksum; a null id sorts first; a null text has no bytes and
    the checksum 0. A shard may stay empty where one row is larger than a share. ``grown_shard`` is null: more shards
    move rows between shards.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), text_size(text_col).alias("size"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "sizes")
    summed = with_prefix_sums(rows, ["id", "crc", "row"], "size")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    # floor((before + size / 2) / (total / shards)), in decimals as the product may pass 2 ** 63.
    middle = (2 * F.col("before") + F.col("size")).cast("decimal(38,0)")
    shard = F.floor(middle * shards / (2 * F.col("total")).cast("decimal(20,0)")).cast("int")
    placed = stored(summed.crossJoin(F.broadcast(total)).withColumn("shard", F.least(shard, F.lit(shards - 1))), "placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as Parquet folders ``shard=<n>`` by ``assign_shards`` (ids must be unique)."""
    placed = assign_shards(docs, shards, id_col, text_col).select(id_col, "shard", "slot")
    docs.join(placed, id_col).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


SQL = r"""
WITH RECURSIVE step(b, k, v) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM step WHERE k < 8
), tab AS (SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8
), sized AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 16 AS BIGINT) AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM documents
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM sized
), placed AS (
  SELECT *, CAST(least(39, (2 * before + size) * 40 // (2 * total)) AS INT) AS shard FROM summed
)
SELECT doc_id, size, xor(4294967295, list_reduce(bytes, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM placed, tab
"""
