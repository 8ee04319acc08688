"""WARC archives with revisit records in place of repeated payloads.

The headers of all pages are shuffled by payload digest; of equal payloads the one with the largest
id stays a response and the others become revisits that refer to it. What comes back to the pages is
the row number and the target of each revisit: broadcast while they are few, else written as one sorted list for
each task that landed pages, of which a reader opens the lists of the rows before it. Payloads are
never shuffled. The archives are written anew with fresh headers, gzipped record by record, in files of bounded size. Every attempt of
a task writes files of its own, and only those of committed attempts are published (``common.publish``), so
lost, repeated and speculative tasks leave no record twice and none half-written.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import ATTEMPTS, cleaned, folder, new_path, publish, scratch, shared_uri, stored

#: An archive file is closed beyond this size, compressed or not, so that reading one back takes bounded memory.
FILE_BYTES, RAW_BYTES = 8 << 20, 64 << 20
#: Revisits whose row numbers are broadcast at most; more are read from lists beside the pages.
MAX_SENT = 1_000_000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [(x or "").encode() for x in batch.column("html").to_pylist()]
        digest = pa.array([payload_digest(p) for p in payloads], pa.string())
        size = pa.array([len(p) for p in payloads], pa.int64())
        yield pa.record_batch([*batch.columns, digest, size], names=[*batch.schema.names, "digest", "size"])


def record_id(digest: str, row: int) -> str:
    """The name of one record: a UUID of its payload's digest and its number, so that repeated pages have records of their own."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest}/{row}')}>"


def record(row: dict, date: str) -> bytes:
    """One WARC/1.1 record of a resolved page; a revisit has the headers but no payload."""
    payload = (row["html"] or "").encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if row['revisit'] else 'response'}", f"WARC-Record-ID: {record_id(row['digest'], row['row'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        target = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"])
        lines.append(f"WARC-Target-URI: {target}")
    lines.append(f"WARC-Payload-Digest: sha1:{row['digest']}")
    if row["page"] is not None:
        lines.append(f"Page-ID: {row['page']}")
    lines.append(f"Page-Payload-Length: {row['size']}")
    if row["revisit"]:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(row['digest'], row['refers_row'])}"]
        if row["refers_to"] is not None:
            lines.append(f"Page-Refers-To: {row['refers_to']}")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _written(batches: Iterator[pa.RecordBatch], folder: str, date: str, most: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    store, base = fs.FileSystem.from_uri(folder)
    out, name, size, raw, count = None, "", 0, 0, 0

    def close() -> pa.RecordBatch:
        out.close()
        return pa.record_batch([pa.array([name]), pa.array([name]), pa.array([count], pa.int64())], names=["attempt", "file", "records"])

    for batch in batches:
        for row in batch.to_pylist():
            if out is None:
                name, size, raw, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0, 0
                out = store.open_output_stream(f"{base}/{ATTEMPTS}/{name}", compression=None)
            plain = record(row, date)
            data = gzip.compress(plain, 4, mtime=0)
            out.write(data)
            size, raw, count = size + len(data), raw + len(plain), count + 1
            if size > most[0] or raw > most[1]:
                yield close()
                out = None
    if out is not None:
        yield close()


def resolve(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """``(page, url, html, digest, size, revisit, refers_to, row, refers_row)`` of every row; no html for revisits. Rows are
    numbered, and ``refers_row`` is the number of the response.

    Of payloads of at least ``least_bytes`` bytes that are equal, the largest id is the response (a null
    id is the least); of repeated rows of that id one is. A null payload is empty.
    """
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = rows.schema["page"].dataType.simpleString()
    landed = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _headers, f"page {kind}, url string, html string, row long, digest string, size long"
    )
    landed = stored(landed, "landed")
    headers = landed.select("page", "row", "digest", "size").where(F.col("size") >= least_bytes)
    originals = headers.groupBy("digest", "size").agg(F.max(F.struct("page", "row")).alias("original"), F.count("*").alias("held")).where("held > 1")
    revisits = headers.join(originals.drop("held"), ["digest", "size"]).where(F.col("row") != F.col("original.row"))
    revisits = stored(revisits.select("row", F.col("original.page").alias("refers_to"), F.col("original.row").alias("refers_row")), "revisits")
    if revisits.count() <= MAX_SENT:
        resolved = landed.join(F.broadcast(revisits), "row", "left")
    else:
        lists = folder(pages.sparkSession, "revisit_lists")
        listed = revisits.withColumn("task", F.shiftright("row", 33)).repartition("task").sortWithinPartitions("task", "row")
        listed.write.partitionBy("task").parquet(lists)
        uri = shared_uri(pages.sparkSession, lists)
        resolved = landed.mapInArrow(lambda b: _referred(b, uri), f"page {kind}, url string, html string, row long, digest string, size long, refers_to {kind}, refers_row long")
    revisit = F.col("refers_row").isNotNull()
    return resolved.select("page", "url", F.when(~revisit, F.col("html")).alias("html"), "digest", "size", revisit.alias("revisit"), "refers_to", "row", "refers_row")


def _referred(batches: Iterator[pa.RecordBatch], lists: str) -> Iterator[pa.RecordBatch]:
    """Landed rows with what they refer to, from the lists of the tasks that numbered them. A list has at most the
    rows of one task, and rows of one task follow each other."""
    store, base = fs.FileSystem.from_uri(lists)
    known, list_of = -1, None
    for batch in batches:
        rows = batch.column("row").to_numpy()
        tasks = rows >> 33
        place = np.full(len(rows), -1)
        parts = []
        for task in np.unique(tasks):
            if task != known:
                files = store.get_file_info(fs.FileSelector(f"{base}/task={task}", allow_not_found=True))
                tables = [pq.read_table(f.path, filesystem=store, partitioning=None) for f in files if f.path.endswith(".parquet")]
                known, list_of = task, pa.concat_tables(tables).sort_by("row") if tables else None
            if list_of is None:
                continue
            numbers, own = list_of.column("row").to_numpy(), np.flatnonzero(tasks == task)
            at = np.minimum(np.searchsorted(numbers, rows[own]), len(numbers) - 1)
            met = numbers[at] == rows[own]
            place[own[met]] = at[met] + sum(map(len, parts))
            parts.append(list_of)
        if parts:
            whole = pa.concat_tables(parts)
            take = pa.array(place, mask=place < 0)
            found = [whole.column(c).combine_chunks().take(take) for c in ("refers_to", "refers_row")]
        else:
            found = [pa.nulls(len(rows), batch.schema.field("page").type), pa.nulls(len(rows), pa.int64())]
        yield pa.record_batch([*batch.columns, *found], names=[*batch.schema.names, "refers_to", "refers_row"])


@cleaned
def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Write all pages, resolved (see ``resolve``), as archives in ``folder`` (a URI); the files and their record counts.
    ``date`` (UTC, as ``2026-01-31T00:00:00Z``) is when the records were made, by default now."""
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{base}/{ATTEMPTS}")
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    resolved, most = resolve(pages, id_col, url_col, html_col, least_bytes), (FILE_BYTES, RAW_BYTES)
    return publish(resolved.mapInArrow(lambda b: _written(b, folder, date, most), "attempt string, file string, records long"), folder)


def parse(data: bytes) -> Iterator[dict]:
    """Records of one decompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        yield head | {"payload": data[end + 4 : end + 4 + size]}
        at = end + 4 + size + 4


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            # (gzip.decompress would copy the rest of the file once for every record.)
            with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as archived:
                data = archived.read()
            for r in parse(data):
                if r["WARC-Type"] == "response":
                    assert payload_digest(r["payload"]) == r["WARC-Payload-Digest"].removeprefix("sha1:")
                rows.append((r.get("Page-ID"), int(r["Page-Payload-Length"]), r["WARC-Payload-Digest"].removeprefix("sha1:"), r["WARC-Type"], r.get("Page-Refers-To")))
            for at in range(0, len(rows), 10_000):
                columns = zip(*rows[at : at + 10_000], strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()], strict=True)], names=names)


def read_archives(pages: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """``(page, payload_bytes, payload_digest, record_type, refers_to)`` of every record in ``folder``."""
    spark = pages.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("content")
    rows = files.mapInArrow(_read, "page string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return rows.withColumns({"page": F.col("page").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, folder: str | None = None, date: str | None = None) -> DataFrame:
    """Write deduplicated archives of all pages and read them back:
    ``(id_col, payload_bytes, payload_digest, record_type, refers_to)`` of every row.

    Null and empty payloads are empty ones, and equal to each other. Repeated rows each give a record; one of
    the largest id is the response. A null id is kept and is the least; revisits of such a response
    refer to null. No rows give no archives. Other columns are ignored.
    """
    folder = shared_uri(pages.sparkSession, folder or new_path(pages.sparkSession, "warc"))
    with scratch(pages.sparkSession):
        write_archives(pages, folder, id_col, url_col, html_col, least_bytes, date)
    return read_archives(pages, folder, pages.schema[id_col].dataType.simpleString()).withColumnRenamed("page", id_col)


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS original FROM p
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(x, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> original THEN original END AS refers_to
FROM d
"""
