"""Training-order materialisation: fixed-stride shards of token sequences in a keyed random order.

Each task joins its documents' ids (an end id after each) into one stream and cuts it into sequences.
The sequences are numbered without gaps by prefix sums over the tasks' counts, and a keyed Feistel
permutation of those numbers, restricted to their range by cycle-walking, gives every sequence its
global slot. The sequences are then range-partitioned by slot and written as shards of
``PER_SHARD`` records of fixed stride, so slot ``s`` starts at byte ``(s % PER_SHARD) * stride`` of shard
``s // PER_SHARD`` and reading can resume anywhere.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcorpus.llm.common import ATTEMPTS, cleaned, new_path, publish, scratch, shared_uri, stored
from loomcorpus.llm.packing import token_ids
from loomcorpus.llm.shingles import mix

SEQUENCE = 2048
#: Records of a shard: 16 MB of 16-bit ids.
PER_SHARD = 4096
#: Tasks that write shards at most: more shards than that are written a range to a task.
MAX_TASKS = 20_000
KEY = 20240229
ROUNDS = 4
#: Vocabularies of up to 2 ** 16 ids; a record is its number of tokens and the ids, zero-padded.
RECORD = np.dtype("<u2")


def stride(size: int = SEQUENCE) -> int:
    return (size + 1) * RECORD.itemsize


def permuted(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A bijection of 0 to n - 1 chosen by ``key``, applied to an array of numbers."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & mask
        for i in range(ROUNDS):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + i * 0xC2B2AE3D27D4EB4F) & (2**64 - 1))
            left, right = right, left ^ (mix(right + salt) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _narrow(ids: np.ndarray) -> np.ndarray:
    if len(ids) and ids.max() >= 1 << 8 * RECORD.itemsize:
        raise ValueError(f"token id {ids.max()} doesn't fit the {8 * RECORD.itemsize} bits of a shard's ids")
    return ids.astype(RECORD)


def _cut(batches: Iterator[pa.RecordBatch], size: int, name: str) -> Iterator[pa.RecordBatch]:
    part, number, rest = TaskContext.get().partitionId(), 0, np.empty(0, RECORD)

    def rows(records: list[np.ndarray]) -> pa.RecordBatch:
        count = len(records)
        return pa.record_batch(
            [
                pa.array(np.full(count, part, np.int64)), pa.array(np.arange(number, number + count)),
                pa.array([len(r) for r in records], pa.int32()), pa.array([r.tobytes() for r in records], pa.binary()),
            ],
            names=["part", "number", "n_tokens", "ids"],
        )

    for batch in batches:
        for at in range(0, len(batch), 256):
            ids = np.concatenate([rest, *[_narrow(x) for x in token_ids(batch.column("text").slice(at, 256).to_pylist(), name)]])
            whole = len(ids) // size
            if whole:
                yield rows(list(ids[: whole * size].reshape(-1, size)))
                number += whole
            rest = ids[whole * size :].copy()
    if len(rest):
        yield rows([rest])


def sequences(docs: DataFrame, text_col: str = "text", size: int = SEQUENCE, name: str = "byte_bpe_50k") -> DataFrame:
    """``(part, number, n_tokens, ids)``: every token of every document once; a task's last sequence may be shorter.

    Null and empty texts are an end id alone, repeated rows come as often as they occur, no rows give no
    sequence. An id that 16 bits can't hold is an error. Other columns are ignored.
    """
    return docs.select(F.col(text_col).alias("text")).mapInArrow(lambda b: _cut(b, size, name), "part long, number long, n_tokens int, ids binary")


def _slotted(batches: Iterator[pa.RecordBatch], n: int, key: int, per_shard: int) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=6)
    for batch in batches:
        slots = permuted(batch.column("index").to_numpy(), n, key)
        ids = pa.array([pack.compress(x.as_buffer()) for x in batch.column("ids")], pa.binary())
        yield pa.record_batch([pa.array(slots // per_shard), pa.array(slots), batch.column("n_tokens"), ids], names=["shard", "slot", "n_tokens", "ids"])


def _write(batches: Iterator[pa.RecordBatch], folder: str, size: int) -> Iterator[pa.RecordBatch]:
    """Write the shards of one task, each under a name of this attempt."""
    store, base = fs.FileSystem.from_uri(folder)
    unpack, out, shard, count, open_name = zstandard.ZstdDecompressor(), None, -1, 0, ""

    def close() -> pa.RecordBatch:
        out.close()
        columns = [pa.array([open_name]), pa.array([f"shard-{shard:09d}.bin"]), pa.array([shard], pa.int64()), pa.array([count], pa.int64())]
        return pa.record_batch(columns, names=["attempt", "file", "shard", "records"])

    for batch in batches:
        for own, n_tokens, ids in zip(batch.column("shard").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("ids"), strict=True):
            if own != shard:
                if out is not None:
                    yield close()
                shard, count, open_name = own, 0, uuid.uuid4().hex
                out = store.open_output_stream(f"{base}/{ATTEMPTS}/{open_name}")
            data = unpack.decompress(ids.as_buffer(), max_output_size=size * RECORD.itemsize)
            out.write((np.array([n_tokens], RECORD).tobytes() + data).ljust(stride(size), b"\0"))
            count += 1
    if out is not None:
        yield close()


def _parse(batches: Iterator[pa.RecordBatch], size: int, per_shard: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            shard = int(path.rsplit("-", 1)[1].removesuffix(".bin"))
            records = np.frombuffer(content.as_buffer(), RECORD).reshape(-1, size + 1)
            places = np.arange(len(records))
            checks = [zlib.crc32(r[1 : 1 + r[0]].tobytes()) for r in records]
            yield pa.record_batch(
                [
                    pa.array(shard * per_shard + places), pa.array(np.full(len(records), shard, np.int64)), pa.array(places.astype(np.int64)),
                    pa.array(records[:, 0].astype(np.int32)), pa.array(checks, pa.int64()),
                ],
                names=["slot", "shard", "place", "n_tokens", "ids_crc32"],
            )


@cleaned
def write_shards(docs: DataFrame, folder: str, text_col: str = "text", size: int = SEQUENCE, per_shard: int = PER_SHARD, key: int = KEY, max_tasks: int = MAX_TASKS) -> DataFrame:
    """Write all sequences of ``docs`` as shards in ``folder`` (a URI), in at most ``max_tasks`` tasks; ``(shard, records)`` of each.

    Null and empty texts are an end id alone; repeated rows are written as often as they occur; no
    rows give no shard. Other columns are ignored.
    """
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{base}/{ATTEMPTS}")
    cut = stored(sequences(docs, text_col, size), "sequences", level=9)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("part").agg(F.count("*").alias("n"))  # one row for each task of the scan
    offsets = counts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    n = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-n // per_shard))
    indexed = cut.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("number")).alias("index"), "n_tokens", "ids")
    slotted = indexed.mapInArrow(lambda b: _slotted(b, n, key, per_shard), "shard long, slot long, n_tokens int, ids binary")
    # The slots are a permutation of 0 to n - 1, so equal ranges of them hold equal numbers of
    # sequences: the range of a row is its shard, and a task writes a range of shards one after the other.
    tasks = min(shards, max_tasks)
    ranged = slotted.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int")).sortWithinPartitions("slot")
    return publish(ranged.mapInArrow(lambda b: _write(b, folder, size), "attempt string, file string, shard long, records long"), folder)


def read_shards(spark: SparkSession, folder: str, size: int = SEQUENCE, per_shard: int = PER_SHARD) -> DataFrame:
    """``(slot, shard, place, n_tokens, ids_crc32)`` of every record in ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder).select("path", "content")
    return files.mapInArrow(lambda b: _parse(b, size, per_shard), "slot long, shard long, place long, n_tokens int, ids_crc32 long")


def read_from(folder: str, slot: int, count: int, size: int = SEQUENCE, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """The ids of ``count`` sequences from global slot ``slot`` on: one seek, then sequential reads."""
    store, base = fs.FileSystem.from_uri(folder)
    while count > 0:
        name = f"{base}/shard-{slot // per_shard:09d}.bin"
        if store.get_file_info(name).type == fs.FileType.NotFound:
            return
        with store.open_input_file(name) as shard:
            shard.seek(slot % per_shard * stride(size))
            while count > 0:
                data = shard.read(stride(size))
                if len(data) < stride(size):
                    break
                record = np.frombuffer(data, RECORD)
                yield record[1 : 1 + record[0]]
                slot, count = slot + 1, count - 1
            else:
                return
        if slot % per_shard:
            return


def materialise(docs: DataFrame, text_col: str = "text", folder: str | None = None, size: int = SEQUENCE, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Write the shards and read them back, see ``write_shards`` and ``read_shards``."""
    folder = shared_uri(docs.sparkSession, folder or new_path(docs.sparkSession, "shards"))
    with scratch(docs.sparkSession):
        write_shards(docs, folder, text_col, size, per_shard, key)
    return read_shards(docs.sparkSession, folder, size, per_shard)
