"""Best-fit packing of tokenized documents into sequences by swap-based local search.

Documents are tokenized in Arrow batches; only those longer than a sequence are cut. Pieces of
full length are sequences of their own. The others are dealt by a hash into groups of bounded
size, each packed in one task: best-fit decreasing first, then a local search over the underfull
bins, which moves a document, exchanges one for one or two for one whenever that raises the sum of
squared fills, so light bins drain into heavy ones until they are empty; it ends when no step is left or
the number of bins has reached its lower bound. The bins that a group
leaves underfull go, as wholes, to a second round of groups, where the same search runs over
documents of different first groups; so the loss to grouping doesn't add up with the group count.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import cleaned, stored

SEQUENCE = 2048
END = 0
#: Pieces of one packing group: its memory and time bound.
GROUP = 4096

#: The special token of the vocabulary; a text with this string is encoded by the tokenizers library.
SPECIAL = "<|endoftext|>"

_loaded: dict[str, object] = {}


def tokenizer(name: str = "byte_bpe_50k"):
    """The named public vocabulary in the tokenizers library, loaded once in a Python worker."""
    if name not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        _loaded[name] = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    return _loaded[name]


def _ranks(name: str):
    """The same vocabulary as ranks: equal ids, several times as fast."""
    key = f"{name}/ranks"
    if key not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _loaded[key] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[key]


def token_ids(texts: list[str | None], name: str = "byte_bpe_50k") -> Iterator[np.ndarray]:
    """Ids of each text as uint32, with the end id; null counts as empty."""
    coder = _ranks(name)
    for text in texts:
        if text and SPECIAL in text:
            ids = tokenizer(name).encode(text, add_special_tokens=False).ids
        else:
            ids = coder.encode_ordinary(text) if text else []
        ids.append(END)
        yield np.array(ids, dtype="<u4")


def _pieces(batches: Iterator[pa.RecordBatch], size: int, name: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            rows, numbers, starts, parts = [], [], [], []
            for row, ids in enumerate(token_ids(part.column("text").to_pylist(), name)):
                first = (len(ids) - 1) % size + 1
                cuts = [0, *range(first, len(ids), size)]
                for number, start in enumerate(cuts):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    parts.append(ids[start : first if start == 0 else start + size])
            columns = [
                part.column("id").take(pa.array(rows, pa.int32())),
                part.column("row").take(pa.array(rows, pa.int32())),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array([len(p) for p in parts], pa.int64()),
                pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([p.tobytes() for p in parts], pa.binary()))
            yield pa.record_batch(columns, names=["id", "row", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])


def pieces(docs: DataFrame, id_col: str, text_col: str, size: int = SEQUENCE, name: str = "byte_bpe_50k", with_ids: bool = False) -> DataFrame:
    """``(id, row, piece, start, length, ids_crc32[, ids])``; only the first piece of a cut text is shorter than ``size``."""
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(lambda b: _pieces(b, size, name, with_ids), schema)


class Bins:
    """Bins of one group of pieces, with the local search over the underfull ones."""

    def __init__(self, size: int, lengths: np.ndarray) -> None:
        self.size, self.lengths = size, np.asarray(lengths, np.int64)
        self.bin = np.full(len(self.lengths), -1, np.int64)
        self.fill = np.zeros(len(self.lengths) + 1, np.int64)
        self.items: dict[int, list[int]] = {}
        self.order: list[tuple[int, int]] = []  # (fill, bin) of the underfull bins, lightest first

    def put(self, pieces: list[int], b: int) -> None:
        """Move pieces, which lie in no bin or together in one, to bin ``b``."""
        old = int(self.bin[pieces[0]])
        size = int(self.lengths[pieces].sum())
        for at, change in ((old, -size), (b, size)):
            if at < 0:
                continue
            known = (int(self.fill[at]), at)
            place = bisect_left(self.order, known)
            if place < len(self.order) and self.order[place] == known:
                del self.order[place]
            self.fill[at] += change
            if 0 < self.fill[at] < self.size:
                insort(self.order, (int(self.fill[at]), at))
        if old >= 0:
            self.items[old] = [x for x in self.items[old] if x not in pieces]
            if not self.items[old]:
                del self.items[old]
        self.items.setdefault(b, []).extend(pieces)
        self.bin[pieces] = b

    def _fullest(self, length: int, but: int = -1) -> int:
        """The fullest underfull bin that still holds a piece, else -1."""
        i = bisect_left(self.order, (self.size - length + 1, -1)) - 1
        if i >= 0 and self.order[i][1] == but:
            i -= 1
        return self.order[i][1] if i >= 0 else -1

    def best_fit(self) -> None:
        """Each piece, longest first, to the fullest bin that still holds it."""
        for x in np.argsort(-self.lengths, kind="stable"):
            b = self._fullest(int(self.lengths[x]))
            self.put([int(x)], b if b >= 0 else len(self.items))

    def least(self) -> int:
        """A bound: pieces of more than half a sequence never share one."""
        return max(-(-int(self.lengths.sum()) // self.size), int((2 * self.lengths > self.size).sum()))

    def search(self) -> None:
        """Move and exchange pieces while that raises the sum of the squared fills, the lightest bins first,
        until no single step of any bin does, or the number of bins has reached its bound.

        Every step raises an integer below ``bins * size ** 2``, so the search ends.
        """
        least, changed = self.least(), True
        while changed:
            changed = False
            for light in [b for _, b in self.order]:
                while len(self.items) > least and light in self.items and (self._move(light) or self._exchange(light)):
                    changed = True
                if len(self.items) <= least:
                    return

    def _move(self, light: int) -> bool:
        fill = int(self.fill[light])
        for x in sorted(self.items[light], key=lambda x: -self.lengths[x]):
            length = int(self.lengths[x])
            b = self._fullest(length, light)
            # Into a bin at least as full as what stays behind, so the squares rise.
            if b >= 0 and int(self.fill[b]) > fill - length:
                self.put([x], b)
                return True
        return False

    def _exchange(self, light: int) -> bool:
        """Give a longer piece, or two pieces, for one piece of a bin at least as full: the best such
        exchange with any bin. The rise grows with the gain, so for each piece the largest sum that fits is it."""
        mine = np.array(self.items[light])
        own = self.lengths[mine]
        first, second = np.triu_indices(len(mine), 1)
        first, second = np.concatenate((np.arange(len(mine)), first)), np.concatenate((np.full(len(mine), -1), second))
        sums, which = np.unique(np.where(second < 0, own[first], own[first] + own[second]), return_index=True)
        fill = self.fill[self.bin]
        place = np.searchsorted(sums, self.lengths + self.size - fill, "right") - 1
        gain = sums[np.maximum(place, 0)] - self.lengths
        other = fill - self.fill[light]
        rise = np.where((place >= 0) & (gain > 0) & (other >= 0) & (fill < self.size) & (self.bin != light), gain * (other + gain), 0)
        y = int(rise.argmax())
        if rise[y] <= 0:
            return False
        chosen = which[place[y]]
        b, give = int(self.bin[y]), [int(mine[first[chosen]])] + ([int(mine[second[chosen]])] if second[chosen] >= 0 else [])
        self.put([y], light)
        self.put(give, b)
        return True


def _packed(group: pd.DataFrame, size: int) -> pd.DataFrame:
    """Bins of one group; pieces that share a ``bin`` already stay movable documents."""
    group = group.sort_values(["row", "piece"], kind="stable").reset_index(drop=True)
    bins = Bins(size, group["length"].to_numpy())
    if (group["bin"] >= 0).all():
        for number, (_, at) in enumerate(group.groupby("bin").indices.items()):
            bins.put([int(i) for i in at], number)
    else:
        bins.best_fit()
    bins.search()
    return group.assign(bin=(group["group"].to_numpy() << 32) + bins.bin, fill=bins.fill[bins.bin])


_FIELDS = ["id", "row", "piece", "start", "length", "ids_crc32", "bin", "fill", "group"]


def _round(rows: DataFrame, size: int) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, piece int, start long, length long, ids_crc32 long, bin long, fill long, group long"
    return rows.select(_FIELDS).groupBy("group").applyInPandas(lambda g: _packed(g, size)[_FIELDS], schema)


@cleaned
def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, name: str = "byte_bpe_50k", group: int = GROUP) -> DataFrame:
    """Place every piece of every row: ``(id_col, piece, start, length, ids_crc32, sequence_id, offset)``.

    A null text is empty: one piece holding the end id. Rows with one id are packed each on its own.
    Other columns are ignored. Sequence ids are distinct numbers without further meaning; within a
    sequence the offsets run from 0 without gaps.
    """
    cut = stored(pieces(docs, id_col, text_col, size, name), "pieces")
    blank = F.lit(-1).cast("long")
    whole = cut.where(F.col("length") == size).select("*", blank.alias("bin"), F.col("length").alias("fill"), blank.alias("group"))
    open_ = cut.where(F.col("length") < size)
    n = max(1, round(open_.count() / group))
    first = stored(_round(open_.select("*", blank.alias("bin"), blank.alias("fill"), F.pmod(F.xxhash64("row", "piece"), F.lit(n)).alias("group")), size), "packed")
    light = first.where(F.col("fill") < size)
    n = max(1, round(light.count() / group))
    second = _round(light.withColumn("group", F.pmod(F.xxhash64(F.col("bin")), F.lit(n))), size)
    # The pieces of a bin, in a stable order, one after another.
    full = first.where(F.col("fill") == size)
    done = full.select("*", F.lit(0).alias("kind")).unionByName(second.select("*", F.lit(1).alias("kind")))
    listed = done.groupBy("kind", "bin").agg(F.array_sort(F.collect_list(F.struct("row", "piece", "id", "start", "length", "ids_crc32"))).alias("items"))
    starts = F.aggregate(
        "items", F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x["length"])
    )
    placed = listed.select("kind", "bin", F.posexplode(F.arrays_zip("items", F.slice(starts, 1, F.size("items")).alias("offset"))).alias("at", "x"))
    number = F.col("bin") * 2 + F.col("kind")
    packed = placed.select(
        F.col("x.items.id").alias(id_col), F.col("x.items.piece").alias("piece"), F.col("x.items.start").alias("start"),
        F.col("x.items.length").alias("length"), F.col("x.items.ids_crc32").alias("ids_crc32"), number.alias("sequence_id"), F.col("x.offset").alias("offset"),
    )
    # A sequence of one full piece needs no packing; its number is negative.
    single = whole.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(single)
