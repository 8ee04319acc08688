"""Repeated byte strings by a sparse enhanced suffix array and the interval tree of its common prefixes.

Texts are UTF-8 bytes. Of the ``k``-byte grams in every window of ``min_bytes`` the one of least hash (the
last of equal ones) is an anchor, so two equal windows hold the same anchor at the same place: the suffix
array needs only the suffixes that begin at anchors, one in about 70 bytes, and for each only the bytes that a
window around its anchor can reach.

Anchors whose gram occurs once leave. Where the whole reach of an anchor occurs twice, every window around
it is repeated, and nothing more is asked. What is left are the edges of repeats: their reach is read from
the texts, and Spark sorts it by gram and following bytes, which is the suffix array. Over it a
stack is kept of the intervals with a common prefix of ``right`` bytes. When one closes, its members
are ordered by the bytes before them, and their intervals with ``left`` common bytes are those that no byte before
extends; where ``left + right`` is ``min_bytes`` or more and the members don't all lie in one inner
interval, no byte behind does either, and they are a maximal repeat group with all its occurrences.

Grams with more than ``MAX_BUCKET`` different reaches don't meet in one task, and their windows aren't listed either. The
range of places that a window can have around the anchor is cut into ``PARTS``, for the first time where the reach is read
from its text; reaches can share a window of a part only if they agree in the bytes that all its windows hold. By these bytes
(their hashes, counted with partial sums first) the gram falls into smaller groups: a reach alone in its group has no repeated
window there, reaches of equal bytes have all of them and go on as one, groups of ``MAX_BUCKET`` or fewer are scanned as above,
and only the others are cut again, until a part is one window. So a reach is read as one row, or as ``PARTS`` of fewer bytes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import cleaned, sent, stored
from loomcorpus.llm.shingles import mix

#: Bytes that a repeated string must have.
MIN_BYTES = 200
#: Different reaches of one gram that are scanned in one task at most.
MAX_BUCKET = 1024
#: Parts that the windows of a group of more reaches are cut into at a time.
PARTS = 4
#: Rows of a per-text or per-window table that are broadcast at most; more are joined by a shuffle.
MAX_SENT = 500_000
_KEY = ["h", "i"]
_CHUNK = 1 << 19
_BASE = 0xA24BAED4963EE407
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = np.uint64((1 << 20) - 1)

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, 2 * _CHUNK), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def gram_bytes(min_bytes: int) -> int:
    """Bytes of a gram: a third of the least repeat, so that anchors are few and chance repeats of grams rare."""
    return max(1, min_bytes * 8 // 25)


def _pieces(texts: pa.Array, min_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, rows, begins, ends, first, last)``: bytes of some texts, with the row of each piece of text, its range
    in the bytes, and which range of it counts. Longer texts come in pieces that overlap by twice ``min_bytes``."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    sizes = np.diff(offsets)
    held: list[int] = []
    size = 0

    def joined() -> tuple:
        ends = np.cumsum(sizes[held])
        buffer = np.concatenate([data[offsets[r] : offsets[r + 1]] for r in held])
        return buffer, np.array(held), ends - sizes[held], ends, ends - sizes[held], ends, np.zeros(len(held), np.int64)

    for row in np.flatnonzero(sizes >= min_bytes):
        if sizes[row] > _CHUNK:
            for begin in range(0, int(sizes[row]), _CHUNK):
                low, high = max(0, begin - 2 * min_bytes), min(int(sizes[row]), begin + _CHUNK + 2 * min_bytes)
                part = data[offsets[row] + low : offsets[row] + high]
                yield part, np.array([row]), np.array([0]), np.array([len(part)]), np.array([begin - low]), np.array([begin - low + _CHUNK]), np.array([low])
            continue
        if held and size + sizes[row] > _CHUNK:
            yield joined()
            held, size = [], 0
        held.append(int(row))
        size += int(sizes[row])
    if held:
        yield joined()


def anchors_of(texts: pa.Array, min_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, place, gram hash, reach hash)`` of the anchors of the texts, in parts."""
    k = gram_bytes(min_bytes)
    width = min_bytes - k + 1
    for buffer, rows, begins, ends, first, last, shift in _pieces(texts, min_bytes):
        n = len(buffer)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
        down = _power(_INVERSE, n)
        grams = mix((sums[k:] - sums[:-k]) * down[: n - k + 1])
        least = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
        wide = 1
        while 2 * wide <= width:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < width:
            least = np.minimum(least[: len(least) - (width - wide)], least[width - wide :])
        # Windows that cross the end of a text are none.
        whole = np.zeros(n + 1, dtype=np.int8)
        whole[begins] = 1
        np.add.at(whole, ends - min_bytes + 1, -1)
        places = (_PLACE - (least & _PLACE))[np.cumsum(whole[: len(least)], dtype=np.int8) > 0].astype(np.int64)
        if len(places):
            places = places[np.append(True, places[1:] != places[:-1])]
        of = np.searchsorted(ends, places, "right")
        kept = (places >= first[of]) & (places < last[of])
        places, of = places[kept], of[kept]
        left = np.minimum(places - begins[of], min_bytes - k)
        right = np.minimum(ends[of] - places, min_bytes)
        reach = (sums[places + right] - sums[places - left]) * down[places - left]
        reach = mix(reach + (left * 1_000_003 + right).astype(np.uint64))
        yield rows[of], places - begins[of] + shift[of], grams[places].view(np.int64), reach.view(np.int64)


def _gram_counts(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [g for _, _, g, _ in anchors_of(batch.column("text"), min_bytes)]
        grams, counts = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
        yield pa.record_batch([pa.array(grams), pa.array(counts.astype(np.int64))], names=["g", "n"])


def _anchors(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, i = (batch.column(c).to_numpy() for c in _KEY)
        for row, place, gram, reach in anchors_of(batch.column("text"), min_bytes):
            yield pa.record_batch([pa.array(x) for x in (h[row], i[row], place, gram, reach)], names=[*_KEY, "pos", "g", "f"])


def _parts_of(left: bytes, right: bytes, low: int, high: int, min_bytes: int, parts: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """``(low, high, left, right)`` for each part of a reach's windows, those of ``low`` to ``high`` bytes at or behind the anchor, in
    which it has any, with only the bytes of these."""
    for n in range(parts):
        first, last = (low + (high - low + 1) * x // parts for x in (n, n + 1))
        ahead, behind = left[: min_bytes - first], right[: last - 1]
        if first < last and len(ahead) + len(behind) >= min_bytes:
            yield first, last - 1, ahead, behind


_PART = "h long, i long, pos long, g long, hot boolean, low int, high int, left binary, right binary"


def _part_batch(made: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 4, pa.bool_(), *[pa.int32()] * 2, *[pa.binary()] * 2]
    columns = list(zip(*made, strict=True)) or [()] * len(kinds)
    return pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _PART.split(", ")])


def _reaches(batches: Iterator[pa.RecordBatch], min_bytes: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The bytes around each asked anchor: up to a window before its gram's end, reversed, and a window from its start; in
    parts if its gram is hot."""
    k = gram_bytes(min_bytes)
    for batch in batches:
        made: list[tuple] = []
        for h, i, text, asked in zip(*[batch.column(c).to_pylist() for c in (*_KEY, "text", "asked")], strict=True):
            data = text.encode()
            for a in asked:
                pos, hot = a["pos"], a["hot"]
                left, right = data[max(0, pos - min_bytes + k) : pos][::-1], data[pos : pos + min_bytes]
                cut = _parts_of(left, right, k, min_bytes, min_bytes, parts) if hot else [(k, min_bytes, left, right)]
                made.extend((h, i, pos, a["g"], hot, *part) for part in cut)
        yield _part_batch(made)


def _parts(batches: Iterator[pa.RecordBatch], min_bytes: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Parts of the parts of hot grams."""
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in (*_KEY, "pos", "g", "low", "high", "left", "right")], strict=True)
        yield _part_batch([(*key, True, *part) for *key, low, high, left, right in rows for part in _parts_of(left, right, low, high, min_bytes, parts)])


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """``(depth, first, last)`` of the intervals of a sorted list that share a prefix of at least ``least``, inner
    ones first; ``common`` has the common prefix of each neighbouring pair."""
    stack: list[tuple[int, int]] = []  # depth and first member of the open intervals
    for x, shared in enumerate([*common, -1]):
        first = x
        while stack and stack[-1][0] > shared:
            depth, first = stack.pop()
            yield depth, first, x
        if shared >= least and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))


def repeat_groups(lefts: list[bytes], rights: list[bytes], min_bytes: int, widest: bool = False) -> Iterator[tuple[int, int, list[int]]]:
    """``(left, right, members)`` of the maximal repeat groups around one gram.

    ``rights`` are the sorted suffixes, ``lefts`` the reversed bytes before each; the members of a group share
    ``left + right`` bytes, at least ``min_bytes``, are all that do, and go on differently on both sides.
    ``widest``: only groups that reach farther than all longer ones for some member.
    """
    n = len(rights)
    by_left = sorted(range(n), key=lefts.__getitem__)
    rank = [0] * n
    for place, x in enumerate(by_left):
        rank[x] = place
    behind = [_common(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:], strict=False)]
    inner, reached = list(range(n)), [-1] * n  # the closed interval of each suffix, and its farthest left reach
    ahead = [_common(a, b) for a, b in zip(rights, rights[1:], strict=False)]
    for name, (right, first, last) in enumerate(_intervals(ahead, 1), n):
        order = sorted(range(first, last + 1), key=rank.__getitem__)
        shared = [min(behind[rank[a] : rank[b]]) for a, b in zip(order, order[1:], strict=False)]
        changes = [0]
        for a, b in zip(order, order[1:], strict=False):
            changes.append(changes[-1] + (inner[a] != inner[b]))
        for left, low, high in _intervals(shared, max(0, min_bytes - right)):
            # All members inside one inner interval share more than this one's prefix: not maximal.
            if changes[high] == changes[low]:
                continue
            members = order[low : high + 1]
            if widest and not any(left > reached[m] for m in members):
                continue
            for m in members:
                reached[m] = max(reached[m], left)
            yield left, right, members
        for m in range(first, last + 1):
            inner[m] = name


_FOUND = "h long, i long, pos long, left int, right int, group long"


def _scanned(batches: Iterator[pa.RecordBatch], min_bytes: int, widest: bool) -> Iterator[pa.RecordBatch]:
    """The occurrences of all maximal repeat groups of rows sorted by gram and following bytes."""
    bucket: list[tuple] = []
    made: list[tuple] = []

    def groups() -> None:
        if len(bucket) < 2:
            return
        for left, right, members in repeat_groups([r[4] for r in bucket], [r[5] for r in bucket], min_bytes, widest):
            some = bucket[members[0]]
            digest = hashlib.blake2b(some[4][:left][::-1] + some[5][:right], digest_size=8).digest()
            name = int.from_bytes(digest, "little", signed=True)
            made.extend((*bucket[m][:3], left, right, name) for m in members)

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*made, strict=True)) or [()] * 6
        made.clear()
        kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()]
        return pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["h", "i", "pos", "left", "right", "group"])

    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in (*_KEY, "pos", "g", "left", "right")], strict=True):
            if bucket and bucket[-1][3] != row[3]:
                groups()
                bucket.clear()
            if not bucket or bucket[-1] != row:  # rows of one id and text were read twice
                bucket.append(row)
        yield batch_of()
    groups()
    yield batch_of()


def _pack(exact: int, left: Column, right: Column) -> Column:
    """An anchor's place, whether its edges were looked up, and its reach, as one long."""
    return F.col("pos") * (1 << 33) + F.lit(exact) * (1 << 32) + left.cast("long") * (1 << 16) + right.cast("long")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The disjoint ranges that the packed anchors of each text cover, sorted, as starts and ends."""
    for batch in batches:
        starts, ends = [], []
        for packed in batch.column("packed"):
            x = np.sort(packed.values.to_numpy())
            pos, exact = x >> 33, (x >> 32) & 1
            # Of an anchor that was looked up, only what was found counts.
            known = np.unique(pos[exact == 1])
            x, pos = (v[(exact == 1) | ~np.isin(pos, known)] for v in (x, pos))
            left, right = (x >> 16) & 0xFFFF, x & 0xFFFF
            covers = (left + right) > 0
            low, high = (pos - left)[covers], (pos + right)[covers]
            order = np.argsort(low, kind="stable")
            low, high = low[order], np.maximum.accumulate(high[order]) if len(low) else high[order]
            new = np.append(True, low[1:] > high[:-1]) if len(low) else np.empty(0, bool)
            starts.append(np.maximum(low[new], 0).tolist())
            ends.append(high[np.append(new[1:], True)].tolist() if len(low) else [])
        kind = pa.list_(pa.int64())
        yield pa.record_batch([batch.column("h"), batch.column("i"), pa.array(starts, kind), pa.array(ends, kind)], names=[*_KEY, "starts", "ends"])


def _key(id_col: str, text: Column) -> list[Column]:
    """A text by two hashes, of which the second also tells copies under other ids apart."""
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(7), text, F.col(f"`{id_col}`")).alias("i")]


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*_key(id_col, _text(text_col)), _text(text_col).alias("text"))


def _edges(texts: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The anchors whose gram is repeated, those of them that are edges, and the reaches to compare (``asked``)."""
    grams = texts.select("text").mapInArrow(lambda b: _gram_counts(b, min_bytes), "g long, n long")
    grams = grams.groupBy("g").agg(F.sum("n").alias("n")).where("n > 1").select("g")
    anchors = texts.mapInArrow(lambda b: _anchors(b, min_bytes), "h long, i long, pos long, g long, f long")
    # Both sides are tables, so that Spark can split the partition of a gram that is everywhere.
    anchors = stored(anchors.join(stored(grams, "grams"), "g"), "anchors")
    reaches = anchors.groupBy("g", "f").agg(F.count("*").alias("n"), F.min(F.struct(*_KEY, "pos")).alias("at"))
    reaches = stored(reaches.select("g", "n", "at.*"), "reaches")
    edges = reaches.where("n = 1").select(*_KEY, "pos")
    # A reach that occurs once is an edge; it is compared with all reaches of its gram.
    mixed = reaches.groupBy("g").agg(F.min("n").alias("least"), F.count("*").alias("members")).where("least = 1").select("g", "members")
    asked = stored(reaches.join(stored(mixed, "mixed"), "g").select(*_KEY, "pos", "g", "members"), "asked")
    return anchors, edges, asked


def _sent_lists(table: DataFrame, lists: str) -> DataFrame:
    """A stored table, marked for broadcast while it has at most ``MAX_SENT`` rows and four times as many list entries."""
    rows, entries = table.agg(F.count("*"), F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()
    return F.broadcast(table) if rows <= MAX_SENT and entries <= 4 * MAX_SENT else table


def _scan(rows: DataFrame, min_bytes: int, widest: bool) -> DataFrame:
    sorted_ = rows.select(*_KEY, "pos", "g", "left", "right").repartition("g").sortWithinPartitions("g", "right", "left", *_KEY, "pos")
    return sorted_.mapInArrow(lambda b: _scanned(b, min_bytes, widest), _FOUND)


def _grouped(parts: DataFrame, min_bytes: int) -> DataFrame:
    """Rows of ``_PART``; ``g`` of hot ones becomes that of the gram, the part and the bytes that all windows of the part share."""
    shared = F.expr(f"xxhash64(g, low, substring(left, 1, {min_bytes} - high), substring(right, 1, low))")
    return parts.withColumn("g", F.when(F.col("hot"), shared).otherwise(F.col("g")))


def _divided(parts: DataFrame, min_bytes: int) -> DataFrame:
    """``(h, i, pos, left, right, group)``: repeated windows of each anchor of a gram with too many reaches, the least and the
    greatest among them; ``group`` is null. ``parts`` are the stored first parts of their reaches."""
    found, few, n = [], [], PARTS
    while not parts.isEmpty():
        parts = parts.withColumns({"full": F.xxhash64("left", "right"), "at": F.xxhash64(*_KEY, "pos")})
        # Reaches of equal bytes have all their windows of the part repeated; one of them goes on for the others. Rows of one
        # id and text that were read twice are one reach.
        equal = stored(parts.groupBy("g", "full").agg(F.min("at").alias("first"), F.max("at").alias("last")), "equal")
        groups = equal.groupBy("g").agg(F.count("*").alias("members"), F.min("first").alias("first"), F.max("last").alias("last"))
        groups = sent(stored(groups.where("first <> last").select("g", "members"), "groups"), MAX_SENT)
        # One row for each group and for each set of equals: the joins keep or drop rows, and make none.
        parts = parts.join(groups, "g").join(sent(equal.where("first <> last").drop("last"), MAX_SENT), ["g", "full"], "left")
        parts = stored(parts.drop("full"), "parts")
        found.append(parts.where("first IS NOT NULL").select(*_KEY, "pos", F.length("left").alias("left"), F.length("right").alias("right")))
        mixed = parts.where("members > 1 AND (first IS NULL OR first = at)")
        few.append(mixed.where(f"members <= {MAX_BUCKET}"))
        parts = mixed.where(f"members > {MAX_BUCKET}").select(*_KEY, "pos", "g", "low", "high", "left", "right")
        parts = stored(_grouped(parts.mapInArrow(lambda b: _parts(b, min_bytes, n), _PART), min_bytes), "again")
    found.append(_scan(functools.reduce(DataFrame.union, few), min_bytes, True).drop("group"))
    ends = functools.reduce(DataFrame.union, found).groupBy(*_KEY, "pos").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    return ends.withColumn("group", F.lit(None).cast("long"))


def _found(texts: DataFrame, asked: DataFrame, min_bytes: int, widest: bool) -> DataFrame:
    """``(h, i, pos, left, right, group)``: the occurrences of the maximal repeat groups around the asked anchors. For a gram of
    too many reaches, the least and greatest repeated window of each anchor."""
    n, hot = PARTS, (F.col("members") > MAX_BUCKET).alias("hot")
    by_text = stored(asked.groupBy(*_KEY).agg(F.collect_list(F.struct("pos", "g", hot)).alias("asked")), "by_text")
    bytes_ = texts.join(_sent_lists(by_text, "asked"), _KEY).mapInArrow(lambda b: _reaches(b, min_bytes, n), _PART)
    bytes_ = stored(_grouped(bytes_, min_bytes), "reach_bytes")
    found, parts = _scan(bytes_.where("NOT hot"), min_bytes, widest), bytes_.where("hot")
    if not parts.isEmpty():
        found = found.union(_divided(parts, min_bytes).select(found.columns))
    return stored(found, "found")


@cleaned
def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(id_col, pos, left, right, group)``: the occurrences of maximal repeat groups at the edges of repeats.

    The members of ``group`` share the bytes from ``pos - left`` to ``pos + right``, ``pos`` being their anchor.
    One occurrence stands for those whose whole reach is equal. ``group`` is null where a gram has too
    many reaches to list groups; ``left`` and ``right`` are then those of the union of its repeated windows.
    """
    texts = _keyed(docs, id_col, text_col)
    _, _, asked = _edges(texts, min_bytes)
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), *_key(id_col, _text(text_col))).distinct()
    found = _found(texts, asked, min_bytes, False)
    return ids.join(found, _KEY).select(F.col("id").alias(id_col), "pos", "left", "right", "group")


@cleaned
def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(h, i, starts, ends)`` by text: the sorted disjoint byte ranges that repeated strings cover. An end may lie
    behind the text's."""
    texts = _keyed(docs, id_col, text_col)
    anchors, edges, asked = _edges(texts, min_bytes)
    zero, before = F.lit(0), min_bytes - gram_bytes(min_bytes)
    all_ = anchors.select(*_KEY, _pack(0, F.lit(before), F.lit(min_bytes)).alias("x"))
    # An edge counts as looked up also where nothing is found.
    all_ = all_.union(edges.select(*_KEY, _pack(1, zero, zero).alias("x")))
    found = _found(texts, asked, min_bytes, True).join(edges, [*_KEY, "pos"], "left_semi")
    all_ = all_.union(found.select(*_KEY, _pack(1, F.col("left"), F.col("right")).alias("x")))
    packed = all_.groupBy(*_KEY).agg(F.collect_set("x").alias("packed"))
    return packed.mapInArrow(_merged, "h long, i long, starts array<long>, ends array<long>").where("size(starts) > 0")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [c for c in batch.schema.names if c[0] == "c"]
        made: list[tuple] = []
        for text, starts, ends in zip(*[batch.column(c).to_pylist() for c in ("text", "starts", "ends")], strict=True):
            data = text.encode()
            ends = [min(e, len(data)) for e in ends or ()]
            kept = b"".join(data[a:b] for a, b in zip([0, *ends], [*(starts or ()), len(data)], strict=True))
            made.append((len(data), len(data) - len(kept), len(ends), kept))
        columns = list(zip(*made, strict=True)) or [()] * 4
        new = [pa.array(c, kind) for c, kind in zip(columns, [pa.int64()] * 3 + [pa.binary()], strict=True)]
        yield pa.record_batch([*[batch.column(c) for c in names], *new], names=[*names, *_MADE])


_MADE = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept": "binary"}


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the bytes
    left of the text (in place of columns of these names).

    Every byte is removed that lies in a string of ``min_bytes`` bytes which also starts anywhere else, in this
    document or another; all copies go. Null texts are empty; texts shorter than ``min_bytes`` stay whole.
    Rows that repeat id and text are copies of each other, as are rows with null ids. An empty table gives an
    empty result.
    """
    names = {c: f"c{n}" for n, c in enumerate(docs.columns)}
    ranges = _sent_lists(repeated_ranges(docs, id_col, text_col, min_bytes), "starts")
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], _text(text_col).alias("text"), *_key(id_col, _text(text_col)))
    rows = rows.join(ranges, _KEY, "left").drop(*_KEY)
    kinds = ", ".join([*[f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in names.items()], *[f"{c} {kind}" for c, kind in _MADE.items()]])
    out = rows.mapInArrow(_cut, kinds)
    return out.select(*[F.col(n).alias(c) for c, n in names.items() if c not in _MADE], *_MADE)


@cleaned
def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept_sha256)`` of every row; see ``remove_repeats``."""
    out = remove_repeats(docs.select(id_col, text_col), id_col, text_col, min_bytes)
    return out.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), n AS (SELECT doc_id, b, octet_length(b) AS n_bytes FROM d
), w AS (SELECT doc_id, i, b[i:i + 199] AS s FROM (SELECT doc_id, b, unnest(range(1, n_bytes - 198)) AS i FROM n WHERE n_bytes >= 200)
), r AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1
), p AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM w SEMI JOIN r USING (s)
), q AS (SELECT doc_id, min(i) AS a, max(i) + 199 AS z FROM p GROUP BY doc_id, k
), m AS (SELECT *, max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS y FROM q
), g AS (SELECT *, sum(CASE WHEN y IS NULL OR a > y + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a) AS k FROM m
), c AS (SELECT doc_id, min(a) AS a, max(z) AS z FROM g GROUP BY doc_id, k
), l AS (SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, list(a ORDER BY a) AS s, list(z ORDER BY a) AS e FROM c GROUP BY doc_id
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(CASE WHEN s IS NULL THEN b ELSE unhex(array_to_string(list_transform(range(1, len(s) + 2),
    lambda i: hex(b[CASE WHEN i = 1 THEN 1 ELSE e[i - 1] + 1 END:CASE WHEN i > len(s) THEN n_bytes ELSE s[i] - 1 END])), '')) END) AS kept_sha256
FROM n LEFT JOIN l USING (doc_id)
"""
