"""N-gram Jaccard self-join by vertical partitioning, and the groups it links.

The sets are the distinct word shingles of each text, as 64-bit hashes. Vertical fragments, ranges
of a global order of the shingles, are worked on separately, and what they count is summed per text
or per pair:

* Pruning. Under the order of the hashes, two linked texts share at least ``k`` of the first
  ``n - ceil(t n) + k`` shingles of each (extended prefix filter, ``k`` about a quarter of a set). The prefixes are
  cut into fragments; each fragment counts, for every text, the shingles it shares with any
  other text, and a text whose sum stays below its ``k`` can't link and leaves. Texts that share only a
  passage with others leave here, however many share it. It is done once over all texts and once,
  with whole sets, over one text of each set that is left.
* Order. The fragments count the exact number of sets that hold each shingle that is left. The global
  order from here on is (size class of that number, hash), rarest first.
* Candidates. Two linked sets share a shingle among the first ``n - ceil(t n) + 1`` of each (prefix
  filter), and at the first shared one both rests are still long enough (positional filter).
* Verification. The order is cut into fragments of near equal numbers of shingles; the overlap of a
  pair is counted in each fragment on its own and summed, and pairs leave that can't link any more.

Groups of near copies don't give all their pairs. Each set is first compared with one hub, of those of
its prefix shingles (the set in a shingle's bucket whose shingles are held most often) the one it meets
most often. Only sets that still lie in different components after that are paired, within a
shingle and length band, if a parity sketch allows it, whose Hamming distance never exceeds the number of
elements in which two sets differ. A pair inside one component cannot change any component, so no
link between groups is lost and the components are exact. Equal sets are one node from the start.

The links of each text are counted afterwards, component by component, without writing pairs out.
Every set is reduced to what it differs in from one reference set of its component, which is little
among near copies; as ``x ^ y == (x ^ r) ^ (y ^ r)``, overlaps follow from these differences exactly.
Blocks of a component meet pairwise, each meeting in a task, and a node counts as often as it has copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import cleaned, connected_components, stored
from loomcorpus.llm.shingles import shingle_sets

#: Ids of texts that are broadcast to the scan at most (8 bytes each); more are joined by a shuffle.
MAX_SENT_IDS = 1 << 20
#: Bytes of text whose shingles one fragment of the pruning holds.
FRAGMENT_BYTES = 2 << 20
#: Texts whose sets travel together; below 2 ** 16 - 1.
SLICE = 512
#: Sets of one block when the links of a component are counted.
LINK_BLOCK = 1024
#: Shingles that are counted together in one matrix product.
_COLUMNS = 2048
_MANY = 0xFFFF
_SKETCH = ["sketch_0", "sketch_1", "sketch_2", "sketch_3"]
#: Equal ranges of the hashes in one size class: the cells at which the order can be cut.
_CELLS = 16


def _least(n: int, percent: int) -> int:
    """The least overlap of a set of ``n`` with any set it links with."""
    return -(-percent * n // 100)


def _extra(n: int, percent: int, whole: bool) -> int:
    """``k`` of the extended prefix filter; the prefix is the whole set where it is the least overlap."""
    return _least(n, percent) if whole else min(1 + n // 4, _least(n, percent))


def _coded(values: np.ndarray) -> bytes:
    """Rising values as differences, byte by byte: the upper bytes are zeros, which compress away."""
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _decoded(data: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(data.as_buffer(), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _bounds(fragments: int) -> np.ndarray:
    step = np.uint64(((1 << 64) - 1) // fragments)
    return np.arange(1, fragments, dtype=np.uint64) * step


def _parts(tokens: np.ndarray, bounds: np.ndarray) -> tuple[list[int], list[int]]:
    """The fragments that hold any of the sorted ``tokens``, and the cuts between them: the work is that of the tokens,
    however many fragments there are."""
    of = np.searchsorted(bounds, tokens, "right")
    starts = _runs(of)
    return of[starts].tolist(), [*starts.tolist(), len(tokens)]


def _digest(values: np.ndarray) -> tuple[int, int]:
    """Two sums over the set, independent of any order: its name for exact equality."""
    a = values * np.uint64(0x9FB21C651E98DF25)
    b = (values ^ (values >> np.uint64(29))) * np.uint64(0xDB4F0B9175AE2165)
    b ^= b >> np.uint64(31)
    return int((a ^ (a >> np.uint64(33))).sum(dtype=np.uint64).view(np.int64)), int((b * b).sum(dtype=np.uint64).view(np.int64))


def _parity(values: np.ndarray) -> np.ndarray:
    """``4 * 64`` bits: for each of 256 hash classes whether the set holds an odd number of it."""
    odd = np.bincount((values >> np.uint64(13)).astype(np.int64) & 255, minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)


_FIELDS = ["id", "n", "name_a", "name_b", "shared"]


def _sent(batches: Iterator[pa.RecordBatch], width: int, percent: int, fragments: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """The distinct prefix shingles of each slice of texts by fragment, with the place in the slice of
    the one text that holds it (``_MANY``: several do), and a row with the members of the slice."""
    number, bounds = TaskContext.get().partitionId() << 32, _bounds(fragments)
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            part = batch.slice(at, SLICE)
            sizes, names, heads = [], [], []
            for s in shingle_sets(part.column("text"), width):
                n = len(s)
                sizes.append(n)
                names.append(_digest(s))
                heads.append(s[: n - _least(n, percent) + _extra(n, percent, whole)].copy())
            flat, places = np.concatenate(heads), np.repeat(np.arange(len(heads)), [len(h) for h in heads])
            order = np.argsort(flat, kind="stable")
            flat, places = flat[order], places[order]
            starts = _runs(flat)
            counts = np.diff(np.append(starts, len(flat)))
            shared = np.bincount(places[np.repeat(counts > 1, counts)], minlength=len(heads))
            tokens, places = flat[starts], np.where(counts > 1, _MANY, places[starts]).astype(np.uint16)
            own, cuts = _parts(tokens, bounds)
            names = np.array(names, np.int64).reshape(-1, 2)
            fields = [part.column("id"), pa.array(sizes, pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(shared.astype(np.int64))]
            members = pa.StructArray.from_arrays(fields, names=_FIELDS)
            members = pa.ListArray.from_arrays(pa.array([0, len(part), *[len(part)] * len(own)], pa.int32()), members, mask=pa.array([False] + [True] * len(own)))
            yield pa.record_batch(
                [
                    pa.array([fragments + number % fragments, *own], pa.int32()), pa.array([number] * (len(own) + 1), pa.int64()), members,
                    pa.array([None] + [_coded(tokens[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                    pa.array([None] + [places[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                ],
                names=["fragment", "slice", "members", "tokens", "places"],
            )
            number += 1


def _counted(group: pa.Table, fragments: int) -> pa.Table:
    """The partial counts of one fragment: for each slice the texts with shingles that other slices
    hold too, and how many. The rows with members are passed on."""
    names, member = ["slice", "members", "places", "counts"], group.column("members").type
    if group.column("fragment")[0].as_py() >= fragments:
        none = pa.nulls(len(group), pa.binary())
        return pa.table([group.column("slice"), group.column("members"), none, none], names=names)
    tokens = [_decoded(x) for x in group.column("tokens")]
    owner = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
    flat = np.concatenate(tokens)
    places = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in group.column("places")]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    starts = _runs(flat[order])
    counts = np.diff(np.append(starts, len(flat)))
    shared = (counts > 1) | np.logical_or.reduceat(places[order] == _MANY, starts)
    met = order[np.repeat(shared, counts)]
    met = met[places[met] != _MANY]
    keys, times = np.unique((owner[met] << 16) + places[met], return_counts=True)
    slices, cuts = np.unique(keys >> 16, return_index=True)
    cuts = [*cuts, len(keys)]
    return pa.table(
        [
            group.column("slice").combine_chunks().take(pa.array(slices)), pa.nulls(len(slices), member),
            pa.array([(keys[a:b] & 0xFFFF).astype(np.uint16).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            pa.array([times[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        ],
        names=names,
    )


def _summed(group: pa.Table) -> pa.Table:
    """The members of one slice with the sums of their partial counts."""
    members, places, counts = None, [np.empty(0, np.uint16)], [np.empty(0, np.uint32)]
    for own, p, c in zip(group.column("members"), group.column("places"), group.column("counts"), strict=True):
        if own.is_valid:
            members = own.values
        else:
            places.append(np.frombuffer(p.as_buffer(), np.uint16))
            counts.append(np.frombuffer(c.as_buffer(), np.uint32))
    columns = members.flatten()
    more = np.bincount(np.concatenate(places), weights=np.concatenate(counts), minlength=len(members)).astype(np.int64)
    columns[4] = pa.array(columns[4].to_numpy() + more)
    return pa.table(columns, names=_FIELDS)


def shared_counts(texts: DataFrame, width: int, percent: int, whole: bool = False) -> DataFrame:
    """``(id, n, name_a, name_b, may_link)`` of every row of ``texts`` (id and text): the size and
    name of its set, and whether it shares enough of its prefix (of its ``whole`` set) with other
    rows to link at all."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    fragments = max(1, -(-size // FRAGMENT_BYTES))
    kind = texts.schema["id"].dataType.simpleString()
    members = f"members array<struct<id: {kind}, n: long, name_a: long, name_b: long, shared: long>>"
    sent = texts.mapInArrow(lambda b: _sent(b, width, percent, fragments, whole), f"fragment int, slice long, {members}, tokens binary, places binary")
    counted = sent.groupBy("fragment").applyInArrow(lambda t: _counted(t, fragments), f"slice long, {members}, places binary, counts binary")
    summed = counted.groupBy("slice").applyInArrow(_summed, f"id {kind}, n long, name_a long, name_b long, shared long")
    least = F.floor((percent * F.col("n") + 99) / 100)
    enough = (F.col("n") > 0) & (F.col("shared") >= (least if whole else F.least(1 + F.floor(least / 4), least)))
    return stored(summed.select("id", "n", "name_a", "name_b", enough.alias("may_link")), "counts")


def _among(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id is listed; few ids are sent to the scan."""
    ids = ids.select("id").distinct()
    return texts.join(F.broadcast(ids) if ids.count() <= MAX_SENT_IDS else ids, "id", "left_semi")


def _sliced_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The sets of some texts in one row."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, len(batch), SLICE // 8):
            part = batch.slice(at, SLICE // 8)
            sets = list(shingle_sets(part.column("text"), width))
            sizes = [len(s) for s in sets]
            names = np.array([_digest(s) for s in sets], np.int64).reshape(-1, 2)
            lists = [pa.array([v], pa.list_(pa.int64())) for v in (np.array(sizes, np.int64), names[:, 0], names[:, 1])]
            yield pa.record_batch([pa.array([number], pa.int64()), *lists, pa.array([np.concatenate(sets).tobytes()], pa.binary())], names=["slice", "n", "name_a", "name_b", "sets"])
            number += 1


_SLICED_SQL = "slice long, n array<long>, name_a array<long>, name_b array<long>, sets binary"


def _listed(batches: Iterator[pa.RecordBatch], fragments: int) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of each slice by fragment, with the number of its sets that hold each."""
    bounds = _bounds(fragments)
    for batch in batches:
        for number, sets in zip(batch.column("slice").to_pylist(), batch.column("sets"), strict=True):
            tokens, counts = np.unique(np.frombuffer(sets.as_buffer(), np.uint64), return_counts=True)
            own, cuts = _parts(tokens, bounds)
            parts = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.record_batch(
                [
                    pa.array(own, pa.int32()), pa.array([number] * len(own), pa.int64()),
                    pa.array([_coded(tokens[c]) for c in parts], pa.binary()), pa.array([counts[c].astype(np.uint32).tobytes() for c in parts], pa.binary()),
                ],
                names=["fragment", "slice", "tokens", "counts"],
            )


def _classed(group: pa.Table) -> pa.Table:
    """The size class of each shingle of one fragment: the bits of the number of sets that hold it."""
    tokens = [_decoded(x) for x in group.column("tokens")]
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in group.column("counts")])
    _, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.bincount(inverse, weights=counts)
    classes = np.frexp(total)[1].astype(np.uint8)[inverse]
    cuts = np.cumsum([0, *[len(x) for x in tokens]])
    parts = pa.array([classes[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())
    return pa.table([group.column("slice"), group.column("fragment"), parts], names=["slice", "fragment", "classes"])


def _ordered(group: pa.Table, percent: int) -> pa.Table:
    """The sets of one slice in the global order; ``prefix`` begins after ``alone`` unique shingles."""
    own = group.column("sets").is_valid().to_numpy()
    row = group.slice(int(np.flatnonzero(own)[0]), 1)
    rest = group.filter(pa.array(~own)).sort_by("fragment")
    classes = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in rest.column("classes")] or [np.empty(0, np.uint8)])
    flat = np.frombuffer(row.column("sets")[0].as_buffer(), np.uint64)
    of = classes[np.unique(flat, return_inverse=True)[1]]  # the fragments are ranges of the sorted distinct shingles
    columns = {k: row.column(k)[0].values for k in ("n", "name_a", "name_b")}
    cuts = np.cumsum([0, *columns["n"].to_pylist()])
    alone, weight, prefixes, tokens, cells, sketches = [], [], [], [], [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        order = np.argsort(of[a:b], kind="stable")  # the hashes rise already
        s, c = flat[a:b][order], of[a:b][order]
        unique = int((c <= 1).sum())
        alone.append(unique)
        weight.append(float(c.mean()) if len(c) else 0.0)
        prefixes.append(s[unique : max(unique, len(s) - _least(len(s), percent) + 1)].view(np.int64))
        tokens.append(s.tobytes())
        cells.append((c.astype(np.uint16) * _CELLS + (s >> np.uint64(60)).astype(np.uint16)).tobytes())
        sketches.append(_parity(s))
    sketches = np.array(sketches, np.int64).reshape(-1, 4)
    offsets = pa.array(np.cumsum([0, *[len(p) for p in prefixes]]).astype(np.int32))
    prefix = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*prefixes, np.empty(0, np.int64)])))
    columns |= {"alone": pa.array(alone, pa.int64()), "weight": pa.array(weight, pa.float64()), "prefix": prefix}
    columns |= {"tokens": pa.array(tokens, pa.binary()), "cells": pa.array(cells, pa.binary())}
    return pa.table(columns | {k: pa.array(sketches[:, i]) for i, k in enumerate(_SKETCH)})


_ORDERED_SQL = "n long, name_a long, name_b long, alone long, weight double, prefix array<long>, tokens binary, cells binary, " + ", ".join(f"{k} long" for k in _SKETCH)


def ordered_sets(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The set of every row of ``texts`` in the global order of (size class, hash)."""
    sets = stored(texts.select("text").mapInArrow(lambda b: _sliced_sets(b, width), _SLICED_SQL), "sets")
    size = sets.agg(F.coalesce(F.sum(F.octet_length("sets")), F.lit(0))).first()[0]
    fragments = max(1, -(-size // (2 * FRAGMENT_BYTES)))
    listed = sets.select("slice", "sets").mapInArrow(lambda b: _listed(b, fragments), "fragment int, slice long, tokens binary, counts binary")
    classed = listed.groupBy("fragment").applyInArrow(_classed, "slice long, fragment int, classes binary")
    both = sets.unionByName(classed, allowMissingColumns=True)
    return stored(both.groupBy("slice").applyInArrow(lambda t: _ordered(t, percent), _ORDERED_SQL), "ordered")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(65 * _CELLS, np.int64)
    for batch in batches:
        for cells in batch.column("cells"):
            total += np.bincount(np.frombuffer(cells.as_buffer(), np.uint16), minlength=len(total))
    own = np.flatnonzero(total)
    yield pa.record_batch([pa.array(own), pa.array(total[own])], names=["cell", "n"])


def _cuts(sets: DataFrame, fragments: int) -> np.ndarray:
    """The cells at which the global order is cut into fragments of near equal numbers of shingles."""
    rows = sets.select("cells").mapInArrow(_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most 65 * 16
    counts = np.zeros(65 * _CELLS + 1)
    for r in rows:
        counts[r.cell] = r.n
    sums = np.cumsum(counts)
    return np.unique(np.searchsorted(sums, sums[-1] * np.arange(1, fragments) / fragments, "right")).astype(np.uint16)


def _segments(batches: Iterator[pa.RecordBatch], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    count = len(cuts) + 1
    for batch in batches:
        pieces = []
        for tokens, cells in zip(batch.column("tokens"), batch.column("cells"), strict=True):
            places = np.searchsorted(np.frombuffer(cells.as_buffer(), np.uint16), cuts)
            pieces += [x.tobytes() for x in np.split(np.frombuffer(tokens.as_buffer(), np.uint64), places)]
        fragment = np.tile(np.arange(count, dtype=np.int32), len(batch))
        yield pa.record_batch([pa.array(np.repeat(batch.column("node").to_numpy(), count)), pa.array(fragment), pa.array(pieces, pa.binary())], names=["node", "fragment", "segment"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the overlap within one fragment to ``common``, and take its sizes off the rests."""
    for batch in batches:
        sums = {name: batch.column(name).to_numpy().copy() for name in ("common", "rest_a", "rest_b")}
        for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            sums["common"][i] += len(np.intersect1d(x, y, assume_unique=True))
            sums["rest_a"][i] -= len(x)
            sums["rest_b"][i] -= len(y)
        kept = ["a", "b", "na", "nb"]
        yield pa.record_batch([*[batch.column(k) for k in kept], *[pa.array(v) for v in sums.values()]], names=[*kept, *sums])


def _verified(pairs: DataFrame, segments: DataFrame, percent: int, fragments: int) -> DataFrame:
    """The pairs ``(a, b)`` whose summed partial overlaps reach the threshold.

    The fragments are counted one after another, the rarest shingles first; a pair that can't reach the
    threshold any more, whatever its rests share, isn't joined with further fragments.
    """
    alive = pairs.select("a", "b", "na", "nb", F.lit(0).cast("long").alias("common"), F.col("na").alias("rest_a"), F.col("nb").alias("rest_b"))
    for fragment in range(fragments):
        own = segments.where(F.col("fragment") == fragment)
        met = alive.join(own.select(F.col("node").alias("a"), F.col("segment").alias("left")), "a")
        met = met.join(own.select(F.col("node").alias("b"), F.col("segment").alias("right")), "b")
        kept = ["a", "b", "na", "nb", "common", "rest_a", "rest_b"]
        counted = met.select(*kept, "left", "right").mapInArrow(_overlaps, ", ".join(f"{k} long" for k in kept))
        reach = (100 + percent) * (F.col("common") + F.least("rest_a", "rest_b"))
        alive = stored(counted.where(reach >= percent * (F.col("na") + F.col("nb"))), "alive")
    return alive.select("a", "b")


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The symmetric difference of each set and the reference set of its component."""
    kept = ["c", "blocks", "block", "node", "n", "weight"]
    for batch in batches:
        for at in range(0, len(batch), 128):
            part = batch.slice(at, 128)
            both = zip(part.column("tokens"), part.column("reference"), strict=True)
            differ = [np.setxor1d(*[np.frombuffer(v.as_buffer(), np.uint64) for v in xy], assume_unique=True).tobytes() for xy in both]
            yield pa.record_batch([*[part.column(k) for k in kept], pa.array(differ, pa.binary())], names=[*kept, "differ"])


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The number of values that each array of ``x`` shares with each of ``y``."""
    out = np.zeros((len(x), len(y)), np.float32)
    flat, rows = [np.concatenate(z) for z in (x, y)], [np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (x, y)]
    # Values on one side only are in no overlap.
    both = np.intersect1d(flat[0], flat[1])
    if x is y:
        both, times = np.unique(flat[0], return_counts=True)
        both = both[times > 1]
    if not len(both):
        return out
    sides = []
    for v, r in zip(flat, rows, strict=True):
        place = np.minimum(np.searchsorted(both, v), len(both) - 1)
        met = both[place] == v
        order = np.argsort(place[met], kind="stable")
        sides.append((place[met][order], r[met][order]))
    for low in range(0, len(both), _COLUMNS):
        dense = []
        for (place, r), z in zip(sides, (x, y), strict=True):
            first, end = np.searchsorted(place, (low, low + _COLUMNS))
            cells = np.zeros((len(z), min(_COLUMNS, len(both) - low)), np.float32)
            cells[r[first:end], place[first:end] - low] = 1
            dense.append(cells)
        out += dense[0] @ dense[1].T
    return out


def _met_links(table: pa.Table, percent: int) -> pa.Table:
    """``(node, links)`` from the meetings of two blocks (or of one with itself) that ``table`` holds."""
    found: list[list[np.ndarray]] = [[np.empty(0, np.int64)] * 2]
    table = table.sort_by([("c", "ascending"), ("block", "ascending")])
    cols = {k: table.column(k).to_numpy() for k in ("c", "block", "node", "n", "weight")}
    differ = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("differ")]
    for at in np.split(np.arange(len(differ)), np.flatnonzero(np.diff(cols["c"])) + 1):
        blocks = np.unique(cols["block"][at])
        x = at[cols["block"][at] == blocks[0]] if len(blocks) else at
        same = len(blocks) < 2
        if same and int(table.column("low")[0].as_py()) != int(table.column("high")[0].as_py()):
            continue  # the other block is empty
        y = x if same else at[cols["block"][at] == blocks[1]]
        dx = [differ[i] for i in x]
        dy = dx if same else [differ[i] for i in y]
        rest = [np.array([len(v) for v in d], np.int64) for d in (dx, dy)]
        apart = rest[0][:, None] + rest[1][None, :] - 2 * _common(dx, dy).astype(np.int64)
        total = cols["n"][x][:, None] + cols["n"][y][None, :]
        # |x & y| = (total - apart) / 2 and |x | y| = (total + apart) / 2.
        linked = 100 * (total - apart) >= percent * (total + apart)
        if same:
            np.fill_diagonal(linked, False)
        found.append([cols["node"][x], linked.astype(np.int64) @ cols["weight"][y]])
        if not same:
            found.append([cols["node"][y], linked.T.astype(np.int64) @ cols["weight"][x]])
    return pa.table([pa.array(np.concatenate(v)) for v in zip(*found, strict=True)], names=["node", "links"])


def _link_counts(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(node, links)``: for each set the texts of other sets that it links with, where there are any.

    ``grouped`` has node, n, weight (its texts) and component ``c``. All links lie inside components.
    """
    sizes = grouped.groupBy("c").agg(F.count("*").alias("size")).where("size > 1")
    own = grouped.join(sizes, "c").withColumn("blocks", F.ceil(F.col("size") / LINK_BLOCK).cast("int")).drop("size")
    own = stored(own.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "blocks")
    # Any set may be the reference; the one whose shingles are held most is near to most.
    share = sets.select("node", F.col("weight").alias("share"))
    chosen = own.join(share, "node").groupBy("c", "blocks").agg(F.max(F.struct("share", (-F.col("node")).alias("last"))).alias("r"))
    chosen = chosen.select("c", "blocks", (-F.col("r.last")).alias("node"))
    tokens = sets.select("node", "tokens")
    reference = tokens.join(chosen, "node").select("c", F.col("tokens").alias("reference"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    held = tokens.join(own, "node").join(reference, ["c", "block"]).select("c", "blocks", "block", "node", "n", "weight", "tokens", "reference")
    differ = stored(held.mapInArrow(_differences, "c long, blocks int, block int, node long, n long, weight long, differ binary"), "differences")
    # Components of one block share tasks; of others each pair of blocks is a group of its own.
    single = differ.where("blocks = 1")
    tasks = max(1, -(-own.where("blocks = 1").count() // LINK_BLOCK))
    single = single.select("*", F.pmod(F.xxhash64("c"), F.lit(tasks)).alias("of"), F.lit(0).alias("low"), F.lit(0).alias("high"))
    pairs = differ.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select(*differ.columns, F.col("c").alias("of"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    met = [x.groupBy("of", "low", "high").applyInArrow(lambda t: _met_links(t, percent), "node long, links long") for x in (single, pairs)]
    return met[0].union(met[1]).groupBy("node").agg(F.sum("links").alias("links"))


def _may_link(percent: int, x: str, y: str) -> Column:
    """Length filter, and the positional filter at the first shared prefix shingle."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    need = percent * (n + m)
    rest = F.least(n - F.col(f"{x}.at"), m - F.col(f"{y}.at"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * rest >= need)


def _near(percent: int, x: str, y: str) -> Column:
    """Sets differ in at least as many elements as their parity sketches differ in bits."""
    differ = F.lit(0)
    for k in _SKETCH:
        differ = differ + F.bit_count(F.col(f"{x}.{k}").bitwiseXOR(F.col(f"{y}.{k}")))
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs of ``x`` and ``y`` (structs or aliases with node and n), the lower node first."""
    x, y = F.struct(F.col("x.node"), F.col("x.n")), F.struct(F.col("y.node"), F.col("y.n"))
    low, high = F.least(x, y), F.greatest(x, y)
    return met.select(low["node"].alias("a"), high["node"].alias("b"), low["n"].alias("na"), high["n"].alias("nb")).distinct()


def _components(sets: DataFrame, same: DataFrame, percent: int, fragments: int) -> DataFrame:
    """``(node, c)`` of every node in a component of two or more."""
    rows = sets.select("node", "n", "weight", "alone", F.posexplode("prefix").alias("place", "token"))
    rows = stored(rows.select("token", "node", "n", (F.col("alone") + F.col("place")).alias("at"), "weight"), "prefixes")
    cuts = _cuts(sets, fragments)
    segments = stored(sets.select("node", "tokens", "cells").mapInArrow(lambda b: _segments(b, cuts), "node long, fragment int, segment binary"), "segments")
    hubs = rows.groupBy("token").agg(F.max(F.struct("weight", (-F.col("node")).alias("last"), "n", "at")).alias("hub"), F.count("*").alias("held")).where("held > 1")
    hubs = hubs.select("token", F.struct((-F.col("hub.last")).alias("node"), "hub.n", "hub.at").alias("hub"))
    spokes = rows.join(hubs, "token").where("node <> hub.node").select(F.struct("node", "n", "at").alias("x"), F.col("hub").alias("y"))
    spokes = spokes.where(_may_link(percent, "x", "y")).groupBy(F.col("x.node").alias("node"), F.col("y.node").alias("hub"))
    spokes = spokes.agg(F.count("*").alias("met"), F.max("x.n").alias("n"), F.max("y.n").alias("m")).groupBy("node")
    best = spokes.agg(F.max(F.struct("met", (-F.col("hub")).alias("last"), "n", "m")).alias("b"))
    best = best.select(F.struct("node", F.col("b.n").alias("n")).alias("x"), F.struct((-F.col("b.last")).alias("node"), F.col("b.m").alias("n")).alias("y"))
    pairs = stored(_pairs(best), "pairs")
    parts = connected_components(_verified(pairs, segments, percent, len(cuts) + 1).union(same))

    known = sets.select("node", *_SKETCH).join(parts, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    placed = stored(rows.drop("weight").join(known, "node"), "placed")
    mixed = placed.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("token")
    # Sets that link differ in length by less than the ratio of two neighbouring bands.
    band = F.floor(F.log(101 / percent, F.col("n")))
    placed = stored(placed.join(mixed, "token", "left_semi").withColumn("band", band), "mixed")
    x, y = placed.alias("x"), placed.withColumn("own", F.col("band")).withColumn("band", F.explode(F.array("band", F.col("band") - 1))).alias("y")
    once = (F.col("y.own") > F.col("x.band")) | (F.col("x.node") < F.col("y.node"))
    met = (F.col("x.token") == F.col("y.token")) & (F.col("x.band") == F.col("y.band")) & (F.col("x.c") != F.col("y.c")) & once
    rest = _pairs(x.join(y, met & _may_link(percent, "x", "y") & _near(percent, "x", "y"))).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    more = _verified(stored(rest, "pairs"), segments, percent, len(cuts) + 1)
    # Those links join whole components: the second round runs on the components, not on the sets.
    side = lambda name: parts.select(F.col("node").alias(name), F.col("component").alias(f"c{name}"))
    upper = more.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    upper = connected_components(upper).select(F.col("node").alias("component"), F.col("component").alias("upper"))
    lower = parts.unionByName(upper.select(F.col("component").alias("node"), "component")).distinct()
    return lower.join(upper, "component", "left").select("node", F.coalesce("upper", "component").alias("c"))


@cleaned
def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, fragments: int = 4, count_links: bool = True
) -> DataFrame:
    """``(id_col, n_shingles, component_id, n_links)`` of every row of ``docs``.

    Two texts link when their shingle sets have ``100 |x & y| >= percent |x | y|``; component_id
    is the least id reachable by links. A text of fewer than ``width`` words is one shingle; null
    or wordless texts have an empty set and are their own component. Ids may be of any type that has an order
    and should be unique: rows that repeat an id count as one document that links where any of its texts does.
    Rows with a null id are returned with their set size, a null component and no links.
    ``n_links`` is the exact number of other texts that the row's text links with, equal sets among them;
    it is left out where ``count_links`` is false. Other columns of ``docs`` are ignored.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    name = ["name_a", "name_b", "n"]
    every = shared_counts(texts, width, percent)
    found = every.where("may_link and id is not null").select("id", *name)
    # Equal sets are one node.
    nodes = found.groupBy(*name).agg(F.min("id").alias("id"), F.countDistinct("id").alias("weight"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    live = shared_counts(_among(texts, nodes), width, percent, whole=True).where("may_link").select(*name).distinct()
    live = stored(nodes.join(live, name), "live")
    sets = ordered_sets(_among(texts, live), width, percent).dropDuplicates(name)
    sets = stored(sets.join(live.select("node", *name), name).drop("name_a", "name_b"), "node_sets")
    # Several texts of one id are one document.
    member = stored(found.join(nodes.select("node", *name), name).select("id", "node").distinct(), "member")
    least = member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("id", "a")
    same = member.join(least, "id").where("node > a").select("a", F.col("node").alias("b"))
    parts = _components(sets, same, percent, fragments)

    grouped = nodes.join(parts, "node", "left").select("node", "id", "n", "weight", F.coalesce("c", "node").alias("c"))
    grouped = stored(grouped, "grouped")
    named = grouped.join(grouped.groupBy("c").agg(F.min("id").alias("component")), "c").select("node", "component", "weight")
    if count_links:
        named = named.join(_link_counts(grouped.drop("id"), sets, percent), "node", "left")
        links = F.col("weight") - 1 + F.coalesce("links", F.lit(0).cast("long"))
        result = member.join(named.withColumn("linked", links), "node").groupBy("id").agg(F.min("component").alias("component"), F.max("linked").alias("linked"))
    else:
        result = member.join(named, "node").groupBy("id").agg(F.min("component").alias("component"))
    out = every.select("id", "n").join(result, "id", "left")
    columns = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")]
    return out.select(*columns, *[F.coalesce("linked", F.lit(0).cast("long")).alias("n_links")] * count_links)


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that are not the least id of their component; rows with a null id stay, and an
    empty table stays empty."""
    groups = jaccard_groups(docs, id_col, text_col, width, percent, count_links=False).where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    if groups.count() <= MAX_SENT_IDS:
        groups = F.broadcast(groups)
    return docs.join(groups, id_col, "left_anti").select(*docs.columns)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)
), r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), m AS (SELECT a, min(b) AS b FROM r GROUP BY a
), k AS (SELECT a, count(*) AS k FROM l GROUP BY a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id, coalesce(k.k, 0) AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = w.doc_id LEFT JOIN k ON k.a = w.doc_id
"""
