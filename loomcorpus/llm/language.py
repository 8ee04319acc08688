"""Language identification by prediction by partial matching (PPM) over byte contexts.

For each language a variable-order context tree over the last ``ORDER`` bytes is counted from a
bounded sample of labelled texts. Its statistics are then frozen. The code length of a byte in a
context is that of PPM with escape method C: ``n / (N + d)`` for a byte seen ``n`` times among
``N`` in that context with ``d`` distinct followers, else ``d / (N + d)`` for the escape and on to
the context one byte shorter; a context never seen costs nothing, and below order 0 all 256 bytes are
equally likely. As the statistics are frozen, the length depends on the last bytes alone, so the
code lengths of the contexts and bytes that were seen are compiled into sparse tables, hashed by their bytes,
and texts are scored by array look-ups, in Arrow batches. The language of least total code length wins.

All 256 bytes are told apart, but A-Z are lower-cased. A text is preceded by newlines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcorpus.llm.common import scratch, stored
from loomcorpus.llm.shingles import chunks

#: Bytes of the longest context; a context and the byte after it are one 32-bit number.
ORDER = 3
#: Bound of the fit: so many labelled texts of a language, taken by a hash of the id.
TEXTS_PER_LANGUAGE = 400
_START = 0x0A
_TEXT = "_scored_text"


@dataclass(frozen=True)
class Model:
    """The languages, and of each the ``ORDER + 1`` byte grams seen (rising) and their counts."""

    languages: tuple[str, ...]
    grams: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]


def byte_grams(buffer: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of each row with the ``ORDER`` bytes before it in its row (newlines before its start),
    and the bounds of the rows. The newline behind each row is left out."""
    ends = np.append(row_starts[1:], len(buffer)) - 1
    place = np.arange(len(buffer)) - np.repeat(row_starts, ends + 1 - row_starts)
    grams = buffer.astype(np.uint32)
    for back in range(1, ORDER + 1):
        before = np.full(len(buffer), _START, np.uint32)
        before[back:] = buffer[:-back] if back < len(buffer) else 0
        before[place < back] = _START
        grams |= before << np.uint32(8 * back)
    keep = np.ones(len(buffer), bool)
    keep[ends] = False
    return grams[keep], np.concatenate(([0], np.cumsum(ends - row_starts)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts of each language in each batch."""
    for batch in batches:
        for lang in sorted(set(batch.column("lang").to_pylist())):
            texts = batch.filter(pc.equal(batch.column("lang"), lang)).column("text")
            parts = [byte_grams(buffer, starts)[0] for _, _, buffer, starts in chunks(texts)]
            grams, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.record_batch([pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count the context trees of every language of ``labelled``.

    At most ``TEXTS_PER_LANGUAGE`` texts of a language are used, whole: those of least hash of their
    id. Null texts and languages are left out, and an id counts once. What comes to the driver
    is the counts of the grams seen in that sample, in practice some ten thousand a language.
    """
    rows = labelled.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    # A threshold that so many ids are expected to pass, and some to spare, before any are ranked.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    share = (F.col("h") / float(1 << 64) + 0.5) * F.col("size")
    near = rows.select("h", "lang").join(F.broadcast(sizes), "lang").where(share < 2 * TEXTS_PER_LANGUAGE + 50).select("lang", "h").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = near.withColumn("place", place).where(F.col("place") <= TEXTS_PER_LANGUAGE).select("lang", "h")
    with scratch(labelled.sparkSession):
        sample = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
        counted = stored(sample.repartition(8).select("lang", "text"), "sample").mapInArrow(_counted, "lang string, gram long, n long")
        found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = tuple(sorted(found["lang"].unique())) if len(found) else ()
    by = [found[found["lang"] == lang].sort_values("gram") for lang in langs]
    return Model(langs, tuple(g["gram"].to_numpy(np.int64).astype(np.uint32) for g in by), tuple(g["n"].to_numpy(np.int64) for g in by))


class Sparse:
    """Values of 32-bit keys in an open hash table that whole arrays are looked up in."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint32)
        self.values = np.full(1 << self.bits, np.nan, np.float32)
        todo, slots = np.arange(len(keys)), self._slots(keys)
        while len(todo):
            free = np.isnan(self.values[slots])
            self.keys[slots[free]], self.values[slots[free]] = keys[todo[free]], values[todo[free]]
            lost = self.keys[slots] != keys[todo]
            todo, slots = todo[lost], (slots[lost] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys, NaN where there is none."""
        slots = self._slots(keys)
        out = self.values[slots]
        todo = np.flatnonzero((self.keys[slots] != keys) & ~np.isnan(out))
        slots = slots[todo]
        while len(todo):
            slots = (slots + 1) & ((1 << self.bits) - 1)
            value = self.values[slots]
            out[todo] = value
            go = (self.keys[slots] != keys[todo]) & ~np.isnan(value)
            todo, slots = todo[go], slots[go]
        return out


class Tree:
    """The frozen context tree of one language, compiled: for each order the code lengths of the
    contexts and bytes seen, and of the escapes of the contexts seen."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.seen: list[Sparse] = []
        self.escape: list[Sparse] = []
        for order in range(ORDER + 1):
            keys, inverse = np.unique(grams & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
            n = np.bincount(inverse, weights=counts)
            contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
            total, distinct = np.bincount(of, weights=n), np.bincount(of)
            self.seen.append(Sparse(keys, -np.log2(n / (total + distinct)[of])))
            self.escape.append(Sparse(contexts.astype(np.uint32), -np.log2(distinct / (total + distinct))))

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram after the bytes before it."""
        bits = np.zeros(len(grams), np.float64)
        todo = np.arange(len(grams))
        for order in range(ORDER, -1, -1):
            keys = grams[todo] & np.uint32((1 << 8 * (order + 1)) - 1 if order < 3 else 0xFFFFFFFF)
            found = self.seen[order].find(keys)
            met = ~np.isnan(found)
            bits[todo[met]] += found[met]
            todo = todo[~met]
            bits[todo] += np.nan_to_num(self.escape[order].find(keys[~met] >> np.uint32(8)))
        bits[todo] += 8.0
        return bits


_compiled: dict[str, tuple[Model, list[Tree]]] = {}


def trees(model: Model) -> list[Tree]:
    """The compiled trees of a model, built once in a Python worker."""
    known = _compiled.get("trees")
    same = known is not None and known[0].languages == model.languages and all(
        np.array_equal(a, b) for x, y in ((known[0].grams, model.grams), (known[0].counts, model.counts)) for a, b in zip(x, y, strict=True)
    )
    if not same:
        _compiled["trees"] = (model, [Tree(g, c) for g, c in zip(model.grams, model.counts, strict=True)])
    return _compiled["trees"][1]


def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    compiled = trees(model)
    for batch in batches:
        texts = batch.column(_TEXT)
        letters = np.array([t is not None and any(c.isalpha() for c in t) for t in texts.to_pylist()], bool)
        bits = np.zeros((len(batch), len(compiled)))
        for first, last, buffer, starts in chunks(texts):
            grams, bounds = byte_grams(buffer, starts)
            for i, tree in enumerate(compiled):
                sums = np.concatenate(([0.0], np.cumsum(tree.code_lengths(grams))))
                bits[first:last, i] = sums[bounds[1:]] - sums[bounds[:-1]]
        if not compiled:
            letters[:] = False
            bits = np.zeros((len(batch), 1))
        best = np.argmin(bits, axis=1)
        least = bits[np.arange(len(batch)), best]
        score = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
        langs = [model.languages[b] if known else "und" for b, known in zip(best, letters, strict=True)]
        columns = {name: batch.column(name) for name in batch.schema.names if name != _TEXT}
        made = [pa.array(langs, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(least, mask=~letters)]
        yield pa.record_batch([*columns.values(), *made], names=[*columns, "lang_pred", "score", "bits"])


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred``, ``score`` and ``bits``.

    ``score`` is the winner's share of ``2 ** -bits`` over all languages (0 to 1), ``bits`` the
    winner's code length. Null texts, texts without a letter, and every text where no language was
    learned give ``und``, score 0 and null bits. Equal code lengths: the first name wins.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias(_TEXT))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != _TEXT)
    return rows.mapInArrow(lambda b: _predicted(b, model), f"{fields}, lang_pred string, score double, bits double")


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 3; rows with 1 are held out."""
    return F.crc32(F.col(id_col).cast("string")) % 3


def _learned(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model:
    return fit(docs.where(F.coalesce(fold(id_col) != 1, F.lit(True))), id_col, text_col, lang_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id_col, held_out, lang_pred, score, bits)`` of every row: fit on the rows that are not held
    out, then predict every row.

    A null id is not held out. Repeated rows each get the same result; very long texts are scored whole;
    without rows to learn from every text is ``und``. See ``predict`` for nulls and ties.
    """
    held = F.coalesce(fold(id_col) == 1, F.lit(False)).alias("held_out")
    out = predict(docs, _learned(docs, id_col, text_col, lang_col), text_col, keep=(id_col,))
    return out.select(id_col, held, "lang_pred", "score", "bits")


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that are ``und`` (null, without a letter, nothing learned) and those
    in which no language has a share of ``least``, which are short texts that two languages explain alike.

    Columns of ``docs`` may have any names; repeated rows stay or go together.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    out = predict(rows, _learned(docs, id_col, text_col, lang_col), "text", keep=("row",))
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*[F.col(f"row.`{c}`") for c in docs.columns])
