"""Fill-in-middle: texts cut in three at drawn units and put together again around sentinels.

A text is a row of units (its code points, or the matches of a pattern). It is divided into blocks of
``BLOCK`` code points, and a Fenwick tree over the blocks holds, for each, how many units begin in it and
how many code points those cover. A cut after ``k`` units is found by binary lifting over the tree, which
gives the block and the place of its first unit; only from there are units counted one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import cleaned

#: Code points of a block.
BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, how many are cut, and of those how many begin with their suffix.
CUT_RATE, SPM_RATE = 90, 20
SEED = "1"

_MADE = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


class Blocks:
    """The units of a text, found by number through a Fenwick tree over its blocks."""

    def __init__(self, text: str, unit: re.Pattern | None) -> None:
        self.text, self.unit = text, unit
        size = -(-len(text) // BLOCK)
        self.units, self.points = [0] * (size + 1), [0] * (size + 1)
        if unit is None:
            for b in range(1, size + 1):
                self.units[b] = self.points[b] = min(BLOCK, len(text) - (b - 1) * BLOCK)
        else:
            for m in unit.finditer(text):
                b = m.start() // BLOCK + 1
                self.units[b] += 1
                self.points[b] += m.end() - m.start()
        self.total = sum(self.units)
        for tree in (self.units, self.points):
            for b in range(1, size + 1):
                if (above := b + (b & -b)) <= size:
                    tree[above] += tree[b]

    def cut(self, k: int) -> int:
        """The code points of the first ``k`` units."""
        at, left, place = 0, k, 0
        step = 1 << len(self.units).bit_length()
        while step := step >> 1:
            if at + step < len(self.units) and self.units[at + step] <= left:
                at += step
                left -= self.units[at]
                place += self.points[at]
        if self.unit is None or left == 0:
            return place + left
        found = self.unit.finditer(self.text, place)
        for _ in range(left - 1):
            next(found)
        return next(found).end()


def unit_pattern(unit: str | None) -> re.Pattern | None:
    """``unit`` as it is matched left to right; a code point at which it doesn't match is a unit alone."""
    if unit is None:
        return None
    if re.fullmatch(unit, "") is not None:
        raise ValueError("a unit must not match the empty text")
    return re.compile(f"(?:{unit})|(?s:.)")


def _arranged(text: str, draws: tuple[int, int, int, int], unit: re.Pattern | None, cut_rate: int, spm_rate: int) -> tuple:
    blocks = Blocks(text, unit)
    n = blocks.total
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or draws[2] % 100 >= cut_rate:
        return n, "plain", None, None, text
    first, second = (blocks.cut(k) for k in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if draws[3] % 100 < spm_rate:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _mapped(batches: Iterator[pa.RecordBatch], text: str, unit: str | None, cut_rate: int, spm_rate: int) -> Iterator[pa.RecordBatch]:
    pattern = unit_pattern(unit)
    for batch in batches:
        texts = batch.column(text).to_pylist()
        draws = zip(*[batch.column(f"h{i}").to_pylist() for i in range(4)], strict=True)
        made = [_arranged(t or "", h, pattern, cut_rate, spm_rate) for t, h in zip(texts, draws, strict=True)]
        columns = [batch.column(c) for c in batch.schema.names if c[0] == "c"]
        names = [c for c in batch.schema.names if c[0] == "c"]
        new = [pa.array(list(values), pa.string() if kind == "string" else pa.int64()) for values, kind in zip(zip(*made, strict=True) if made else [[]] * len(_MADE), _MADE.values(), strict=True)]
        yield pa.record_batch([*columns, *new], names=[*names, *_MADE])


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str | None = None, cut_rate: int = CUT_RATE, spm_rate: int = SPM_RATE, seed: str = SEED
) -> DataFrame:
    """All rows and columns of ``docs`` with ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain) and ``output`` (in place of columns of these names).

    The draws come from the sha256 of ``seed:id``, so they depend on nothing else: rows that repeat an
    id and text get the same result, and a null id draws as an empty one. ``unit`` is a pattern of which
    the matches are units; without it every code point is one. Null texts are empty, and empty texts and
    those that hold a sentinel stay plain. Texts of any length are cut as a whole; an empty table gives
    an empty result.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *draws)
    kinds = ", ".join([*[f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in names.items()], *[f"{c} {kind}" for c, kind in _MADE.items()]])
    out = rows.mapInArrow(lambda b: _mapped(b, names[text_col], unit, cut_rate, spm_rate), kinds)
    return out.select(*[F.col(n).alias(c) for c, n in names.items() if c not in _MADE], *_MADE)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of, from it and the form alone."""
    parts = F.split(F.substring(output, len(PREFIX) + 1, 2**31 - 1), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(2)), F.get(parts, F.lit(1)))
    spm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(0)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


@cleaned
def middle_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` of every row."""
    out = fill_in_middle(docs.select(id_col, text_col), id_col, text_col)
    digest = [F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return out.select(id_col, "n", "form", "prefix_chars", "middle_chars", *digest)


SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents
), d AS (
  SELECT doc_id, text, length(text) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t
), f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM d
), p AS (SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1, n - b) AS suffix FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
