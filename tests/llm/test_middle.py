"""Fill-in-middle: cuts against plain counting, round trips, nulls, clashing names and repeated rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from loomcorpus.llm import middle


@pytest.mark.parametrize("unit", [None, r"\w+\s*", r"[^\n]*\n|[^\n]+", "a{3}"])
def test_cuts_equal_counting(unit, monkeypatch):
    monkeypatch.setattr(middle, "BLOCK", 7)
    draw = random.Random(4)
    for size in [0, 1, 6, 7, 8, 50, 333]:
        text = "".join(draw.choice("ab é😀\n") for _ in range(size))
        pattern = middle.unit_pattern(unit)
        units = list(text) if unit is None else [m.group() for m in re.finditer(f"(?:{unit})|(?s:.)", text)]
        blocks = middle.Blocks(text, pattern)
        assert blocks.total == len(units) and "".join(units) == text
        assert [blocks.cut(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_a_unit_is_not_empty():
    with pytest.raises(ValueError):
        middle.unit_pattern("a*")


def test_every_row_is_restored(spark):
    rows = [(i, "".join(random.Random(i).choice("xyz é\n<>PSM|") for _ in range(i % 40))) for i in range(300)]
    rows += [(None, "some text"), (1007, None), (1008, ""), (1009, "with <M> inside"), (1010, "long " * 50_000), (1011, "twice"), (1011, "twice")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, c0 string")
    for unit in (None, r"\w+\s*"):
        out = middle.fill_in_middle(docs, unit=unit)
        assert out.columns == ["doc_id", "text", "c0", "n", "form", "prefix_chars", "middle_chars", "output"]
        out = out.withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
        assert len(out) == len(rows) and all(r.back == (r.text or "") for r in out)
        assert all((r.form == "plain") == (r.prefix_chars is None) == (r.middle_chars is None) for r in out)
        assert all(r.form == "plain" for r in out if not r.text or "<M>" in r.text)
        assert len({(r.form, r.output) for r in out if r.doc_id == 1011}) == 1
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert middle.middle_digests(docs).count() == 0
