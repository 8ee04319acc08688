"""Broken arrays of objects: one object is broken at random, all others come back."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from loomcorpus.functions import semistructured as J
from loomcorpus.sources import readers


def test_named_cases():
    whole = lambda raw: json.loads(J._whole_objects(raw) or "null")
    assert whole('[{"a":1},{"b":,},{"c":3}]') == [{"a": 1}, {"c": 3}]
    assert whole('[{"a":,"l":[{"x":1},{"y":2}]},{"c":"}{"}]') == [{"c": "}{"}]
    assert whole('[{"a":"x},{"b":2},{"c":3}]')[-1] == {"c": 3}
    assert whole('[{"a":1},{"b":2') == [{"a": 1}] and whole("[") is None and whole(None) is None
    assert whole('text {"a": {"b": [1, 2]}} more {"c": 1} {') == [{"a": {"b": [1, 2]}}, {"c": 1}]


@pytest.mark.parametrize("seed", range(40))
def test_one_broken_object(seed):
    draw = random.Random(seed)

    def value(depth: int):
        kind = draw.randrange(5 if depth else 3)
        return [draw.randint(0, 9), "".join(draw.choice('ab{}[],:"\\ ') for _ in range(5)), None][kind] if kind < 3 else [value(depth - 1) for _ in range(2)] if kind == 3 else {k: value(depth - 1) for k in "xy"}

    objects = [{"id": i, "v": value(2), "w": value(1)} for i in range(draw.randint(2, 6))]
    texts, broken = [json.dumps(o) for o in objects], draw.randrange(len(objects))
    # A missing value breaks an object and leaves its strings and brackets whole.
    texts[broken] = texts[broken].replace('"id": ' + str(broken), '"id": ', 1)
    got = json.loads(J._whole_objects("[" + ", ".join(texts) + "]") or "[]")
    assert got == [o for i, o in enumerate(objects) if i != broken]


def test_windows_are_repaired(spark, tmp_path):
    folder = tmp_path / "w" / "abc"
    folder.mkdir(parents=True)
    files = ['[{"title":"a"},{"title":,},{"title":"c"}]', '{"title":"one"}', '[1,{"title":"b"},"x"]', "no json", '[{"title":"t",}]', "7"]
    for i, body in enumerate(files):
        (folder / f"window_{i:04d}.json").write_text(body)
    rows = {r.win: (r.bad, r.repaired, [c.title for c in r.concepts or []]) for r in readers.concept_windows(spark, str(tmp_path / "w")).collect()}
    assert rows == {0: (False, True, ["a", "c"]), 1: (False, False, ["one"]), 2: (False, False, ["b"]), 3: (True, False, []), 4: (False, True, ["t"]), 5: (True, False, [])}


def test_repair_in_spark(spark):
    rows = spark.createDataFrame([('[{"a":1},{"b":,},{"c":3}]',), ("[]",), (None,)], "raw string")
    assert [r[0] and json.loads(r[0]) for r in rows.select(J.repair(F.col("raw"))).collect()] == [[{"a": 1}, {"c": 3}], [], None]
