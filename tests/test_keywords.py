"""The automaton against plain search, on dense and deep states, pieces, and rules of any number."""

from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest

from loomcorpus.operators import keywords


@pytest.mark.parametrize(("seed", "dense", "piece"), [(1, 4096, 512), (2, 3, 5), (3, 1, 1)])
def test_scan_equals_plain_search(monkeypatch, seed, dense, piece):
    monkeypatch.setattr(keywords, "DENSE", dense)
    monkeypatch.setattr(keywords, "PIECE", piece)
    draw = random.Random(seed)
    words = sorted({"".join(draw.choice("abé") for _ in range(draw.randint(1, 6))) for _ in range(60)})
    texts = ["".join(draw.choice("abéx") for _ in range(draw.randint(0, 60))) for _ in range(80)] + [None, ""]
    automaton = keywords.Automaton([w.encode() for w in words])
    rows, states = automaton.scan(pa.array([t or "" for t in texts]).slice(0))
    found = {(r, words[p]) for r, s in zip(rows.tolist(), states.tolist(), strict=True) for p in automaton.places(s)}
    assert found == {(i, w) for i, t in enumerate(texts) for w in words if t and w in t}


def test_a_hundred_thousand_keywords(spark):
    draw = random.Random(5)
    words = list({"".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(5, 12))) for _ in range(100_000)})
    began = time.time()
    automaton = keywords.Automaton([w.encode() for w in words])
    assert automaton.bytes < 40 << 20 and time.time() - began < 60
    texts = [" ".join(draw.choice(words) if draw.random() < 0.1 else "".join(draw.choice("abcdefgh") for _ in range(7)) for _ in range(300)) for _ in range(40)]
    rows, states = automaton.scan(pa.array(texts))
    got = {(r, words[p]) for r, s in zip(rows.tolist(), states.tolist(), strict=True) for p in automaton.places(s)}
    known = set(words)
    want = {(i, t[a:b]) for i, t in enumerate(texts) for a in range(len(t)) for b in range(a + 5, min(len(t), a + 12) + 1) if t[a:b] in known}
    assert got == want


def test_rules(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "Red STEEL pipe"), (2, "blue"), (3, None), (4, ""), (5, "Red STEEL pipe"), (6, "a.b"), (7, "ÉCOLE")], "k int, t string")
    rules = spark.createDataFrame([(5, "pipe", "P"), (2, "steel", "M"), (2, "zinc", "M"), (9, ".", "dot"), (4, "école", "S"), (None, "blue", "no"), (1, None, "no")], "rule_no int, keyword string, value string")
    want = {(1, "M"), (2, None), (3, None), (4, None), (5, "M"), (6, "dot"), (7, "S")}
    for most in (8 << 20, 4):
        monkeypatch.setattr(keywords, "MAX_BYTES", most)
        assert {(r.k, r.value) for r in keywords.first_rule(rows, rules, "t").collect()} == want
    listed = keywords.matches(rows.withColumn("rules", rows.k), rules, "t")
    assert listed.columns == ["k", "t", "rules"]
    assert {r.k: r.rules for r in listed.collect()} == {1: [2, 5], 2: [], 3: [], 4: [], 5: [2, 5], 6: [9], 7: [4]}
    none = keywords.first_rule(rows, rules.limit(0), "t").collect()
    assert len(none) == 7 and all(r.value is None for r in none)
    every = spark.createDataFrame([(1, "", "all"), (0, "blue", "b")], "rule_no int, keyword string, value string")
    assert {(r.k, r.value) for r in keywords.first_rule(rows, every, "t").collect()} == {(k, "b" if k == 2 else None if k == 3 else "all") for k in range(1, 8)}
