"""``n_links`` of the Jaccard join is the exact number of linked texts."""

from __future__ import annotations

import random

import pytest

from loomcorpus.llm import jaccard


@pytest.mark.parametrize("block", [1024, 5])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "LINK_BLOCK", block)
    rng = random.Random(3)
    texts = [None, "", "one", "One", "alone " * 9]
    for size in (60, 90, 140):
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        for _ in range(16):
            near = list(base)
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(size)] = f"x{rng.randrange(500)}"
            texts.append(" ".join(near))
        texts += [" ".join(base)] * 3
    rows = list(enumerate(texts)) + [(7, texts[7])]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    want = {a: sum(a != b and bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in sets) for a in sets}
    assert max(want.values()) > 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_links for r in jaccard.jaccard_groups(docs).collect()} == want
