"""The corpus pipeline on the smallest tables: each stage against a brute-force version of it."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
from test_operators import brute_bits, brute_lines

import corpus_pipeline
from loomcorpus.llm import decontaminate, packing

SF = "/root/testdata/sf0.001"


def brute_language(rows):
    """Code lengths of each text in every language, byte by byte; the share of the least one is 0.5 or more."""
    learned = {}
    for r in rows:
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            learned.setdefault(r.lang, []).append(r.text)
    kept = []
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            continue
        # The first 400 characters tell enough here; what matters is that no clean text goes.
        bits = np.array([brute_bits(learned[k], r.text[:400]) for k in sorted(learned)])
        if 1 / np.exp2(np.maximum(bits.min() - bits, -1000.0)).sum() >= 0.5:
            kept.append(r.doc_id)
    return kept


def brute_groups(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        out = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        rows = out.collect()
        after, texts = {r.doc_id for r in rows}, {r.doc_id: r.text for r in before}
        assert len(rows) == len(after)
        if name == "language":
            sample = before[::10]
            ids = {r.doc_id for r in sample}
            learned = [r for r in before if r.doc_id in ids or r.doc_id % 4 == 0]
            assert set(brute_language(learned)) & ids <= after
            assert after == {i for i, t in texts.items() if t is not None and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            gone = brute_lines(list(texts.items()), 50)
            for r in rows:
                assert r.text == "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in gone.get(r.doc_id, ()))
            lost = {i for i, own in gone.items() if not any(x.strip() and k not in own for k, x in enumerate(texts[i].split("\n")))}
            assert after == set(texts) - lost
        elif name == "near_duplicates":
            assert after == brute_groups(texts) and all(texts[r.doc_id] == r.text for r in rows)
        else:
            con = duckdb.connect()
            con.register("documents", pa.table({"doc_id": list(texts), "text": list(texts.values())}))
            con.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
            bad = {r[0] for r in con.sql(f"SELECT doc_id FROM ({decontaminate.SQL}) WHERE contaminated").fetchall()}
            assert bad and after == set(texts) - bad
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    ids = {r.doc_id: x for r, x in zip(docs.collect(), packing.token_ids([r.text for r in docs.collect()]), strict=True)}
    assert Counter(packed["doc_id"]) == Counter(i for i, x in ids.items() for _ in range(-(-len(x) // 2048)))
    assert list(packed["ids_crc32"]) == [zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) for r in packed.itertuples()]
    total = sum(map(len, ids.values()))
    assert packed["sequence_id"].nunique() <= -(-total // 2048) + 1 and packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
