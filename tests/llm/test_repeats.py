"""Repeated byte strings against brute force: coverage, maximal groups, hot grams, pieces of long texts, odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomcorpus.llm import queries, repeats


def brute(texts: list[str | None], size: int) -> list[tuple[int, int, int, bytes]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        out.append((len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def got(spark, texts, size):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = repeats.remove_repeats(docs, min_bytes=size).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]


def mixed(seed: int, n: int, alphabet: str, longest: int) -> list[str | None]:
    draw = random.Random(seed)
    base = ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, longest))) for _ in range(6)]
    texts: list[str | None] = [None, ""]
    for _ in range(n):
        parts = []
        for _ in range(draw.randint(1, 4)):
            part = draw.choice(base)
            a = draw.randint(0, len(part))
            parts.append(part[a : a + draw.randint(0, len(part))])
            parts.append("".join(draw.choice(alphabet) for _ in range(draw.randint(0, 9))))
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize(("seed", "alphabet", "size"), [(1, "ab", 12), (2, "abcdefgh", 25), (3, "aé😀b", 40), (4, "a", 10)])
def test_removed_bytes_equal_brute_force(spark, seed, alphabet, size):
    texts = mixed(seed, 40, alphabet, 4 * size)
    assert got(spark, texts, size) == brute(texts, size)


def test_hot_grams_and_small_chunks_change_nothing(spark, monkeypatch):
    texts = mixed(7, 60, "abcd", 120)
    want = brute(texts, 30)
    monkeypatch.setattr(repeats, "MAX_BUCKET", 1)
    monkeypatch.setattr(repeats, "MAX_SENT", 0)
    assert got(spark, texts, 30) == want


def test_windows_of_hot_grams_are_not_joined(spark, monkeypatch):
    """The windows of a hot gram are counted by sums alone, so no join makes rows by the size of a group."""
    texts = mixed(11, 60, "abcd", 120) + ["ab" * 40, "ba" * 40 + "c", "cd" * 15]
    plans, kept = [], repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda table, name: plans.append(table._jdf.queryExecution().optimizedPlan().toString()) or kept(table, name))
    monkeypatch.setattr(repeats, "MAX_BUCKET", 1)
    assert got(spark, texts, 30) == brute(texts, 30)
    joins = [line for plan in plans for line in plan.splitlines() if "Join" in line]
    assert joins and not [line for line in joins if " w#" in line or "(w#" in line]


@pytest.mark.parametrize(("bucket", "parts", "sent"), [(1, 2, 0), (3, 4, 9), (6, 7, 0)])
def test_hot_grams_are_cut_to_the_same_result(spark, monkeypatch, bucket, parts, sent):
    """Groups that are equal, scanned or cut again find what brute force finds, for any sizes."""
    texts = mixed(13, 60, "abcd", 120) + mixed(14, 30, "ab", 90) + ["ab" * 40, "ba" * 40 + "c", "cd" * 15, "a" * 70]
    monkeypatch.setattr(repeats, "MAX_BUCKET", bucket)
    monkeypatch.setattr(repeats, "PARTS", parts)
    monkeypatch.setattr(repeats, "MAX_SENT", sent)
    assert got(spark, texts, 30) == brute(texts, 30)


def most_rows(spark, after: int) -> tuple[int, str, int]:
    """The most rows that a node of the plans made, its name, and the number of the last query; queries up to ``after`` don't count."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs, most = store.executionsList(), (0, "", after)
    for run in (runs.apply(n).executionId() for n in range(runs.size())):
        if run <= after:
            continue
        values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
        for node in (nodes.apply(n) for n in range(nodes.size())):
            for metric in (node.metrics().apply(n) for n in range(node.metrics().size())):
                value = values.get(metric.accumulatorId())
                if metric.name() == "number of output rows" and value.isDefined():
                    most = max(most, (int(value.get().replace(",", "")), node.name(), after))
    return *most[:2], max(after, *(runs.apply(n).executionId() for n in range(runs.size())))


def test_hot_grams_make_few_rows_an_anchor(spark, monkeypatch):
    """An anchor whose gram has too many reaches for one task is not listed with each of its windows."""
    draw = random.Random(17)
    some = lambda n: "".join(draw.choice("abcdefghijklmnop") for _ in range(n))
    passage = some(420)
    texts = [some(150) + passage[draw.randint(0, 9) : 420 - draw.randint(0, 9)] + some(150) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    anchors = repeats._edges(repeats._keyed(docs, "doc_id", "text"), 200)[0].count()
    monkeypatch.setattr(repeats, "MAX_BUCKET", 16)
    *_, before = most_rows(spark, -1)
    assert got(spark, texts, 200) == brute(texts, 200)
    rows, node, _ = most_rows(spark, before)
    assert anchors >= 300 and 0 < rows < 12 * anchors, (rows, node, anchors)


def rows_made(spark, after: int) -> tuple[Counter, int]:
    """The rows that the joins, generators and Arrow functions of the plans made, by name and outputs, and the number of the last query."""
    store, made, last = spark._jsparkSession.sharedState().statusStore(), Counter(), after
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList()
    for run in (runs.apply(n).executionId() for n in range(runs.size())):
        last = max(last, run)
        if run <= after:
            continue
        values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
        for node in (nodes.apply(n) for n in range(nodes.size())):
            for metric in (node.metrics().apply(n) for n in range(node.metrics().size())):
                value = values.get(metric.accumulatorId())
                if re.search("Join|Generate|Arrow", node.name()) and metric.name() == "number of output rows" and value.isDefined():
                    made[re.sub(r"#\d+L?|\d+", "", node.desc())[:140]] += int(value.get().replace(",", ""))
    return made, last


def test_rows_grow_with_the_input_while_grams_become_hot(spark, monkeypatch):
    """Reaches whose gram passes ``MAX_BUCKET`` only on the larger table, and which share no window, make few rows more than others."""
    monkeypatch.setattr(repeats, "MAX_BUCKET", 20)
    monkeypatch.setattr(repeats, "MAX_SENT", 0)
    draw = random.Random(19)
    some = lambda n: "".join(draw.choice("abcdefghijklmnop") for _ in range(n))
    *_, last = rows_made(spark, -1)
    found = []
    for times in (1, 5):
        passages = [*[some(150)] * 24 * times, *[p for _ in range(4) for p in [some(150)] * 8 * times], *[p for _ in range(150 * times) for p in [some(300)] * 2]]
        texts = [some(150) + p + some(150) for p in passages]
        assert got(spark, texts, 200) == brute(texts, 200)
        made, last = rows_made(spark, last)
        found.append(made)
    small, large = found
    assert max(large.values()) > 1500
    assert not {node: (small[node], rows) for node, rows in large.items() if rows > max(500, 8 * small[node])}


def test_long_texts_in_pieces(monkeypatch):
    """The anchors of a text don't depend on the pieces that it is read in."""
    import pyarrow as pa

    texts = pa.array(["".join(random.Random(5).choice("ab") for _ in range(5000)), "x" * 700, "short"])
    listed = lambda: sorted((int(a), int(b), int(c), int(d)) for part in repeats.anchors_of(texts, 50) for a, b, c, d in zip(*part, strict=True))
    whole = listed()
    monkeypatch.setattr(repeats, "_CHUNK", 333)
    assert listed() == whole and len(whole) > 100


@pytest.mark.parametrize("seed", range(6))
def test_groups_are_all_maximal_repeats(seed):
    draw = random.Random(seed)
    pairs = sorted({("".join(draw.choice("ab") for _ in range(draw.randint(3, 9))), "".join(draw.choice("ab") for _ in range(draw.randint(0, 7)))) for _ in range(40)})
    rights, lefts = [r.encode() for r, _ in pairs], [x.encode() for _, x in pairs]
    same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    want = set()
    for a in range(len(pairs)):
        for b in range(a):
            left, right = same(lefts[a], lefts[b]), same(rights[a], rights[b])
            if right > 0 and left + right >= 6:
                members = frozenset(m for m in range(len(pairs)) if same(lefts[m], lefts[a]) >= left and same(rights[m], rights[a]) >= right)
                want.add((left, right, members))
    found = [(left, right, frozenset(members)) for left, right, members in repeats.repeat_groups(lefts, rights, 6)]
    assert set(found) == want and len(found) == len(want)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    table = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    import hashlib

    want = {i: (n, m, k, hashlib.sha256(kept).hexdigest()) for i, (n, m, k, kept) in zip(table["doc_id"], brute(table["text"], 200), strict=True)}
    rows = queries.QUERIES["op13_repeated_strings"](spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want and len(rows) == len(want)
    assert sum(r.n_removed for r in rows) > 0


def test_odd_rows(spark):
    a, b = "abcdefghij" * 30, "".join(random.Random(1).choice("xyz") for _ in range(300))
    rows = [(1, b), (1, b), (None, a[:250]), (2, None), (3, "short"), (4, "tail " + b[40:290])]
    docs = spark.createDataFrame([(i, t, 5, "z") for i, t in rows], "doc_id long, text string, n_bytes int, h string")
    out = repeats.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "h", "n_bytes", "n_removed", "n_spans", "kept"]
    found = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}
    assert found == {(1, 300): (300, 1, b""), (None, 250): (250, 1, b""), (2, 0): (0, 0, b""), (3, 5): (0, 0, b"short"), (4, 255): (250, 1, b"tail ")}
    groups = repeats.maximal_repeats(docs)
    assert groups.columns == ["doc_id", "pos", "left", "right", "group"] and groups.where(F.col("left") + F.col("right") < 200).count() == 0
    assert repeats.repeat_digests(docs.limit(0)).count() == 0
