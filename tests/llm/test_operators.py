"""The training-data operators against brute force, on rows with nulls, empty texts, ties and repeats."""

from __future__ import annotations

import gzip
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from loomcorpus.llm import decontaminate, jaccard, language, lines, materialise, packing, quality, sharding, shingles, urls, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, token string, label int"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those used inside the operators."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "x", 0) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "THETA"]
    base = [" ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 90))) for _ in range(40)]
    out = [None, "", "   \n\t ", "one", "one", "a b c d e", "é" * 5000, "word " * 3000, None]
    for b in base:
        out.append(b)
        if rng.random() < 0.5:
            w = b.split(" ")
            w[rng.randrange(len(w))] = "changed"
            out += [" ".join(w), b]
    return list(enumerate(out))


def test_shingles_equal_python_words(texts):
    rows = [t for _, t in texts]
    found = list(shingles.shingle_sets(pa.array(rows, pa.string())))
    for t, s in zip(rows, found, strict=True):
        w = (t or "").encode().lower().split()
        want = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        assert len(want) == len(s)


def test_jaccard_components(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(frame(spark, texts)).collect()}
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
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
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
    kept = {r.doc_id for r in jaccard.keep_one_per_group(frame(spark, texts)).collect()}
    assert kept == {i for i in sets if find(i) == i}


def test_jaccard_empty(spark):
    assert jaccard.jaccard_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("size", [2048, 16])
def test_packing(spark, texts, size):
    rows = packing.pack(frame(spark, texts), size=size).toPandas()
    want = {i: x for (i, _), x in zip(texts, packing.token_ids([t for _, t in texts]), strict=True)}
    for i, own in rows.sort_values("piece").groupby("doc_id"):
        assert own["length"].sum() == len(want[i])
        assert list(own["start"]) == list(np.cumsum([0, *own["length"]])[:-1])
        assert (own["length"].iloc[1:] == size).all()
        assert list(own["ids_crc32"]) == [zlib.crc32(want[i][s : s + n].tobytes()) for s, n in zip(own["start"], own["length"], strict=True)]
    assert set(rows["doc_id"]) == set(want)
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert list(own["offset"]) == list(np.cumsum([0, *own["length"]])[:-1]) and own["length"].sum() <= size
    assert rows["sequence_id"].nunique() <= -(-rows["length"].sum() // size) * 1.05 + 1


def test_packing_search_empties_bins():
    bins = packing.Bins(10, np.array([6, 5, 3, 4, 2]))
    for pieces, b in (([0], 0), ([1, 2], 1), ([3, 4], 2)):
        bins.put(pieces, b)
    bins.search()
    assert len(bins.items) == 2 and sorted(bins.fill[list(bins.items)]) == [10, 10]


def test_packing_search_ends_in_a_local_optimum():
    rng = np.random.default_rng(3)
    for size, high in ((30, 20), (2048, 900), (100, 60), (9, 9)):
        lengths = rng.integers(1, high, 120)
        bins = packing.Bins(size, lengths)
        bins.best_fit()
        before = len(bins.items)
        bins.search()
        used = {b: [i for i in range(120) if bins.bin[i] == b] for b in set(bins.bin.tolist())}
        fill = {b: int(lengths[x].sum()) for b, x in used.items()}
        assert all(0 < f <= size for f in fill.values()) and len(used) <= before
        if len(used) == bins.least():
            continue
        for a in used:
            for b in (b for b in used if b != a and fill[b] >= fill[a]):
                assert not any(lengths[x] <= size - fill[b] for x in used[a])
                for y in used[b]:
                    gives = [lengths[x] for x in used[a]] + [lengths[x] + lengths[z] for i, x in enumerate(used[a]) for z in used[a][i + 1 :]]
                    assert not any(0 < g - lengths[y] <= size - fill[b] for g in gives)


def test_packing_empty(spark):
    assert packing.pack(frame(spark, [])).count() == 0


def test_token_ids_equal_the_tokenizer(texts):
    rng = random.Random(1)
    odd = ["".join(rng.choice(" \n\tab1'é,.　ßIll\x0b\x85") for _ in range(rng.randint(1, 40))) for _ in range(300)] + ["<|endoftext|> b"]
    points = [*range(0xD800), *range(0xE000, 0x30000)]
    odd += ["".join(chr(rng.choice(points)) + rng.choice(["", "", " ", "a", "1"]) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    rows = [t for _, t in texts] + odd
    coder = packing.tokenizer()
    for t, ids in zip(rows, packing.token_ids(rows), strict=True):
        assert ids.tolist() == [*(coder.encode(t, add_special_tokens=False).ids if t else []), 0]


def test_sharding(spark, texts):
    rows = sharding.assign_shards(frame(spark, texts + texts[:5]), 7).toPandas()
    sizes = {i: len((t or "").encode()) + 16 for i, t in texts}
    assert len(rows) == len(texts) + 5 and all(sizes[i] == s for i, s in zip(rows["doc_id"], rows["size"], strict=True))
    assert set(rows["shard"]) <= set(range(7))
    total, largest = rows["size"].sum(), rows["size"].max()
    for _, own in rows.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own))) and abs(own["size"].sum() - total / 7) <= largest + 1
    ordered = rows.sort_values(["shard", "slot"])
    assert list(ordered["doc_id"]) == sorted(rows["doc_id"])
    assert sharding.assign_shards(frame(spark, []), 7).count() == 0


def brute_lines(rows, least):
    docs = [(i, [(k, x.strip(" \t\n\x0b\f\r")) for k, x in enumerate(t.split("\n")) if x.strip(" \t\n\x0b\f\r")]) for i, t in sorted(rows) if t is not None]
    gone, seen = defaultdict(set), defaultdict(list)
    for d, (i, own) in enumerate(docs):
        for k, (_, x) in enumerate(own):
            for e, j in seen[x]:
                n = 0
                while k + n < len(own) and j + n < len(docs[e][1]) and own[k + n][1] == docs[e][1][j + n][1]:
                    n += 1
                if sum(len(re.findall(r"[^\x20\x09-\x0D]+", own[k + m][1])) for m in range(n)) >= least:
                    gone[i] |= {own[k + m][0] for m in range(n)}
            seen[x].append((d, k))
    return gone


@pytest.mark.parametrize("least", [1, 6, 50])
def test_line_dedup(spark, least):
    rng = random.Random(least)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 8))) for _ in range(14)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for i in range(40)] + [(90, None), (91, ""), (92, " \n ")]
    rows += [(93, rows[3][1]), (94, "a b c\n" * 200)]
    got = {r.doc_id: (r.text, r.n_deleted) for r in lines.dedup_lines(frame(spark, rows), min_words=least).collect()}
    gone = brute_lines(rows, least)
    for i, t in rows:
        want = t if i not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        assert got[i] == (want, len(gone.get(i, ()))), i
    assert lines.keep_new_lines(frame(spark, [])).count() == 0


def test_decontamination(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    item = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, item(n)) for i, n in enumerate([30, 13, 14, 12, 3, 40, 55])] + [(10, ""), (11, None), (1, item(20))]
    docs = []
    for i in range(60):
        parts = [item(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            source = rng.choice(items)[1] or ""
            w = source.split(" ")
            k = rng.randint(0, len(w))
            parts += [" ".join(w[k : k + rng.randint(5, 30)]).upper(), item(rng.randint(0, 60))]
        docs.append((i, ", ".join(parts)))
    docs += [(70, None), (71, ""), (72, "é ß"), (73, items[4][1] + "!"), (74, items[0][1] + " " + items[5][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark, docs), bench).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]}))
    con.register("benchmark", pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}))
    want = con.sql(decontaminate.SQL).df().sort_values("doc_id").reset_index(drop=True)
    for c in want.columns:
        assert list(got[c]) == list(want[c]), c
    assert got["contaminated"].sum() > 3
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.decontaminate(frame(spark, docs), bench.limit(0)).collect())


def test_quality_measures(texts):
    rows = [t for _, t in texts] + ["a b c\na b c\n\nx", "x\n x\nx", "a a a a a", "#% $ é"]
    found = list(quality.measures(pa.array(rows, pa.string())))
    got = {k: np.concatenate([x[k] for x in found]) for k in found[0]}
    for n, t in enumerate(rows):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
        seen, again = set(), 0
        for x in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", x):
                again += x in seen
                seen.add(x)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), again, len(hit))
        assert want == tuple(int(got[k][n]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), t[:40]


def test_quality_classifier(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["river", "stone", "light", "garden", "winter", "music"]) + rng.choice("abcdefgh") for _ in range(70))
    bad = lambda: " ".join(rng.choice(["buy", "cheap", "click", "win", "free", "$$$"]) + rng.choice("abcdefgh") for _ in range(70))
    rows = [(i, good() if i % 2 else bad()) for i in range(300)] + [(400, None), (401, "")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(201, None, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.judge(docs, quality.fit(docs, labels)).collect()}
    assert len(out) == len(rows) and not out[400].kept and out[401].base_failed
    assert np.mean([out[i].kept == bool(i % 2) for i in range(200, 300)]) > 0.95
    neutral = quality.fit(docs, labels.limit(0))
    assert {r.quality for r in quality.judge(docs, neutral).collect()} == {0.5}
    assert quality.judge(frame(spark, []), neutral).count() == 0


def brute_margin(model, text):
    """The classifier's margin of one text, gram by gram, from hashes of single words and grams."""
    low = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    hashes = [int(shingles.word_hashes(np.frombuffer(w.encode(), np.uint8))[0][0]) for w in words]
    single = lambda x: int(shingles.mix(np.array([x % 2**64], np.uint64))[0])
    quarter, half = quality.DIMENSIONS // 4, quality.DIMENSIONS // 2
    found = [[h // 2**50 for h in hashes], [single(a * 3 + b) // 2**50 + quarter for a, b in zip(hashes, hashes[1:])], []]
    chars = [ord(c) for c in low + "\n"]
    for i in range(len(chars) - quality.GRAM + 1):
        value = 0
        for c in chars[i : i + quality.GRAM]:
            value = (value * 0x9E3779B97F4A7C15 + c) % 2**64
        found[2].append(single(value) // 2**49 + half)
    return sum(np.mean([float(model.weights[i]) for i in x]) for x in found if x) + model.bias


def test_quality_of_a_text_alone_and_in_a_batch(texts):
    rng = np.random.default_rng(1)
    model = quality.Classifier(rng.normal(size=quality.DIMENSIONS).astype(np.float32), 0.1, 0.7, -0.2)
    rows = [t for _, t in texts if t is None or len(t) < 4000] + ["é", "ab", "abc", "A b\nc ß 漢字"]
    together = np.concatenate(list(quality.probabilities(model, pa.array(rows, pa.string()))))
    back = np.concatenate(list(quality.probabilities(model, pa.array(rows[::-1], pa.string()))))[::-1]
    alone = np.concatenate([p for t in rows for p in quality.probabilities(model, pa.array([t], pa.string()))])
    assert (together == alone).all() and (together == back).all()
    want = [1 / (1 + np.exp(-(0.7 * brute_margin(model, t) - 0.2))) for t in rows]
    assert np.abs(together - want).max() < 1e-6


def test_urls(spark):
    urls_ = ["http://Example.ORG/es/x?q", "https://a.example.org/en/12#t", "http://example.org/en/2", "http://org", "ftp://x.com/fr/", "http://notexample.org/es/", "http://a.com/de/y",
             "http://com:80/de/", "no scheme", "", None, "http://x.com/fr", "HTTP://b.org/?x://y", "://org/"]
    rows = [(i, u, None) for i, u in enumerate(urls_)] + [(0, urls_[0], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = urls.filter_urls(pages, urls.rules_table(spark, urls.RULES)).toPandas()
    assert len(got) == len(rows)
    for r in got.itertuples():
        u = urls_[r.page_id]
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u) if u else None
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        best = max(((len(k), k, v) for v, k in urls.RULES if m and (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith(k[k.index("/") :])), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best[1], best[2] if best else "allow")
    assert urls.filter_urls(pages, urls.rules_table(spark, urls.RULES).limit(0)).where("verdict = 'block'").count() == 0


@pytest.mark.parametrize("blocks", [1 << 20, 0])
def test_urls_long_lists(spark, monkeypatch, blocks):
    """A list that is shuffled, through a filter that is sent and one that is dealt by block."""
    monkeypatch.setattr(urls, "MAX_SENT_ENTRIES", 0)
    monkeypatch.setattr(urls, "MAX_BLOCKS", blocks)
    rules = [("block", f"h{i}.org/{'a' * (i % 3)}") for i in range(0, 400, 2)] + [("allow", "h8.org/aaa")]
    pages = spark.createDataFrame([(i, f"http://x.h{i}.org/aaa") for i in range(400)] + [(None, "http://h2.org/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.filter_urls(pages, urls.rules_table(spark, rules), default="none").collect()}
    assert got == {i: "none" if i % 2 else "allow" if i == 8 else "block" for i in range(400)} | {None: "none"}


def test_warc_round_trip(spark, tmp_path):
    htmls = ["<p>x</p>", "<p>y é</p>", "<p>x</p>", None, "", "WARC/1.1\r\n\r\nfake", "<p>x</p>", "a\r\n\r\n" * 50]
    rows = [(i, f"http://h/{i} ü\r\nX: y" if i % 2 else None, h, "d") for i, h in enumerate(htmls)] + [(6, None, "<p>x</p>", "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = warc.archive(pages, folder=f"file://{tmp_path}/w").collect()
    assert len(got) == len(rows)
    last = {}
    for i, _, h, _ in rows:
        last[h or ""] = max(i, last.get(h or "", -1))
    for r in got:
        h = htmls[r.page_id] or ""
        assert (r.payload_bytes, r.payload_digest) == (len(h.encode()), warc.payload_digest(h.encode()))
        assert r.refers_to == (last[h] if r.record_type == "revisit" else None)
        assert r.record_type == "revisit" or r.page_id == last[h]
    assert Counter(r.record_type for r in got)["response"] == len(last)
    assert {r.record_type for r in warc.archive(pages.limit(3), folder=f"file://{tmp_path}/v", least_bytes=10**6).collect()} == {"response"}
    assert warc.archive(pages.limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "u", "x"), (None, "u", "y"), (2, "u", "y"), (None, None, "x")], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in warc.archive(rows).collect())
    assert got == [(0, "response", 0), (0, "revisit", 0), (0, "revisit", 2), (2, "response", 0)]


def test_files_of_lost_attempts_are_not_read(spark, tmp_path, monkeypatch):
    """Every task first runs to its end in vain, as a lost or speculative one does, and then again."""
    write = warc._written
    monkeypatch.setattr(warc, "_written", lambda b, *to: (lambda held: [list(write(iter(held), *to)), write(iter(held), *to)][1])(list(b)))
    pages = spark.createDataFrame([(i, "u", f"p{i % 30}") for i in range(40)], "page_id long, url string, html string").repartition(3)
    assert sorted(r.page_id for r in warc.archive(pages, folder=str(tmp_path / "w")).collect()) == list(range(40))
    assert not (tmp_path / "w" / "_attempts").exists()
    monkeypatch.setattr(warc, "MAX_SENT", 0)
    assert Counter(r.record_type for r in warc.archive(pages).collect()) == {"response": 30, "revisit": 10}


def test_materialise(spark, texts, tmp_path):
    for n in (1, 2, 3, 65, 1000):
        assert sorted(materialise.permuted(np.arange(n), n)) == list(range(n))
    folder = f"file://{tmp_path}/s"
    rows = materialise.materialise(frame(spark, texts), folder=folder, size=64, per_shard=50).toPandas()
    assert sorted(rows["slot"]) == list(range(len(rows)))
    ids = list(packing.token_ids([t for _, t in texts]))
    assert rows["n_tokens"].sum() == sum(map(len, ids))
    # Slot Feistel(i) holds sequence i: the parts' sequences in order, counted on.
    cut = sorted((r.part, r.number, zlib.crc32(r.ids)) for r in materialise.sequences(frame(spark, texts), size=64).collect())
    at = materialise.permuted(np.arange(len(cut)), len(cut))
    by_slot = dict(zip(rows["slot"], rows["ids_crc32"], strict=True))
    assert [by_slot[s] for s in at] == [c for _, _, c in cut]
    assert list(rows["shard"]) == list(rows["slot"] // 50) and list(rows["place"]) == list(rows["slot"] % 50)
    with pytest.raises(ValueError):
        materialise._narrow(np.array([1 << 16], np.uint32))
    read = list(materialise.read_from(folder, 30, 60, size=64, per_shard=50))
    assert [zlib.crc32(x.tobytes()) for x in read] == list(rows.sort_values("slot")["ids_crc32"][30:90])
    tokens = Counter(np.concatenate(list(materialise.read_from(folder, 0, len(rows), size=64, per_shard=50))).tolist())
    assert tokens == Counter(np.concatenate(ids).tolist())


def test_language(spark):
    rng = random.Random(4)
    pools = {"aa": ["nga", "tolo", "mirru", "bako"], "bb": ["schtr", "zwerg", "pflix", "krumpf"]}
    rows = [(i, " ".join(rng.choice(pools[k]) for _ in range(30)), k) for i in range(200) for k in [["aa", "bb"][i % 2]]]
    rows += [(300, None, "aa"), (301, "123 !!", "bb"), (302, "", None), (303, "tolo mirru", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language.identify(docs).collect()}
    for i, _, k in rows[:200]:
        assert out[i].lang_pred == k and 0.5 < out[i].score <= 1 and out[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert [out[i].lang_pred for i in (300, 301, 302, 303)] == ["und", "und", "und", "aa"]
    assert {r.doc_id for r in language.keep_identified(docs).collect()} == {*range(200), 303}
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", docs["lang"].substr(99, 1)).where("doc_id < 0")).collect()} == set()


def brute_bits(sample, text):
    """Code length of a text under the frozen PPM statistics of a sample, byte by byte."""
    seen = defaultdict(Counter)
    lower = lambda t: b"\n\n\n" + re.sub("[A-Z]", lambda c: c[0].lower(), t).encode()
    for t in sample:
        x = lower(t)
        for i in range(3, len(x)):
            for k in range(4):
                seen[x[i - k : i]][x[i]] += 1
    total, x = 0.0, lower(text)
    for i in range(3, len(x)):
        for k in (3, 2, 1, 0):
            followers = seen.get(x[i - k : i])
            if not followers:
                continue
            n, d = sum(followers.values()), len(followers)
            if x[i] in followers:
                total -= np.log2(followers[x[i]] / (n + d))
                break
            total -= np.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_equal_brute_force(spark):
    rng = random.Random(9)
    scripts = ["абвгдежзик", "αβγδεζηθικ", "אבגדהוזחטי", "aBcdefGhij", "कखगघचछजझटठ"]
    texts = [("".join(rng.choice(s) + rng.choice(["", "", " ", "1", "\n"]) for _ in range(80)), f"l{k}") for k, s in enumerate(scripts) for _ in range(12)]
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(texts)] + [(900, "", "l0"), (901, "é", None), (902, "б" * 3000, None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == tuple(f"l{k}" for k in range(5))
    rows = [t for t, _ in texts[::7]] + ["", "Zz 99", "б" * 3000]
    for got, tree in zip(model.languages, language.trees(model), strict=True):
        sample = [t for t, k in texts if k == got] + ([""] if got == "l0" else [])
        for _, _, buffer, starts in language.chunks(pa.array(rows, pa.string())):
            grams, bounds = language.byte_grams(buffer, starts)
            bits = tree.code_lengths(grams)
            for i, t in enumerate(rows):
                assert abs(bits[bounds[i] : bounds[i + 1]].sum() - brute_bits(sample, t)) < 1e-2 * max(1, len(t)), (got, t[:20])
    out = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert [out[i] for i in range(len(texts))] == [k for _, k in texts] and out[900] == "und" and out[902] == "l0"


def test_language_columns_may_clash(spark):
    docs = spark.createDataFrame([(i, "tolo mirru", "aa", "x", 1.0, 2, 3, "r") for i in range(9)] + [(None, None, "aa", "x", 1.0, 2, 3, "r")], "doc_id long, text string, lang string, lang_pred string, score double, bits int, held_out int, row string")
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 9
    assert language.identify(docs).count() == 10


def test_archives_of_many_revisits(spark, monkeypatch, tmp_path):
    """Lists beside the pages give what the broadcast gives; records have names of their own; files are bounded unpacked."""
    rows = [(i % 50, f"u{i}", f"page {i % 7} " + "x" * 3000) for i in range(200)] + [(None, None, None), (None, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    key = lambda df: sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in df.collect())
    few = key(warc.archive(pages))
    monkeypatch.setattr(warc, "MAX_SENT", 0)
    monkeypatch.setattr(warc, "RAW_BYTES", 9000)
    assert key(warc.archive(pages, folder=str(tmp_path / "w"), date="2026-01-02T03:04:05Z")) == few
    records = [r for f in (tmp_path / "w").glob("*.gz") for r in warc.parse(gzip.decompress(f.read_bytes()))]
    names = {r["WARC-Record-ID"]: r["WARC-Type"] for r in records}
    assert len(names) == len(rows) and {r["WARC-Date"] for r in records} == {"2026-01-02T03:04:05Z"}
    assert all(names[r["WARC-Refers-To"]] == "response" for r in records if r["WARC-Type"] == "revisit")
    assert all(len(gzip.decompress(f.read_bytes())) < 9000 + 4000 for f in (tmp_path / "w").glob("*.gz"))
    spark.catalog.clearCache()
    plan = warc.resolve(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_url_filter_dealt_by_block(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 40}.org/p/{i}") for i in range(200)], "page_id long, url string")
    rules = urls.rules_table(spark, [("block", f"h{i}.org/p/1") for i in range(0, 60, 3)] + [("allow", "org/")])
    key = lambda: sorted(tuple(r) for r in urls.filter_urls(pages, rules).collect())
    few = key()
    monkeypatch.setattr(urls, "MAX_BLOCKS", 0)
    monkeypatch.setattr(urls, "MAX_SENT_ENTRIES", 0)
    assert key() == few and {r[-1] for r in few} == {"allow", "block"}


def test_one_labelled_id_is_one_text(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"good words {i} " * 20) for i in range(300)] + [(2, "bad " * 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    train = quality._train
    monkeypatch.setattr(quality, "_train", lambda batches: train(iter([b for b in batches if not seen.append(len(b)) and (len(b) <= 2 or 1 / 0)])))
    quality.fit(docs, labels)


def test_fragments_cost_nothing_when_empty():
    import time

    tokens = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 50_000).astype(np.uint64) * np.uint64(2))
    for fragments in (1, 16, 1 << 20, 1 << 24):
        bounds = jaccard._bounds(fragments)
        began = time.time()
        own, cuts = jaccard._parts(tokens, bounds)
        assert time.time() - began < 0.5 and cuts[0] == 0 and cuts[-1] == len(tokens) and len(own) == len(cuts) - 1
        assert all(o == int(np.searchsorted(bounds, tokens[a], "right")) for o, a in zip(own[:50], cuts, strict=False))


def test_shards_in_ranges_of_tasks(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} " * 9) for i in range(120)], "doc_id long, text string").repartition(3)
    for tasks in (20_000, 2):
        written = materialise.write_shards(docs, f"file://{tmp_path}/{tasks}", size=32, per_shard=5, max_tasks=tasks).collect()
        assert sum(r.records for r in written) > 50
    files = lambda n: {p.name: p.stat().st_size for p in (tmp_path / str(n)).glob("*.bin")}
    assert files(2) == files(20_000) and len(files(2)) > 10
