"""The container source over containers written here: content, redirects, compressions, pruning by path, and the article chain."""

from __future__ import annotations

import lzma
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from loomcorpus.operators import archives
from loomcorpus.sources import containers


def write(path, entries, kinds=(1, 4, 5), per_cluster=3, wide=False):
    """``entries``: (path, title, mimetype, content) or (path, title, None, path of the target); in any order."""
    entries = sorted(entries, key=lambda e: e[0].encode())
    number = {e[0]: i for i, e in enumerate(entries)}
    types = sorted({e[2] for e in entries if e[2]})
    blobs = [e for e in entries if e[2]]
    clusters = [blobs[i : i + per_cluster] for i in range(0, len(blobs), per_cluster)]
    place = {e[0]: (c, b) for c, cluster in enumerate(clusters) for b, e in enumerate(cluster)}
    form, width = ("Q", 8) if wide else ("I", 4)
    packed = []
    for c, cluster in enumerate(clusters):
        offsets, at = [], width * (len(cluster) + 1)
        for e in cluster:
            offsets.append(at)
            at += len(e[3])
        data = struct.pack(f"<{len(offsets) + 1}{form}", *offsets, at) + b"".join(e[3] for e in cluster)
        kind = kinds[c % len(kinds)]
        data = {1: lambda d: d, 4: lzma.compress, 5: zstandard.ZstdCompressor().compress}[kind](data)
        packed.append(bytes([kind | (0x10 if wide else 0)]) + data)
    dirents = []
    for p, title, mime, body in entries:
        head = struct.pack("<HBcI", 0xFFFF if mime is None else types.index(mime), 0, p[0].encode(), 0)
        head += struct.pack("<I", number.get(body, 10**6)) if mime is None else struct.pack("<II", *place[p])
        dirents.append(head + p[2:].encode() + b"\0" + title.encode() + b"\0")
    mimes = b"".join(t.encode() + b"\0" for t in types) + b"\0"
    paths_at = 80 + len(mimes)
    at = paths_at + 8 * len(entries) + 8 * len(clusters)
    pointers, cluster_pointers = [], []
    for d in dirents:
        pointers.append(at)
        at += len(d)
    for c in packed:
        cluster_pointers.append(at)
        at += len(c)
    clusters_at = paths_at + 8 * len(entries)
    head = struct.pack("<IHH16sIIQQQQIIQ", containers.MAGIC, 5, 0, b"u" * 16, len(entries), len(clusters), paths_at, 0, clusters_at, 80, 0xFFFFFFFF, 0xFFFFFFFF, at)
    path.write_bytes(head + mimes + struct.pack(f"<{len(entries)}Q", *pointers) + struct.pack(f"<{len(clusters)}Q", *cluster_pointers) + b"".join(dirents) + b"".join(packed) + b"c" * 16)


ENTRIES = [(f"A/{'é' if i % 3 else 'x'}{i:03}", f"Title {i}", "text/html", f"<p>{'words of article ' * 20}{i}</p>".encode()) for i in range(40)]
ENTRIES += [("I/pic.png", "", "image/png", b"\x89PNG"), ("A/moved", "Moved", None, "A/x000"), ("A/twice", "", None, "A/moved"), ("A/ring1", "", None, "A/ring2"), ("A/ring2", "", None, "A/ring1"), ("A/lost", "", None, "nowhere"), ("A/empty", "E", "text/html", b"")]


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "one.zim", ENTRIES)
    write(tmp_path / "two.zim", [(p.replace("A/", "C/"), *rest) for p, *rest in ENTRIES[:5]], wide=True)
    (tmp_path / "other.txt").write_text("no container")
    return tmp_path


def load(spark, folder, **options):
    return containers.entries(spark, f"{folder}/*.zim", per_partition=7, **options)


def test_entries_content_and_redirects(spark, folder):
    rows = {(r.archive, r.path): r for r in load(spark, folder).collect()}
    assert len(rows) == len(ENTRIES) + 5
    for p, title, mime, body in ENTRIES:
        r = rows["one.zim", p]
        assert (r.title, r.mimetype, r.redirect) == (title or p[2:], mime, mime is None)
        assert (None if r.content is None else bytes(r.content)) == (body if mime else None)
    assert [rows["one.zim", p].target for p in ("A/moved", "A/twice", "A/ring1", "A/lost", "A/x000")] == ["A/x000", "A/x000", None, None, None]
    assert bytes(rows["two.zim", "C/x000"].content) == ENTRIES[0][3]
    assert load(spark, folder, content=False).where("content is not null").count() == 0


def test_a_cluster_is_unpacked_once(folder):
    with containers.opened(str(folder / "one.zim")) as file:
        c = containers.Container(file)
        entries = sorted((c.entry(n) for n in range(c.entries)), key=lambda e: (e.get("cluster", -1), e.get("blob", -1)))
        for e in entries:
            if "cluster" in e:
                c.content(e)
        assert c.unpacked == c.clusters


def test_only_asked_paths_are_read(spark, folder):
    reader = containers.ContainerReader({"path": f"{folder}/one.zim", "entries": "7", "prefix": "A/é", "paths": '["A/é001", "A/é002", "I/pic.png"]'})
    assert sum(p.end - p.first for p in reader.partitions()) == 2
    some = load(spark, folder, prefix="A/x")
    assert some.count() == 14 and some.rdd.getNumPartitions() <= 3 < load(spark, folder).rdd.getNumPartitions()
    assert [r.path for r in load(spark, folder, paths=["I/pic.png", "nothing"]).collect()] == ["I/pic.png"]
    assert load(spark, folder, paths=[]).count() == 0
    # Plans of one DataFrame with different filters don't narrow each other.
    every = load(spark, folder)
    assert every.where("path = 'I/pic.png'").count() == 1 and every.count() == len(ENTRIES) + 5


def test_the_article_chain(spark, folder):
    entries = archives.landed(load(spark, folder).where("archive = 'one.zim'"))
    seen = spark.createDataFrame([("A/x000",)], "path string")
    actions = archives.article_actions(entries, seen, spark.createDataFrame([], "hash string"))
    got = {r.action: r.n for r in actions.groupBy("action").agg(F.count("*").alias("n")).collect()}
    assert got == {"ignored": 7, "stub": 1, "article": 39}


def test_no_container(spark, folder):
    (folder / "bad.zim").write_bytes(b"x" * 100)
    with pytest.raises(Exception, match="no ZIM container"):
        load(spark, folder).count()
