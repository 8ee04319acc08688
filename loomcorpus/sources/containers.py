"""A data source for ZIM archive containers: entries with their content, by ranges of the entry index.

A container's entries are listed by path. A partition is a range of that list; its entries are read in the order of
the clusters that hold them, so a cluster is unpacked once in a task, whatever the number of its entries. Of the paths
only those of a prefix, or some named ones, can be asked for: the ranges that hold them are found by binary search in the
list, and nothing else is read; nor is content that isn't asked for. Both are options of the read and not pushed-down
filters: Spark 4.1 keeps the filters that one plan of a DataFrame pushes into a Python source for its other plans too.
"""

from __future__ import annotations

import bisect
import json
import lzma
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the format: its magic number, the types of entries without content, and compressions.
MAGIC = 72173914
REDIRECT, LINK, DELETED = 0xFFFF, 0xFFFE, 0xFFFD
PLAIN, LZMA, ZSTD = {0, 1}, 4, 5
#: Entries of a partition, and redirects that are followed to an entry.
ENTRIES, HOPS = 5000, 16

SCHEMA = "archive string, path string, title string, mimetype string, redirect boolean, target string, content binary"


@dataclass
class Range(InputPartition):
    """Entries ``first`` to ``end`` of one container."""

    file: str
    first: int
    end: int


def opened(uri: str):
    """A file by a URI or a local path, for reads at any place."""
    store, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
    return store.open_input_file(path)


def listed(pattern: str) -> list[str]:
    """The files of a folder, or those that a pattern of its last part names (``*`` for any characters)."""
    import fnmatch

    folder, _, name = pattern.rpartition("/")
    if "*" not in name:
        folder, name = (pattern.rstrip("/"), "*.zim") if not pattern.endswith(".zim") else (folder, name)
    store, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder or ".")
    scheme = folder[: len(folder) - len(path)] if "://" in folder and folder.endswith(path) else ""
    files = [f.path for f in store.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File]
    return sorted(scheme + f for f in files if fnmatch.fnmatchcase(f.rpartition("/")[2], name))


class Container:
    """Random access to the entries of one container."""

    def __init__(self, file) -> None:
        self.file = file
        head = file.read_at(80, 0)
        magic, _, _, _, self.entries, self.clusters, self.paths_at, _, self.clusters_at, self.types_at = struct.unpack("<IHH16sIIQQQQ", head[:64])
        if magic != MAGIC:
            raise ValueError("this is no ZIM container")
        self.types: list[str] = []
        at = self.types_at
        while name := self._text(at):
            self.types.append(name)
            at += len(name.encode()) + 1
        self._cluster: tuple[int, bytes, int] | None = None
        #: Clusters that were unpacked.
        self.unpacked = 0

    def _text(self, at: int) -> str:
        found = b""
        while b"\0" not in found:
            part = self.file.read_at(256, at + len(found))
            if not part:
                break
            found += part
        return found.split(b"\0", 1)[0].decode("utf-8", "replace")

    def _numbers(self, form: str, at: int, count: int) -> tuple:
        return struct.unpack(f"<{count}{form}", self.file.read_at(count * struct.calcsize(form), at))

    def entry(self, number: int) -> dict:
        """``path``, ``title`` and where the content or the target of one entry is."""
        (at,) = self._numbers("Q", self.paths_at + 8 * number, 1)
        kind, _, space, _ = struct.unpack("<HBcI", self.file.read_at(8, at))
        found = {"type": kind, "number": number}
        if kind == REDIRECT:
            (found["to"],) = self._numbers("I", at + 8, 1)
            at += 12
        elif kind in (LINK, DELETED):
            at += 8
        else:
            found["cluster"], found["blob"] = self._numbers("I", at + 8, 2)
            at += 16
        path = self._text(at)
        title = self._text(at + len(path.encode()) + 1)
        return found | {"path": f"{space.decode()}/{path}", "title": title or path}

    def key(self, number: int) -> bytes:
        return self.entry(number)["path"].encode()

    def target(self, entry: dict) -> str | None:
        """The path that a redirect leads to, over further ones; None if they go in a circle or nowhere."""
        seen = set()
        while entry["type"] == REDIRECT:
            if entry["number"] in seen or len(seen) >= HOPS or entry["to"] >= self.entries:
                return None
            seen.add(entry["number"])
            entry = self.entry(entry["to"])
        return entry["path"] if entry["type"] not in (LINK, DELETED) else None

    def _unpacked(self, cluster: int) -> tuple[bytes, int]:
        if self._cluster is None or self._cluster[0] != cluster:
            (begin,) = self._numbers("Q", self.clusters_at + 8 * cluster, 1)
            if cluster + 1 < self.clusters:
                (end,) = self._numbers("Q", self.clusters_at + 8 * (cluster + 1), 1)
            else:
                (end,) = struct.unpack("<Q", self.file.read_at(8, 72))  # the checksum stands behind the last one
            raw = self.file.read_at(end - begin, begin)
            kind, wide = raw[0] & 0x0F, 8 if raw[0] & 0x10 else 4
            if kind in PLAIN:
                data = raw[1:]
            elif kind == LZMA:
                data = lzma.LZMADecompressor().decompress(raw[1:])
            elif kind == ZSTD:
                data = zstandard.ZstdDecompressor().decompressobj().decompress(raw[1:])
            else:
                raise ValueError(f"compression {kind} is not known")
            self.unpacked += 1
            self._cluster = (cluster, data, wide)
        return self._cluster[1:]

    def content(self, entry: dict) -> bytes:
        data, wide = self._unpacked(entry["cluster"])
        begin, end = struct.unpack_from("<2" + ("Q" if wide == 8 else "I"), data, wide * entry["blob"])
        return data[begin:end]

    def between(self, low: bytes, high: bytes | None) -> tuple[int, int]:
        """The range of entries whose paths are at least ``low`` and below ``high``."""
        numbers = range(self.entries)
        first = bisect.bisect_left(numbers, low, key=self.key)
        return first, self.entries if high is None else bisect.bisect_left(numbers, high, key=self.key)


def _after(prefix: bytes) -> bytes | None:
    """The least bytes above all that begin with ``prefix``."""
    while prefix and prefix[-1] == 0xFF:
        prefix = prefix[:-1]
    return prefix[:-1] + bytes([prefix[-1] + 1]) if prefix else None


class ContainerReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.pattern, self.size = options["path"], int(options.get("entries", ENTRIES))
        self.with_content = options.get("content", "true").lower() != "false"
        prefix = options.get("prefix", "").encode()
        #: The ranges of paths to read.
        self.ranges: list[tuple[bytes, bytes | None]] = [(prefix, _after(prefix))]
        if "paths" in options:
            named = sorted({p.encode() for p in json.loads(options["paths"])})
            self.ranges = [(p, p + b"\0") for p in named if p.startswith(prefix)]

    def partitions(self) -> Sequence[InputPartition]:
        out: list[InputPartition] = []
        for name in listed(self.pattern):
            with opened(name) as file:
                container = Container(file)
                for low, high in self.ranges:
                    first, end = container.between(low, high) if (low, high) != (b"", None) else (0, container.entries)
                    out += [Range(name, at, min(end, at + self.size)) for at in range(first, end, self.size)]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        if not partition.file:
            return
        with opened(partition.file) as file:
            container = Container(file)
            entries = [container.entry(n) for n in range(partition.first, partition.end)]
            # By cluster, so that each is unpacked once.
            for e in sorted(entries, key=lambda e: (e.get("cluster", -1), e.get("blob", -1), e["number"])):
                kind, moved = e["type"], e["type"] == REDIRECT
                mime = container.types[kind] if kind < len(container.types) else None
                body = container.content(e) if self.with_content and "cluster" in e else None
                yield partition.file.rpartition("/")[2], e["path"], e["title"], mime, moved, container.target(e) if moved else None, body


class ContainerSource(DataSource):
    """``format("zim")``: one row for each entry, deleted ones and link targets without type and content."""

    @classmethod
    def name(cls) -> str:
        return "zim"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ContainerReader:
        return ContainerReader(self.options)


def entries(spark: SparkSession, path: str, content: bool = True, prefix: str = "", paths: Sequence[str] | None = None, per_partition: int = ENTRIES) -> DataFrame:
    """The entries of the containers of a folder or pattern, see ``SCHEMA``; of all paths, those that begin with
    ``prefix``, or those of ``paths``. The session then knows the source ``zim``."""
    spark.dataSource.register(ContainerSource)
    options = {"path": path, "content": str(content).lower(), "entries": str(per_partition), "prefix": prefix}
    if paths is not None:
        options["paths"] = json.dumps(list(paths))
    return spark.read.format("zim").options(**options).load()
