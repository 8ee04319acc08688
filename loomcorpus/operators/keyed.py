"""Keyed tables that are merged in place: hash buckets, and manifests that make a version visible at once.

Rows lie in ``data/version=<v>/bucket=<b>`` by a hash of their key. A merge reads and rewrites only the buckets
that its batch has keys of, and leaves the files of all others alone; then it writes manifest ``v``, which names for
each bucket the version that holds it. Manifests are written under another name and renamed, so a reader sees
one whole version or the one before. A merge that is repeated under its number changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcorpus.operators import state
from loomcorpus.operators.tables import delete, exists, scratch, sent, stored

#: Keys of a batch that are broadcast at most to find their old rows; more are joined by a shuffle.
MAX_SENT = 500_000
_BUCKET = "_bucket"

Rule = Callable[[DataFrame, DataFrame], DataFrame]


def replaced(keys: Sequence[str]) -> Rule:
    """Old rows stay unless the batch has their key; a row of the batch takes the place of the whole old row."""

    def rule(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.join(sent(stored(new.select(*keys), "keys"), MAX_SENT), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)

    return rule


class KeyedTable:
    """A table in a folder with at most one row for each value of ``keys``, which are never null."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64) -> None:
        """``buckets`` counts for a new table, so that one holds some hundred MB; an existing one keeps its number."""
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        versions = self.versions()
        self.buckets = self._manifest(versions[-1])["buckets"] if versions else buckets

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The numbers of the whole versions, rising."""
        if not exists(self.spark, f"{self.path}/manifests"):
            return []
        place, store = self._fs(f"{self.path}/manifests")
        names = [s.getPath().getName() for s in store.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _manifest(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{version}.json", wholetext=True).first()[0])

    def _commit(self, version: int, manifest: dict) -> None:
        place, store = self._fs(f"{self.path}/manifests/_{version}.tmp")
        out = store.create(place, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        goal, _ = self._fs(f"{self.path}/manifests/{version}.json")
        if not store.rename(place, goal) and not store.exists(goal):
            raise OSError(f"{goal} can't be written")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The rows of a version, by default the newest one; of some buckets only, if they are named. None before the first."""
        versions = self.versions()
        if not versions:
            return None
        manifest = self._manifest(versions[-1] if version is None else version)
        held = {int(b): v for b, v in manifest["held"].items() if buckets is None or int(b) in set(buckets)}
        schema = self.spark.createDataFrame([], manifest["schema"]).schema
        if not held:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/version={v}/{_BUCKET}={b}" for b, v in sorted(held.items())])

    def merge(self, batch: DataFrame, version: int, order: str | None = None, rule: Rule | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Make ``version`` from the newest version before it and the rows of ``batch``.

        Inside the batch the row of greatest ``order`` of a key wins (none named: the greatest by its other
        columns); rows with a null in their key are left out. ``rule`` makes the new rows of the touched buckets from
        the old ones and the batch, by default ``replaced``. ``keep`` drops rows by age: a bucket with such rows counts
        as touched, which costs a scan of what ``keep`` looks at. Columns that only one side has are null in the other's rows.
        A version that is there already stays as it is.
        """
        if version in self.versions():
            return
        before = [v for v in self.versions() if v < version]
        base = self._manifest(before[-1]) if before else {"held": {}, "schema": None}
        with scratch(self.spark):
            rest = [c for c in batch.columns if c not in self.keys]
            new = batch.where(" and ".join(f"`{k}` is not null" for k in self.keys))
            new = state.last_wins(new, self.keys, order or rest[0]) if rest else new.distinct()
            new = stored(new.withColumn(_BUCKET, self.bucket()), "batch")
            touched = {r[0] for r in new.select(_BUCKET).distinct().collect()}  # at most the number of buckets
            if keep is not None and before:
                whole = self.read(before[-1]).withColumn(_BUCKET, self.bucket())
                sizes = [df.groupBy(_BUCKET).count() for df in (whole, keep(whole))]
                left = sizes[0].join(sizes[1].withColumnRenamed("count", "kept"), _BUCKET, "left").where("kept is null or kept < count")
                touched |= {r[0] for r in left.select(_BUCKET).collect()}
            new = new.drop(_BUCKET)
            old = self.read(before[-1], sorted(touched)) if before else None
            rows = (rule or replaced(self.keys))(old, new) if old is not None else rule(new.limit(0), new) if rule else new
            rows = rows if keep is None else keep(rows)
            out = rows.withColumn(_BUCKET, self.bucket()).repartition(F.col(_BUCKET))
            out.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/data/version={version}")
            written, store = self._fs(f"{self.path}/data/version={version}")
            filled = {s.getPath().getName().split("=")[1] for s in store.listStatus(written) if s.getPath().getName().startswith(f"{_BUCKET}=")}
            held = {b: v for b, v in base["held"].items() if int(b) not in touched} | {b: version for b in filled}
            self._commit(version, {"buckets": self.buckets, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "held": held})

    def expire(self, versions: int) -> None:
        """Keep the newest ``versions`` manifests, and of the data what they name."""
        known = self.versions()
        kept = known[-versions:]
        used = {(int(b), v) for k in kept for b, v in self._manifest(k)["held"].items()}
        for version in known[:-versions]:
            delete(self.spark, f"{self.path}/manifests/{version}.json")
        place, store = self._fs(f"{self.path}/data")
        for folder in store.listStatus(place):
            version = int(folder.getPath().getName().split("=")[1])
            if version > known[-1]:
                continue  # of a merge that is under way
            inner = [s.getPath() for s in store.listStatus(folder.getPath()) if s.getPath().getName().startswith(f"{_BUCKET}=")]
            gone = [p for p in inner if (int(p.getName().split("=")[1]), version) not in used]
            for p in [folder.getPath()] if len(gone) == len(inner) else gone:
                store.delete(p, True)
