"""Tables that cut lineage: Parquet in the cluster's shared folder, and numbering over whole tables."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local master that names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomcorpus-"))
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
    return known.get().rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{scratch_dir(spark)}/{what}-{uuid.uuid4().hex}"


def folder(spark: SparkSession, what: str) -> str:
    """A new path that the innermost block of ``scratch`` deletes when it ends."""
    path, scopes = new_path(spark, what), _open_scopes()
    if scopes:
        scopes[-1].append(path)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark itself would read it with."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


#: Rows and bytes of an Arrow batch while a table is stored: texts may be long, and a batch is held
#: several times (in the JVM, in pyarrow and as numpy arrays).
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hold Arrow batches to ``BATCH_LIMITS`` while an action runs."""
    before = {k: spark.conf.get(k, None) for k in BATCH_LIMITS}
    for k, most in BATCH_LIMITS.items():
        known = int(before[k]) if (before[k] or "").lstrip("-").isdigit() else 0
        spark.conf.set(k, str(min(most, known) if known > 0 else most))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: The tables stored by the operators that run in this thread of the driver, innermost last.
_scopes = threading.local()


def _open_scopes() -> list[list[str]]:
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    return _scopes.open


def _write(df: DataFrame, what: str, scope: int, level: int = 3) -> DataFrame:
    spark, path, scopes = df.sparkSession, new_path(df.sparkSession, what), _open_scopes()
    if len(scopes) >= scope:
        scopes[-scope].append(path)
    with small_batches(spark):
        df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, what: str = "table", level: int = 3, scope: int = 1) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later steps recompute nothing
    before it, and any executor can read it. Arrow batches are kept small meanwhile. ``level`` is that of
    the compression, for tables whose size counts; with ``scope`` 2 the table outlives the innermost block of
    ``scratch``, as its result."""
    return _write(df, what, scope, level)


def sent(table: DataFrame, most: int) -> DataFrame:
    """A stored table, marked for broadcast while it has at most ``most`` rows."""
    return F.broadcast(table) if table.count() <= most else table


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is stored in the block when it ends."""
    scopes = _open_scopes()
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            delete(spark, path)


def cleaned(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Store the result of an operator, then delete the tables that it stored on the way."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        with scratch(docs.sparkSession):
            return _write(operator(docs, *args, **kwargs), operator.__name__, 2)

    return run


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_prefix_sums(rows: DataFrame, order: Sequence[str], value: str | None = None, before: str = "before", rank: str = "rank") -> DataFrame:
    """``rows`` with ``before`` (sum of the column ``value``) and ``rank`` (count) over all rows that sort before;
    without ``value`` only ``rank``. They take the place of columns of these names.

    ``order`` must be unique. No task sees more than a range of rows; the window over everything
    runs on the partitions' totals only. The ranges are stored first: both the totals and the rows
    come from the same ones. Rows are carried as one struct, so their columns may have any names.
    """
    keys = {f"k{i}": F.col(f"`{c}`") for i, c in enumerate(order)}
    size = F.lit(0) if value is None else F.col(f"`{value}`")
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()], size.alias("size"))
    with scratch(rows.sparkSession):
        ranged = stored(packed.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranged")
        totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        none = F.lit(0)
        totals = totals.select("part", F.coalesce(F.sum("bytes").over(ahead), none).alias("bytes"), F.coalesce(F.sum("rows").over(ahead), none).alias("rows"))
        inside = Window.partitionBy("part").orderBy(*keys)
        run = ranged.withColumn("inside", F.sum("size").over(inside) - F.col("size")).withColumn("place", F.row_number().over(inside) - 1)
        # One row for each partition: as many as there are tasks, so it is safe to broadcast.
        run = run.join(F.broadcast(totals), "part")
        made = {before: F.col("inside") + F.col("bytes")} if value is not None else {}
        made[rank] = F.col("place") + F.col("rows")
        own = [F.col(f"row.`{c}`") for c in rows.columns if c not in made]
        return stored(run.select(*own, *[c.alias(name) for name, c in made.items()]), "numbered", scope=2)
