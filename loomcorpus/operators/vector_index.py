"""An inverted-list index over unit vectors: k-means cells, stored by cell, with appended batches.

The centroids come from a bounded sample; every point is stored with the cell of its nearest centroid, the
rows ranged by cell so that a search reads the row groups of the cells that it probes. A cell's row in
``cells`` holds its centroid, its number of points and its widest angle, which bounds the score of all its
points for any query: a search probes the nearest cells and, if it has to be exact, afterwards every further
cell whose bound reaches the last of the best. Cells of any size are dealt into blocks before they meet
queries, so a cell that holds a third of all points is no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcorpus.operators import search
from loomcorpus.operators.tables import delete, exists, scratch, stored

#: Vectors that the centroids are fitted on at most, and cells at most: both bound the fit and the centroids that are sent.
SAMPLE, MAX_CELLS = 200_000, 16_384
#: Probed cells that are put into the plan as a filter of the scan; more are only joined.
MAX_LISTED = 1000


def _usable(points: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite entries and a length above zero."""
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return points.where(F.col(vector).isNotNull() & ok & F.exists(vector, lambda c: c != 0))


def _assigned(rows: DataFrame, centroids: np.ndarray, vector: str, n: int) -> DataFrame:
    """``rows`` with ``near``, their ``n`` nearest cells as ``(cell, cosine)``, the nearest first."""
    from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

    kind = ArrayType(StructType().add("cell", IntegerType()).add("cosine", DoubleType()))
    fields = pa.struct([("cell", pa.int32()), ("cosine", pa.float64())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            score = search.unit(batch.column(vector)) @ centroids.T
            top = np.argsort(-score, axis=1, kind="stable")[:, :n]
            cells = pa.StructArray.from_arrays([pa.array(top.ravel().astype(np.int32)), pa.array(np.clip(np.take_along_axis(score, top, axis=1).ravel(), -1, 1))], fields=list(fields))
            near = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * top.shape[1]), cells)
            yield pa.record_batch([*batch.columns, near], names=[*batch.schema.names, "near"])

    schema = StructType(list(rows.schema.fields)).add("near", kind)
    return rows.mapInArrow(mapped, schema)


def fit_cells(points: DataFrame, cells: int | None = None, vector: str = "embedding", seed: int = 1) -> np.ndarray:
    """Unit centroids of k-means by cosine over at most ``SAMPLE`` points; about the square root of their number by default."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = _usable(points.select(vector), vector)
    n = rows.count()
    wanted = min(MAX_CELLS, cells or max(1, int(n**0.5)))
    if n == 0:
        return np.empty((0, 0))
    # A hash of the vector chooses the sample, so the same table gives the same one.
    share = min(1.0, SAMPLE / n)
    sample = rows.where(F.pmod(F.xxhash64(vector, F.lit(seed)), F.lit(1 << 20)) <= int(share * (1 << 20))).limit(SAMPLE)
    sample = sample.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    model = KMeans(k=wanted, distanceMeasure="cosine", maxIter=10, seed=seed).fit(sample)
    found = np.array(model.clusterCenters(), dtype=np.float64)
    length = np.linalg.norm(found, axis=1, keepdims=True)
    return found / np.where(length == 0, 1.0, length)


class VectorIndex:
    """An index in a folder: ``cells`` (centroids), and ``points/batch=n``, each batch written once."""

    def __init__(self, spark: SparkSession, path: str, id_col: str = "point_id", vector: str = "embedding") -> None:
        self.spark, self.path, self.id_col, self.vector = spark, path.rstrip("/"), id_col, vector

    def build(self, points: DataFrame, cells: int | None = None) -> VectorIndex:
        """Fit the cells and store every point as batch 0; what lay in the folder is replaced."""
        delete(self.spark, self.path)
        centroids = fit_cells(points, cells, self.vector)
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
        self.spark.createDataFrame(rows, "cell int, centroid array<double>").coalesce(1).write.parquet(f"{self.path}/cells")
        return self.append(points, 0)

    def centroids(self) -> np.ndarray:
        rows = sorted(self.spark.read.parquet(f"{self.path}/cells").collect(), key=lambda r: r.cell)
        return np.array([r.centroid for r in rows], dtype=np.float64)

    def append(self, points: DataFrame, batch: int) -> VectorIndex:
        """Store the points as ``batch``; the same batch again replaces itself, so a repeat changes nothing.
        Rows without a usable vector are not stored."""
        rows, centroids = _usable(points, self.vector), self.centroids()
        out = _assigned(rows, centroids, self.vector, 1) if len(centroids) else rows.limit(0).withColumn("near", F.lit(None).cast("array<struct<cell:int,cosine:double>>"))
        out = out.select(*[f"`{c}`" for c in points.columns], F.get("near", F.lit(0))["cell"].alias("_cell"), F.get("near", F.lit(0))["cosine"].alias("_cosine"))
        # The id spreads a cell over several ranges, so that none has to hold it whole.
        out = out.repartitionByRange("_cell", F.xxhash64(self.id_col)).sortWithinPartitions("_cell")
        out.write.mode("overwrite").parquet(f"{self.path}/points/batch={batch}")
        sizes = self.spark.read.parquet(f"{self.path}/points/batch={batch}").groupBy("_cell").agg(F.count("*").alias("n"), F.min("_cosine").alias("least"))
        sizes.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/sizes/batch={batch}")
        return self

    def points(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/points")

    def sizes(self) -> DataFrame:
        """``(cell, n, least)``: at most ``MAX_CELLS`` rows; ``least`` is the smallest cosine to the centroid."""
        return self.spark.read.parquet(f"{self.path}/sizes").groupBy(F.col("_cell").alias("cell")).agg(F.sum("n").alias("n"), F.min("least").alias("least"))

    def _met(self, probes: DataFrame, k: int, where: Column | None) -> DataFrame:
        """``(qid, pid, score)``: the ``k`` best of each meeting of a block of queries and a block of points."""
        points = self.points()
        if where is not None:
            points = points.where(where)
        cells = [r.cell for r in probes.select("cell").distinct().limit(MAX_LISTED + 1).collect()]
        if len(cells) <= MAX_LISTED:
            points = points.where(F.col("_cell").isin(cells) if cells else F.lit(False))
        # One row for each cell: blocks of its points and of the queries that probe it.
        blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.coalesce(n, F.lit(0)) / search.BLOCK)).cast("int")
        dealt = self.sizes().join(probes.groupBy("cell").agg(F.count("*").alias("q")), "cell").select("cell", blocks(F.col("n")).alias("np"), blocks(F.col("q")).alias("nq"))
        dealt = F.broadcast(dealt)
        block = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        left = probes.join(dealt, "cell").select("qid", "qv", "cell", block("qid", F.col("nq")).alias("qb"), every(F.col("np")).alias("pb"))
        right = points.select(F.col(self.id_col).alias("pid"), F.col(self.vector).alias("pv"), F.col("_cell").alias("cell"))
        right = right.join(dealt, "cell").select("pid", "pv", "cell", block("pid", F.col("np")).alias("pb"), every(F.col("nq")).alias("qb"))
        return search.meet(left, right, ["cell", "qb", "pb"], k)

    def search(self, queries: DataFrame, k: int, probes: int, where: Column | None = None, exact: bool = False, query_id: str = "query_id") -> DataFrame:
        """``(query_id, id, score, place, scored)``: the ``k`` best points in the ``probes`` nearest cells of each query.

        ``exact``: then also in every cell whose bound reaches the ``k``-th score (or in all, where fewer
        were found), which gives the points of ``search.top_k_batch`` among those with a usable vector. ``scored`` is the
        number of points in the probed cells. Ties go by id; queries without a usable vector, and those
        whose cells hold nothing, have no rows. ``query_id`` must be unique.
        """
        asked = _usable(queries.select(F.col(query_id).alias("qid"), F.col("embedding").alias("qv")), "qv")
        centroids = self.centroids()
        kinds = f"{query_id} {queries.schema[query_id].dataType.simpleString()}, {self.id_col} {self.points().schema[self.id_col].dataType.simpleString()}"
        if not len(centroids):
            return self.spark.createDataFrame([], f"{kinds}, score double, place int, scored long")
        near = _assigned(asked, centroids, "qv", len(centroids) if exact else min(probes, len(centroids)))
        with scratch(self.spark):
            listed = near.select("qid", "qv", F.posexplode("near").alias("turn", "x")).select("qid", "qv", "turn", "x.cell", "x.cosine")
            listed = stored(listed.join(F.broadcast(self.sizes()), "cell"), "probes")
            first = listed.where(F.col("turn") < probes)
            met = self._met(first, k, where)
            probed = first.select("qid", "n")
            if exact:
                met = stored(met, "met")
                place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "pid"))
                last = met.withColumn("place", place).where(F.col("place") == k).select("qid", F.col("score").alias("last"))
                # A point within an angle r of its centroid is no nearer to a query at angle a than a - r.
                angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), "cosine"))) - F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), "least")))
                bound = F.cos(F.greatest(F.lit(0.0), angle)) + 1e-7
                more = listed.where(F.col("turn") >= probes).join(last, "qid", "left").where(F.col("last").isNull() | (bound >= F.col("last")))
                more = stored(more.select("qid", "qv", "cell", "n"), "more")
                met = met.union(self._met(more, k, where))
                probed = probed.union(more.select("qid", "n"))
            best = met.withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "pid"))).where(F.col("place") <= k)
            out = best.join(probed.groupBy("qid").agg(F.sum("n").alias("scored")), "qid")
            out = out.select(F.col("qid").alias(query_id), F.col("pid").alias(self.id_col), "score", "place", "scored")
            return stored(out, "found", scope=2)

    def probes_for(self, queries: DataFrame, k: int, recall: float = 0.9, query_id: str = "query_id") -> tuple[int, float]:
        """The least number of probes that finds ``recall`` of the exact ``k`` best of ``queries`` (a bounded set), and the
        recall that it has.

        A point of the exact result is found as soon as its cell is probed, so the place of that cell among the
        query's cells is all that has to be counted. Ids must be unique."""
        centroids = self.centroids()
        if not len(centroids):
            return 1, 1.0
        with scratch(self.spark):
            want = search.top_k_batch(_usable(self.points(), self.vector), queries, k, id_col=self.id_col, query_id=query_id)
            asked = _usable(queries.select(F.col(query_id).alias("qid"), F.col("embedding").alias("qv")), "qv")
            near = _assigned(asked, centroids, "qv", len(centroids)).select("qid", F.posexplode("near").alias("turn", "x")).select("qid", "turn", F.col("x.cell").alias("cell"))
            cells = self.points().select(F.col(self.id_col).alias("pid"), F.col("_cell").alias("cell"))
            met = want.select(F.col(query_id).alias("qid"), F.col(self.id_col).alias("pid")).join(cells, "pid").join(near, ["qid", "cell"])
            turns = {r.turn: r["count"] for r in met.groupBy("turn").count().collect()}  # at most the number of cells
        total, so_far = sum(turns.values()), 0
        for turn in range(len(centroids)):
            so_far += turns.get(turn, 0)
            if so_far >= recall * total:
                break
        return turn + 1, so_far / total if total else 1.0


def complete(spark: SparkSession, path: str) -> bool:
    """Whether an index lies in a folder, its first batch with it."""
    return exists(spark, f"{path}/sizes/batch=0/_SUCCESS")
