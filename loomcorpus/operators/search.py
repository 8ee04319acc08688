"""Vector search: filtered exact top-k, batches of queries, and routing by centroids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcorpus.functions.vectors import centroids, cosine


def top_k(points: DataFrame, query: DataFrame, k: int, where: Column | None = None, id_col: str = "point_id") -> DataFrame:
    """The ``k`` nearest points to the one vector of ``query``; the filter runs before any scoring.

    One broadcast vector, one pass, a heap of ``k`` rows per task.
    """
    rows = points if where is None else points.where(where)
    scored = rows.crossJoin(F.broadcast(query.select(F.col("embedding").alias("_q")).limit(1)))
    scored = scored.withColumn("score", cosine(F.col("embedding"), F.col("_q"))).drop("_q")
    return scored.orderBy(F.desc("score"), id_col).limit(k)


#: Queries and points of one block: what a task holds at once of either side.
BLOCK = 4096
#: Queries scored together within a block.
_STEP = 256


def unit(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors in double precision and of length one; zero vectors stay zero."""
    whole = pa.concat_arrays(vectors.chunks) if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length == 0, 1.0, length)


def _block_tops(queries: pa.Table, points: pa.Table, k: int, schema: pa.Schema) -> pa.Table:
    """The ``k`` best points of one block for each query of one block."""
    if not len(queries) or not len(points):
        return schema.empty_table()
    points = points.sort_by("pid")
    q, p = unit(queries.column("qv")), unit(points.column("pv"))
    rows, picks, scores = [], [], []
    for at in range(0, len(q), _STEP):
        score = np.round(q[at : at + _STEP] @ p.T, 10)
        top = np.argsort(-score, axis=1, kind="stable")[:, :k]
        rows.append(np.repeat(np.arange(at, at + len(score)), top.shape[1]))
        picks.append(top.ravel())
        scores.append(np.take_along_axis(score, top, axis=1).ravel())
    columns = [queries.column("qid").take(pa.array(np.concatenate(rows))), points.column("pid").take(pa.array(np.concatenate(picks))), pa.array(np.concatenate(scores))]
    return pa.table(columns, schema=schema)


def meet(left: DataFrame, right: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``(qid, pid, score)``: of every group of queries (qid, qv) and points (pid, pv) of equal ``keys`` the ``k`` best of each query."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = {f.name: f.dataType.simpleString() for f in [*left.schema, *right.schema]}
    empty = left.sparkSession.createDataFrame([], f"qid {kinds['qid']}, pid {kinds['pid']}, score double").schema
    schema = to_arrow_schema(empty)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda q, p: _block_tops(q, p, k, schema), empty)


def top_k_batch(points: DataFrame, queries: DataFrame, k: int, where: Column | None = None, id_col: str = "point_id", query_id: str = "query_id") -> DataFrame:
    """``(query_id, id_col, score, place)``: the ``k`` nearest points to every vector of ``queries``.

    The filter runs before any scoring. Both sides are dealt into blocks of about ``BLOCK`` rows and
    every block of queries meets every block of points in a task of its own; of each meeting only
    the best ``k`` of a query go on. Cosines are rounded to ten places, and equal ones go by id. Rows
    without a vector are neither found nor asked.
    """
    rows = points if where is None else points.where(where)
    rows = rows.select(F.col(id_col).alias("pid"), F.col("embedding").alias("pv")).where("pv is not null")
    asked = queries.select(F.col(query_id).alias("qid"), F.col("embedding").alias("qv")).where("qv is not null")
    n_points, n_asked = max(1, -(-rows.count() // BLOCK)), max(1, -(-asked.count() // BLOCK))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qb", dealt("qid", n_asked)).withColumn("pb", every(n_points))
    right = rows.withColumn("pb", dealt("pid", n_points)).withColumn("qb", every(n_asked))
    met = meet(left, right, ["qb", "pb"], k)
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "pid"))
    best = met.withColumn("place", place).where(F.col("place") <= k)
    return best.select(F.col("qid").alias(query_id), F.col("pid").alias(id_col), "score", "place")


#: Routes whose centroids are sent to the tasks as one array; more are searched like points.
MAX_ROUTES = 1000


def route(queries: DataFrame, examples: DataFrame, group: str, default: int | str, least: float, id_col: str = "point_id") -> DataFrame:
    """The route whose centroid is nearest, and its score, for every row of ``queries``.

    Cosines are in double precision and rounded to ten places; of equally near routes the least wins.
    ``default`` stands for a score below ``least`` or not above 0, and so for rows without a vector (null, of zeros only,
    or with an entry that is null or not a number), which have score 0. Rows that repeat an id each get their route.
    """
    means = centroids(examples, group, "embedding")
    clean = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c))
    asked = queries.select(id_col, F.when(clean, F.col("embedding")).alias("embedding"))
    if means.select(group).limit(MAX_ROUTES + 1).count() > MAX_ROUTES:
        points = means.select(F.col(group).alias("route"), F.col("centroid").alias("embedding"))
        vectors = asked.where("embedding is not null").select(F.col("embedding").alias("query_id"), "embedding").distinct()
        best = top_k_batch(points, vectors, 1, id_col="route").select(F.col("query_id").alias("embedding"), "route", "score")
        best = asked.join(best, "embedding", "left")
    else:
        listed = means.select(F.struct(F.col(group), "centroid").alias("c")).agg(F.collect_list("c").alias("routes"))
        near = F.transform("routes", lambda r: F.struct((-F.round(F.coalesce(cosine(F.col("embedding"), r["centroid"]), F.lit(0.0)), 10)).alias("away"), r[group].alias("route")))
        scored = asked.crossJoin(F.broadcast(listed)).select(id_col, F.array_min(near).alias("s"))  # one row of routes
        best = scored.select(id_col, F.col("s.route").alias("route"), (-F.col("s.away")).alias("score"))
    score = F.greatest(F.coalesce("score", F.lit(0.0)), F.lit(0.0)) + 0.0
    chosen = F.when((score < least) | (score <= 0), F.lit(default)).otherwise(F.col("route"))
    return best.select(id_col, chosen.alias("route"), score.alias("score"))
