"""Centroid clustering (Lloyd's rounds) on integer vectors, with scalar lookup tables for the distances.

Components become integers floor(scale * x).  In a round, a task tabulates
for each dimension the squared difference between every integer that occurs in
its piece and that dimension of every centroid.  The distances of the piece's
vectors are then gathers from these tables, summed over the dimensions; no
difference is computed twice for one value.

Rounds.  Integer vectors are written once to the shared folder, and every
round is one job over them.  A task adds up the vectors and counts of its
clusters and sends one row per cluster, so a cluster that holds a third of all
rows travels as one row per task.  Spark adds these rows; the driver receives
the sums alone (k rows) and returns the next centroids in the task code.  Sums
are exact integers, means are exact floors, so results don't depend on the
partitioning or on tasks that run twice.

Centroids start as the k kept vectors with the smallest hash of the id (ties,
as of repeated rows: smaller vector), in that order; they are all different
rows, though they can be equal vectors.  Fewer vectors than k make as many
centroids.  The nearest centroid with the smallest number wins.  A centroid
without vectors stays.

Cases.  Vectors that are null, hold a null or non-finite component or have
another number of components than ``dim`` take no part, nor do rows without an
id.  So do those with a component of 2^27 or more after scaling (or infinite
then): their distances could exceed a long.  Repeated rows count and are
returned as often as they occur.  Extra columns are ignored.  An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm.common import cut

LIMIT = 1 << 27  # 64 squared differences of two smaller integers add up to a long
PIECE_ROWS = 4096


def integers(vectors: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and their integer components (one row per vector that does)."""
    n = len(vectors)
    size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(size == dim)
    flat = pc.list_flatten(vectors.take(pa.array(right, pa.int64())))
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(right), dim)  # null: nan
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * scale)
        good = (np.abs(values) < LIMIT).all(axis=1)  # false for nan
    kept = np.zeros(n, bool)
    kept[right[good]] = True
    return kept, values[good].astype(np.int32)


def integer_vectors(df: DataFrame, dim: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and integer ``v`` of the vectors that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter("vec_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values = integers(batch.column("v"), dim, scale)
            ids = batch.column("vec_id").filter(pa.array(kept))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * dim, pa.int32()), pa.array(values.ravel()))
            yield pa.record_batch([ids, lists], names=["vec_id", "v"])

    return rows.mapInArrow(run, "vec_id long, v array<int>")


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return pc.list_flatten(vectors).to_numpy(zero_copy_only=False).reshape(len(vectors), dim)


def occurring(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers that occur, ascending, and for each value its place among them."""
    low, high = int(values.min()), int(values.max())
    if high - low > 16 * len(values) + 1024:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(high - low + 1, bool)
    seen[values - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[values - low]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, and its squared distance, of every vector."""
    total = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        ints, place = occurring(vectors[:, d])
        table = (ints[:, None].astype(np.int64) - centroids[None, :, d]) ** 2
        total += table[place]
    best = total.argmin(axis=1)  # the first of equal ones
    return best, total[np.arange(len(best)), best]


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            piece = batch.slice(start, PIECE_ROWS)
            vectors = matrix(piece.column("v"), centroids.shape[1])
            yield piece, vectors, *nearest(vectors, centroids)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign every vector, and take the floored means of the clusters."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, values, best, _ in _assigned(batches, centroids):
            order = np.argsort(best, kind="stable")
            at = np.flatnonzero(np.diff(best[order], prepend=-1))
            found = best[order][at]
            sums[found] += np.add.reduceat(values[order].astype(np.int64), at, axis=0)
            count += np.bincount(best, minlength=k)
        used = np.flatnonzero(count)
        if len(used):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * dim, pa.int32()), pa.array(sums[used].ravel()))
            yield pa.record_batch([pa.array(used, pa.int64()), pa.array(count[used]), lists], names=["cluster", "n", "s"])

    parts = vectors.mapInArrow(run, "cluster long, n long, s array<long>")
    exact = "decimal(38,0)"
    totals = (parts.select("cluster", "n", F.posexplode("s").alias("d", "x")).groupBy("cluster", "d")
              .agg(F.sum(F.col("x").cast(exact)).alias("x"), F.sum(F.col("n").cast(exact)).alias("n")).collect())  # k * dim rows at most
    out = centroids.copy()
    for r in totals:
        out[r["cluster"], r["d"]] = int(r["x"]) // int(r["n"])
    return out


def first_centroids(vectors: DataFrame, k: int, dim: int, salt: str) -> np.ndarray:
    top = (vectors.select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).alias("h"), "v")
           .orderBy("h", "v").limit(k).collect())
    return np.array([r["v"] for r in top], np.int64).reshape(len(top), dim)


def fit(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, salt: str = "2:") -> np.ndarray:
    """Centroids after the rounds, of (written) integer vectors."""
    centroids = first_centroids(vectors, k, dim, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(vectors, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, best, distance in _assigned(batches, centroids):
            yield pa.record_batch([piece.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)],
                                  names=["vec_id", "cluster", "distance"])

    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


CLUSTERS = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
                         T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])


def _long(x: int) -> int | None:
    return x if x < 1 << 63 else None


def cluster(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2:") -> DataFrame:
    """Every vector with its cluster: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    An inertia that exceeds a long is null."""
    vectors = cut(integer_vectors(df, dim, scale))
    centroids = fit(vectors, k, rounds, dim, salt)
    found = cut(assign(vectors, centroids))
    sums = {r["cluster"]: int(r["s"]) for r in
            found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows at most
    all_ = _long(sum(sums.values()))
    clusters = df.sparkSession.createDataFrame([(c, _long(s), all_, centroid_digest(centroids[c])) for c, s in sums.items()], CLUSTERS)
    return found.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
