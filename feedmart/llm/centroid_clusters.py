"""Centroid clustering over zone maps in Hilbert order.

Vectors are whole numbers, floor(256 x). The steps:

1. Order. The dimensions with the largest variance (CURVE_DIMS of them, CURVE_BITS bits each) give every vector its place on a
   Hilbert curve. Vectors are range partitioned and sorted by it, so neighbours on the curve share a block.
2. Zone maps. Each partition is cut into blocks of BLOCK vectors; a block is one row with its ids, its packed vectors
   and the box of their smallest and largest components over all dimensions. The blocks are written once, and every round reads them.
3. Rounds. For each block the box bounds the squared distance to every centroid from below and above. A centroid whose least distance
   is above another's largest is no candidate; nor is one that is farther than the centroid nearest to the box's
   middle from every point of the box (the difference of two squared distances is linear, so its least value over
   the box is exact). The block's vectors are compared with the candidates in one matrix product, in exact integers. Tasks return
   sums and counts per centroid and dimension, never vectors; the driver holds centroids only.

Rounds move no vectors: the only shuffle of vectors is that of step 1. A vector that occurs very often is
spread over partitions, as ids and row numbers follow the place on the curve in the sort order.

Defined results: vectors that are null, that have another number of components than ``dims``, or a null, NaN or infinite component are
left out. Components beyond 2^27 / 256 fail the job with an error. The first centroids are the k vectors with the smallest SHA-256 of
``seed:id``; rows with one id go by their components, rows without an id come last. With fewer than k vectors there are as
many centroids. Centroids that are equal, and equal distances, go to the smaller number. Repeated rows count each. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_rows, shuffle_partitions, staged
from .vectors import EXACT_DOUBLE, finite, matrix, scaled, unpack

CURVE_DIMS, CURVE_BITS = 9, 7
BLOCK = 128
BLOCKS_PER_BATCH = 64  # of Arrow: 64 blocks of 128 vectors with 64 components are 2 MB


def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve through the grid of 2^bits cells a side, of each row of cell numbers (dims * bits <= 63).

    From the highest bit down, each cell is turned into the frame of its sub-cube (an exchange with, or a reflection of, the first
    axis); what is left is a Gray code, whose bits are then taken axis by axis."""
    x = cells.astype(np.int64).T.copy()  # one contiguous row an axis
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = np.int64((1 << b) - 1)
        for axis in x:
            reflect = ((axis >> b) & 1).astype(bool)
            swap = np.where(reflect, 0, (x[0] ^ axis) & low)
            axis ^= swap
            x[0] ^= np.where(reflect, low, swap)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1, np.int64((1 << b) - 1), 0)
    x ^= turn
    place = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << 1) | ((axis >> b) & 1)
    return place


# -- zone maps

def _spread(vectors: DataFrame, dims: int) -> list:
    """Per dimension (0 to dims - 1): smallest and largest component, variance. Tasks sum first; one row a dimension comes back."""
    def sums(batches):
        n, total, square = 0, np.zeros(dims), np.zeros(dims)
        low, high = np.full(dims, np.iinfo(np.int32).max), np.full(dims, np.iinfo(np.int32).min)
        for b in batches:
            if b.num_rows:
                x = matrix(b.column(0), dims)
                n += len(x)
                total += x.sum(0, dtype=np.float64)
                square += (x.astype(np.float64) ** 2).sum(0)
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, n)), pa.array(total), pa.array(square),
                                              pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names=["dim", "n", "total", "square", "low", "high"])
    parts = vectors.select("vector").mapInArrow(sums, "dim int, n long, total double, square double, low int, high int")
    mean = F.sum("total") / F.sum("n")
    return parts.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"), (F.sum("square") / F.sum("n") - mean * mean).alias("variance")).collect()


def zone_maps(vectors: DataFrame, dims: int) -> DataFrame:
    """Blocks of ``vectors`` (vec_id, vector: array<int>) in Hilbert order: ids, packed vectors, least and largest components."""
    spark = vectors.sparkSession
    spread = sorted(_spread(vectors, dims), key=lambda r: (-r["variance"], r["dim"]))[:CURVE_DIMS]
    axes = [r["dim"] for r in spread]
    low = np.array([r["low"] for r in spread], np.float64)
    width = np.array([max(1, r["high"] - r["low"] + 1) for r in spread], np.float64)

    def placed(batches):
        for b in batches:
            x = matrix(b.column(1), dims)
            cells = ((x[:, axes] - low) / width * (1 << CURVE_BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(hilbert_place(cells, CURVE_BITS))],
                                             names=["vec_id", "vector", "row", "place"])

    def block(ids: list, x: np.ndarray) -> tuple:
        return ids, x.astype("<i4").tobytes(), x.min(0).astype("<i4").tobytes(), x.max(0).astype("<i4").tobytes()

    def packed(batches):
        ids, held = [], np.zeros((0, dims), np.int32)
        out = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()))], names=["ids", "vectors", "low", "high"])
        for b in batches:
            ids += b.column(0).to_pylist()
            held = np.concatenate([held, matrix(b.column(1), dims)])
            whole = len(ids) // BLOCK * BLOCK
            if whole:
                yield out([block(ids[i:i + BLOCK], held[i:i + BLOCK]) for i in range(0, whole, BLOCK)])
                ids, held = ids[whole:], held[whole:]
        if ids:
            yield out([block(ids, held)])
    rows = vectors.withColumn("row", F.monotonically_increasing_id()).mapInArrow(placed, "vec_id long, vector array<int>, row long, place long")
    rows = rows.repartitionByRange(shuffle_partitions(spark), "place", "vec_id", "row").sortWithinPartitions("place", "vec_id", "row")
    return staged(rows.select("vec_id", "vector").mapInArrow(packed, "ids array<long>, vectors binary, low binary, high binary"), "zone-maps")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of the box from ``low`` to ``high`` (exact integers)."""
    low, high, c = low.astype(np.int64), high.astype(np.int64), centroids.astype(np.int64)
    below, above = low - c, c - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
    most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(1)
    left = np.flatnonzero(least <= most.min())
    middle = (low + high) // 2
    pivot = left[np.argmin(((c[left] - middle) ** 2).sum(1))]
    # |x - c|^2 - |x - p|^2 = |c|^2 - |p|^2 - 2 x (c - p), whose least value over the box takes one end per dimension
    step = c[left] - c[pivot]
    farther = (c[left] ** 2).sum(1) - (c[pivot] ** 2).sum() - 2 * np.where(step > 0, high * step, low * step).sum(1)
    return left[farther <= 0]


def nearest(x: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest of the centroids ``among`` (ascending), and the squared distance, of each row of ``x``."""
    c = centroids[among]
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT_DOUBLE and x.shape[1] <= 128:
        a, b = x.astype(np.float64), c.astype(np.float64)
        far = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    else:
        far = np.stack([((x.astype(np.int64) - one) ** 2).sum(1) for one in c.astype(np.int64)], 1)
    at = far.argmin(1)  # the first of equal ones
    return among[at].astype(np.int32), far[np.arange(len(x)), at].astype(np.int64)


# -- rounds

def _blocks(batches, dims: int):
    for b in batches:
        for ids, data, low, high in zip(*(b.column(i) for i in range(4))):
            yield ids, unpack(data.as_buffer(), dims), unpack(low.as_buffer(), dims)[0], unpack(high.as_buffer(), dims)[0]


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dims = centroids.shape

    def sums(batches):
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x, low, high in _blocks(batches, dims):
            to, _ = nearest(x, centroids, candidates(low, high, centroids))
            order = np.argsort(to, kind="stable")
            found, start = np.unique(to[order], return_index=True)
            total[found] += np.add.reduceat(x[order].astype(np.int64), start)
            count += np.bincount(to, minlength=k)
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(used))),
                                              pa.array(total[used].ravel()), pa.array(np.repeat(count[used], dims))], names=["cluster", "dim", "total", "n"])
    parts = blocks.mapInArrow(sums, "cluster int, dim int, total long, n long")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # k * dims rows at most
        out[r["cluster"], r["dim"]] = r["total"] // r["n"]
    return out


def _assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    def rows(batches):
        for ids, x, low, high in _blocks(batches, centroids.shape[1]):
            to, far = nearest(x, centroids, candidates(low, high, centroids))
            yield pa.RecordBatch.from_arrays([ids.values, pa.array(to), pa.array(far)], names=["vec_id", "cluster", "distance"])
    return staged(blocks.mapInArrow(rows, "vec_id long, cluster int, distance long"), "assigned")


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest hash of ``seed:id``, in that order."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(rank.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.array([r[0] for r in rows], np.int64)


def clusters(table: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2", dims: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of ``table`` that takes part."""
    spark: SparkSession = table.sparkSession
    raw = F.col(vector_col)
    own = table.filter((F.size(raw) == dims) & finite(raw)).select(F.col(id_col).cast("long").alias("vec_id"), scaled(raw).alias("vector"))
    centroids = first_centroids(own, k, seed)
    if not len(centroids):
        return own.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
                          F.lit("").alias("centroid_sha256"))
    blocks = zone_maps(own, dims)
    with batch_rows(spark, BLOCKS_PER_BATCH):
        for _ in range(rounds):
            centroids = _moved(blocks, centroids)
        found = _assigned(blocks, centroids)
    totals = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows at most
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    whole = sum(totals.values())
    per_cluster = spark.createDataFrame([(c, t, whole, digest[c]) for c, t in sorted(totals.items())],
                                        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(per_cluster), "cluster")  # k rows at most
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


__all__ = ["candidates", "clusters", "first_centroids", "hilbert_place", "nearest", "zone_maps"]
