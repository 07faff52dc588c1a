"""Clustering of integer vectors around centroids, with a progressive search in the Walsh-Hadamard domain.

The Walsh-Hadamard transform of integers is exact and keeps squared distances, but for a factor of the length. Vectors and
centroids are transformed; a vector's squared differences to all centroids are added up coefficient by coefficient, coarse
ones (few changes of sign) first. The centroid that is ahead after the first ones is finished at once; others are
given up as soon as their sum so far is greater than the least finished sum, as it can only grow. Whoever is left is finished
over all coefficients, so that the nearest centroid, and ties, are exact.

All arithmetic is in integers: of 64 bits where the components allow it, and Python's beyond.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.scratch import written

#: Vectors with a component of this size or more are held in Python's integers.
SMALL = 1 << 21
#: Sums go through Spark in digits of so many bits.
DIGIT = 30
_LONG = (-(1 << 63), (1 << 63) - 1)
_ROWS = 1024


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of each row, coefficients by number of changes of sign; the length is a power of two."""
    n = x.shape[1]
    out, size = x.copy(), 1
    while size < n:
        halves = out.reshape(len(x), n // (2 * size), 2, size)
        out = np.stack((halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]), 2).reshape(len(x), n)
        size *= 2
    return out[:, _by_sequency(n)]


def inverse(t: np.ndarray) -> np.ndarray:
    """The vectors behind transforms."""
    n = t.shape[1]
    natural = np.empty_like(t)
    natural[:, _by_sequency(n)] = t
    return walsh_hadamard(natural)[:, np.argsort(_by_sequency(n))] // n


def _by_sequency(n: int) -> np.ndarray:
    """The rows of the natural order (Kronecker powers of [[1, 1], [1, -1]]) by their changes of sign."""
    parity = np.array([[(i & j).bit_count() & 1 for j in range(n)] for i in range(n)], np.int8).reshape(n, n)
    return np.argsort(np.abs(np.diff(parity, axis=1)).sum(1), kind="stable")


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles; 64-bit integers if all are small, else Python's."""
    if np.abs(x).max(initial=0) < SMALL / scale:
        return np.floor(x * scale).astype(np.int64)
    # A double of 2^53 or more is an integer; below that the product with a small scale is exact.
    return np.array([[int(v) * scale if abs(v) >= 1 << 53 else math.floor(v * scale) for v in row] for row in x.tolist()], object).reshape(x.shape)


def nearest(t: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance times the length) of each transformed vector; ties to the smaller number."""
    n, width = t.shape
    if n and (t.dtype == object or centroids.dtype == object or 4 * width * int(max(np.abs(t).max(), np.abs(centroids).max())) ** 2 >= 1 << 63):
        t, centroids = t.astype(object), centroids.astype(object)
    best, total = np.zeros(n, np.int64), np.zeros(n, t.dtype)
    for a in range(0, n, _ROWS):
        x = t[a : a + _ROWS]
        stages = [(0, min(4, width)), *((k, 2 * k) for k in (4, 8, 16, 32, 64, 128) if k < width)]
        sums = np.zeros((len(x), len(centroids)), t.dtype)
        for lo, hi in stages[:1]:
            for k in range(lo, hi):
                sums = sums + (x[:, k : k + 1] - centroids[:, k]) ** 2
        ahead = sums.argmin(1)
        bound = ((x - centroids[ahead]) ** 2).sum(1)
        row, c = np.nonzero(sums <= bound[:, None])
        sums = sums[row, c]
        for lo, hi in stages[1:]:
            sums = sums + ((x[row, lo:hi] - centroids[c, lo:hi]) ** 2).sum(1)
            left = sums <= bound[row]
            row, c, sums = row[left], c[left], sums[left]
        # Rows come in order, centroids in order within them: a row's first least sum is the answer.
        start = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(sums, start)
        hit = np.flatnonzero(sums == least[row])
        first = hit[np.searchsorted(row[hit], np.arange(len(x)))]
        best[a : a + _ROWS], total[a : a + _ROWS] = c[first], least
    return best, total


def _digits(sums: np.ndarray, n: int) -> np.ndarray:
    """Integers in ``n`` digits each, lowest first; the highest keeps the sign."""
    out = []
    for _ in range(n - 1):
        out.append((sums & ((1 << DIGIT) - 1)).astype(np.int64))
        sums = sums >> DIGIT
    return np.stack([*out, sums.astype(np.int64)], -1)


def _rows(b: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    return walsh_hadamard(scaled(np.asarray(b.column(1).flatten(), np.float64).reshape(-1, dim), scale))


def _sums(kept: DataFrame, centroids: np.ndarray, scale: int, digits: int) -> list:
    """(cluster, count, sums of the transforms in digits) of each non-empty cluster."""
    k, dim = centroids.shape
    shared = kept.sparkSession.sparkContext.broadcast(centroids)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), object)
        for b in batches:
            t = _rows(b, dim, scale)
            own, _ = nearest(t, shared.value)
            counts += np.bincount(own, minlength=k)
            for c in np.unique(own):
                sums[c] += t[own == c].sum(0).astype(object)
        full = np.flatnonzero(counts)
        parts = pa.array(_digits(sums[full], digits).reshape(len(full), -1).tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(counts[full]), parts], names=["cluster", "n", "sums"])

    found = kept.mapInArrow(each, "cluster int, n long, sums array<long>").groupBy("cluster")
    return found.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dim * digits)]).alias("sums")).collect()


def starting_rows(kept: DataFrame, id_col: str, vector_col: str, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``2:`` and the id, in that order; equal ids by their vectors, null ids last."""
    key = F.sha2(F.concat(F.lit("2:"), F.col(id_col).cast("string")).cast("binary"), 256)
    rows = kept.orderBy(key.asc_nulls_last(), vector_col).limit(k).select(vector_col).collect()
    return np.array([r[0] for r in rows], np.float64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, k: int = 40, rounds: int = 5, scale: int = 256) -> DataFrame:
    """(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dim`` finite components.

    Components are taken as floor(scale * x). ``dim`` is a power of two. Vectors that are null, of another length, or that
    hold null or non-finite components are left out; repeated rows count each. With fewer than ``k`` vectors each is
    a centroid at first; an empty table gives an empty result. Distances and inertias beyond a long are given as
    the largest long. Other columns don't matter. The rounds run while the result is being built; the driver holds the
    ``k`` centroids and their sums only.
    """
    if dim < 1 or dim & (dim - 1) or dim > 256:
        raise ValueError("dim must be a power of two, 256 at most")
    spark = vectors.sparkSession
    v = F.col(vector_col)
    good = v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = written(vectors.where(good).select(F.col(id_col).alias("id"), v.alias("v")), "clustered")
    largest = kept.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()[0]
    schema = f"{id_col} {kept.schema['id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if largest is None:
        return spark.createDataFrame([], schema)
    # A transform's components are dim times a vector's at most; small ones leave room for 2^35 rows in one digit.
    digits = 1 if largest * scale < SMALL else 2 + (math.ceil(math.log2(largest)) + (scale * dim).bit_length() + 1) // DIGIT
    centroids = walsh_hadamard(scaled(starting_rows(kept, "id", "v", k), scale))
    for _ in range(rounds):
        at = centroids.astype(object)
        for r in _sums(kept, centroids, scale, digits):
            sums = [sum(d << (DIGIT * i) for i, d in enumerate(r["sums"][j : j + digits])) for j in range(0, dim * digits, digits)]
            means = inverse(np.array([sums], object)) // r["n"]
            at[r["cluster"]] = walsh_hadamard(means)[0]
        centroids = at.astype(np.int64) if digits == 1 else at
    final = inverse(centroids.astype(object))
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, total = nearest(_rows(b, dim, scale), shared.value)
            distance = [min(int(d) // dim, _LONG[1]) for d in total] if total.dtype == object else total // dim
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    id_type = kept.schema["id"].dataType.simpleString()
    assigned = written(kept.mapInArrow(assign, f"id {id_type}, cluster int, distance long"), "assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = min(sum(inertia.values()), _LONG[1])
    # One row for each of the k clusters.
    rows = [(c, min(s, _LONG[1]), whole, hashlib.sha256(",".join(map(str, final[c])).encode()).hexdigest()) for c, s in inertia.items()]
    ends = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = assigned.join(F.broadcast(ends), "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
