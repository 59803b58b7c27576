"""Centroid clustering of vectors with whole-number components, pruned by Ptolemaic pivots.

A few pivots are fixed before the first round and each vector's distances to them are kept beside it. For any pivots p
and s, Ptolemy's inequality bounds a vector's distance to a centroid c from below,

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s),

so a round needs only the pivot distances of the centroids. The centroid of the least bound is measured exactly first;
another is measured only if its bound, rounded down by more than the arithmetic can err, does not exceed that distance.
Everything that decides is exact: components are integers, distances are 64-bit integers, sums are decimals.

Each round reads the kept vectors once, sends (component sums, count) per task and cluster, and nothing else; no row is
shuffled. The driver holds the centroids and a bounded sample of vectors for pivots and the start.

Rows without a vector, with a null or non-finite component or of another width are left out. Rows may repeat and vec_id
may be null (such a row is clustered but starts no centroid). Fewer vectors than centroids give fewer centroids, an
empty table an empty result. Extra columns are not read. Components whose scaled size is 2^27 or more have distances
that no 64-bit column can hold and raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.storage import discard, materialise

LARGEST = 1 << 27
BLOCK = 4096  # rows compared at once
SLACK = 1e-12  # relative error that a bound may have; the arithmetic errs by less than 1e-14


def whole_components(vector: str, scale: int) -> Column:
    """floor(scale * x) of each component, as longs."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))


def finite(vector: str) -> Column:
    """True where a vector is there and all its components are finite numbers."""
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fine, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of the rows of `x` to each pivot, from exact squares."""
    out = np.empty((len(x), len(pivots)))
    for low in range(0, len(x), BLOCK):
        for j, p in enumerate(pivots):
            apart = x[low : low + BLOCK] - p
            out[low : low + BLOCK, j] = np.sqrt(np.einsum("ij,ij->i", apart, apart).astype(float))
    return out


def lower_bounds(near: np.ndarray, to_centroids: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Least possible distance of each row to each centroid, given both sides' distances to the pivots.

    `near` is rows x pivots, `to_centroids` centroids x pivots, `pairs` (p, s, d(p, s)) with d > 0.
    """
    best = np.zeros((len(near), len(to_centroids)))
    for p, s, apart in pairs:
        one, other = near[:, p, None] * to_centroids[None, :, s], near[:, s, None] * to_centroids[None, :, p]
        np.maximum(best, (np.abs(one - other) - SLACK * (one + other)) / apart, out=best)
    return best * (1 - SLACK)


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, to_centroids: np.ndarray, pairs) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, distances measured) of each row; of equal distances the smaller number wins."""
    cluster, distance, measured = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64), 0
    for low in range(0, len(x), BLOCK):
        rows = x[low : low + BLOCK]
        bounds = lower_bounds(near[low : low + BLOCK], to_centroids, pairs)
        first = bounds.argmin(axis=1)
        apart = rows - centroids[first]
        least, at = np.einsum("ij,ij->i", apart, apart), first.astype(np.int32)
        measured += len(rows)
        for c in range(len(centroids)):
            # Squares of both sides: a root of a long may round up to half a unit in its last place.
            left = np.flatnonzero((first != c) & (bounds[:, c] ** 2 * (1 - SLACK) <= least))
            if len(left):
                apart = rows[left] - centroids[c]
                d = np.einsum("ij,ij->i", apart, apart)
                closer = (d < least[left]) | (d == least[left]) & (c < at[left])
                least[left[closer]], at[left[closer]] = d[closer], c
                measured += len(left)
        cluster[low : low + BLOCK], distance[low : low + BLOCK] = at, least
    return cluster, distance, measured


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots far from each other: the first of the sample, then always the one farthest from those chosen."""
    if not len(sample):
        return sample
    chosen = [0]
    far = pivot_distances(sample, sample[:1])[:, 0]
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, pivot_distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _assign(kept: DataFrame, centroids: np.ndarray, pivots: np.ndarray, width: int, *, sums: bool) -> DataFrame:
    """Per task and cluster the sums (cluster, pos, total; pos -1 counts rows), or per row (vec_id, cluster, distance)."""
    to_centroids = pivot_distances(centroids, pivots)
    among = pivot_distances(pivots, pivots)
    pairs = [(p, s, among[p, s]) for p in range(len(pivots)) for s in range(p) if among[p, s] > 0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, _ = nearest(_matrix(batch.column(1), width), _matrix(batch.column(2), len(pivots)), centroids, to_centroids, pairs)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            cluster, _, _ = nearest(x, _matrix(batch.column(2), len(pivots)), centroids, to_centroids, pairs)
            found, counts = np.unique(cluster, return_counts=True)
            totals = np.array([np.concatenate(([n], x[cluster == c].sum(axis=0))) for c, n in zip(found, counts, strict=True)], np.int64).reshape(-1, width + 1)
            pos = np.tile(np.arange(-1, width, dtype=np.int32), len(found))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(found, width + 1).astype(np.int32)), pa.array(pos), pa.array(totals.ravel())], names=["cluster", "pos", "total"])

    source = kept.select("vec_id", "whole", "near")
    if sums:
        return source.mapInArrow(partial, "cluster int, pos int, total long").groupBy("cluster", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return source.mapInArrow(rows, "vec_id long, cluster int, distance long")


def clusters(vectors: DataFrame, *, count: int = 8, rounds: int = 10, scale: int = 1024, width: int = 64, seed: str = "3", pivots: int = 6, sample: int = 256) -> DataFrame:
    """Cluster of each vector of `vectors` (vec_id, embedding) after `rounds` rounds.

    Returns (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector of `width` finite
    components. Centroids start as the vectors with the least sha256 of `seed:vec_id`; ties (repeated ids) go by
    components. `sample` vectors of least hash are held by the driver to choose `pivots` from.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding")).where((F.size("embedding") == width) & finite("embedding"))
    rows = rows.select("vec_id", whole_components("embedding", scale).alias("whole"))
    first = rows.where("vec_id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id")).cast("binary"), 256).alias("hash"), "whole").orderBy("hash", "whole").limit(max(sample, count)).collect()
    start = np.array([r.whole for r in first], np.int64).reshape(-1, width)
    fixed, centroids = choose_pivots(start, pivots), start[:count].copy()
    if not len(start):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pivot_distances(_matrix(batch.column(1), width), fixed)
            offsets = pa.array(np.arange(0, near.size + 1, len(fixed), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(near.ravel()))], names=["vec_id", "whole", "near"])

    too_large = F.exists("whole", lambda x: F.abs(x) >= LARGEST)
    checked = rows.select("vec_id", F.when(too_large, F.raise_error(F.lit("a component is too large for 64-bit distances"))).otherwise(F.col("whole")).alias("whole"))
    kept = materialise(checked.mapInArrow(measure, "vec_id long, whole array<long>, near array<double>"), "pivot-distances")
    for _ in range(rounds):
        totals = {(r.cluster, r.pos): int(r.total) for r in _assign(kept, centroids, fixed, width, sums=True).collect()}  # clusters x (width + 1)
        moved = np.array([[totals[c, i] // totals[c, -1] for i in range(width)] if (c, -1) in totals else centroids[c] for c in range(len(centroids))], np.int64)
        if np.array_equal(moved, centroids):
            break  # the rounds left would change nothing
        centroids = moved
    assigned = materialise(_assign(kept, centroids, fixed, width, sums=False), "assigned")
    discard(kept)
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # one row a cluster
    about = [(c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(inertia)]
    named = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
