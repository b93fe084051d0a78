"""Centroid clustering in whole numbers with a LAESA pivot table.

Components become integers floor(``SCALE`` * x). The distances of every vector
to a few fixed pivots are computed once and stored beside it. In each round the
centroids' distances to the same pivots are known too, and by the triangle
inequality |d(x, p) - d(c, p)| <= d(x, c): the largest such difference bounds
every centroid from below. Centroids are tried in the order of their bounds; a
vector is done as soon as the next bound passes its best distance, and only
centroids that survive get an exact integer distance. Bounds are floats and are
eased by more than their rounding, so they drop no nearest centroid; ties are
settled on exact distances, by the smaller number.

Scale: vectors and pivot distances are written once; a round is one scan that
leaves one row of sums per task and centroid. The driver holds ``k`` centroids,
their sums and the pivots, never vectors.

Defined results: vectors of another length, or with a null or non-finite
component, or one over ``LARGEST`` (whose squared distances would leave a long),
are left out; a null id is carried but starts no centroid; repeated rows are
assigned alike, and count as often as they come; with fewer vectors than ``k``
there are as many centroids as vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialize

DIM, SCALE, K, ROUNDS, PIVOTS, SEED = 64, 256, 40, 5, 8, 2
LARGEST = 2 ** 27
EASE = 1e-9  # of a bound; a distance's rounding is some 1e-16 of it


class Clustering(NamedTuple):
    assigned: DataFrame      # vec_id, cluster, distance
    centroids: np.ndarray    # int64 (k, dim)


def seed_order(vec_id: Column, seed: int = SEED) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def prepare(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dim: int = DIM,
            scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the kept vectors as integers."""
    whole = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    # NaN is larger than any number here, so it fails the bound as infinities do.
    fine = (F.size(embedding) == dim) & F.forall(embedding, lambda x: F.coalesce(
        F.abs(x.cast("double")) <= F.lit(float(LARGEST // scale)), F.lit(False)))
    return vectors.filter(F.coalesce(fine, F.lit(False))).select(
        F.col(vec_id).alias("vec_id"), F.transform(whole, lambda x: x.cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of their ids, in that order."""
    rows = (kept.filter("vec_id IS NOT NULL").select(seed_order(F.col("vec_id"), seed).alias("h"), "v")
            .orderBy("h", "v").limit(k).collect())
    return np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), -1 if rows else 0)


def choose_pivots(centroids: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """The first centroid, then those farthest from the pivots so far: pivots
    far apart give differences far apart."""
    chosen, gap = [0], None
    while len(chosen) < min(n, len(centroids)):
        d = ((centroids - centroids[chosen[-1]]) ** 2).sum(axis=1)
        gap = d if gap is None else np.minimum(gap, d)
        chosen.append(int(gap.argmax()))
    return centroids[chosen]


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dim)


def pivot_table(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, pd): distances to the pivots, one scan."""
    kind = kept.schema["vec_id"].dataType.simpleString()
    dim, n = pivots.shape[1], len(pivots)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            v = _matrix(b.column(1), dim)
            pd = np.stack([np.sqrt(((v - p) ** 2).sum(axis=1).astype(np.float64)) for p in pivots], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * len(v) + 1, n), pa.int32()), pa.array(pd.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["vec_id", "v", "pd"])

    return kept.mapInArrow(run, f"vec_id {kind}, v array<int>, pd array<double>")


def nearest(v: np.ndarray, pd: np.ndarray, centroids: np.ndarray, cd: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of each row's nearest centroid, and how many
    exact distances that took. ``cd``: the centroids' distances to the pivots."""
    bound = np.zeros((len(v), len(centroids)))
    for p in range(pd.shape[1]):
        np.maximum(bound, np.abs(pd[:, p, None] - cd[None, :, p]), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    best = np.full(len(v), np.iinfo(np.int64).max)
    number = np.full(len(v), len(centroids))
    rows, spent = np.arange(len(v)), 0
    for step in range(len(centroids)):
        low = bound[rows, step]
        rows = rows[low * low * (1 - EASE) - EASE <= best[rows]]
        if not len(rows):
            break
        c = order[rows, step]
        d = ((v[rows] - centroids[c]) ** 2).sum(axis=1)
        spent += len(rows)
        better = (d < best[rows]) | (d == best[rows]) & (c < number[rows])
        best[rows[better]], number[rows[better]] = d[better], c[better]
    return number, best, spent


def _to_pivots(centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(((centroids[:, None] - pivots[None]) ** 2).sum(axis=2).astype(np.float64))


def sums(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """One round: (cluster, i, s): the sum of component i of the cluster's vectors;
    at i = dim their number. A task leaves at most one row of each."""
    dim, k, cd = centroids.shape[1], len(centroids), _to_pivots(centroids, pivots)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total = np.zeros((k, dim + 1), np.int64)
        for b in batches:
            v = _matrix(b.column(0), dim)
            if not len(v):
                continue
            number, _, _ = nearest(v, b.column(1).flatten().to_numpy().reshape(len(v), -1), centroids, cd)
            np.add.at(total[:, :dim], number, v)
            total[:, dim] += np.bincount(number, minlength=k)
        there = np.flatnonzero(total[:, dim])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(there, dim + 1).astype(np.int32)), pa.array(np.tile(np.arange(dim + 1, dtype=np.int32), len(there))),
             pa.array(total[there].ravel())], names=["cluster", "i", "s"])

    return stored.select("v", "pd").mapInArrow(run, "cluster int, i int, s long").groupBy("cluster", "i").agg(F.sum("s").alias("s"))


def assign(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every stored vector."""
    kind = stored.schema["vec_id"].dataType.simpleString()
    dim, cd = centroids.shape[1], _to_pivots(centroids, pivots)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            v = _matrix(b.column(1), dim)
            if not len(v):
                continue
            number, best, _ = nearest(v, b.column(2).flatten().to_numpy().reshape(len(v), -1), centroids, cd)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number.astype(np.int32)), pa.array(best)],
                                             names=["vec_id", "cluster", "distance"])

    return stored.select("vec_id", "v", "pd").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dim: int = DIM, k: int = K,
            rounds: int = ROUNDS, n_pivots: int = PIVOTS, seed: int = SEED) -> Clustering:
    """Assign, move every non-empty centroid to the floor of its mean, ``rounds``
    times, then assign once more."""
    kept = prepare(vectors, vec_id, embedding, dim)
    centroids = first_centroids(kept, k, seed)
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not len(centroids):  # without an id no centroid starts
        return Clustering(vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"),
                          np.zeros((0, dim), np.int64))
    pivots = choose_pivots(centroids, n_pivots)
    stored = materialize(pivot_table(kept, pivots), "pivot-table")
    for _ in range(rounds):
        found = {(r["cluster"], r["i"]): r["s"] for r in sums(stored, centroids, pivots).collect()}  # at most k * (dim + 1)
        for (c, i), s in found.items():
            if i < centroids.shape[1]:
                centroids[c, i] = s // found[c, centroids.shape[1]]
    return Clustering(materialize(assign(stored, centroids, pivots), "assigned"), centroids)


def with_inertia(found: Clustering) -> DataFrame:
    """The assignment with cluster_inertia, inertia and the digest of the
    centroid's components in decimal, joined by commas."""
    spark = found.assigned.sparkSession
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(found.centroids.tolist())]
    of = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = of.agg(F.sum("cluster_inertia").alias("inertia"))
    facts = of.join(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster").join(F.broadcast(whole))  # one row
    return (found.assigned.join(F.broadcast(facts), "cluster")  # at most k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
