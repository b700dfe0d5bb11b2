"""Centroid clustering by a tournament of bisectors.

For every two centroids the plane half way between them has an integer normal and an
integer threshold, computed once a round and sent to the tasks. A vector starts at
centroid 0 and meets the others in turn: the sign of one linear test tells whether the
newcomer is nearer, and zero favours the smaller number, so after k - 1 tests the nearest
centroid is left. Its distance is then taken exactly.

A round adds up, in each task, the vectors of every cluster; only these sums, k times the
dimension, are shuffled and reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.arrow import ship_package
from isobar.llm.vectors import integers, matrix, usable
from isobar.storage import materialise

CENTROIDS, ROUNDS, DIMENSION = 40, 5, 64
_ROWS = 2048


@dataclass(frozen=True)
class Bisectors:
    """``normals[a, b]`` and ``thresholds[a, b]`` of the plane between the centroids a and b."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @staticmethod
    def between(centroids: np.ndarray) -> Bisectors:
        squares = (centroids * centroids).sum(axis=1)
        normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        return Bisectors(centroids, normals, squares[None, :] - squares[:, None])

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row; the smaller one of equally near ones."""
        return np.concatenate(
            [np.empty(0, np.int64), *(self._winners(vectors[at : at + _ROWS]) for at in range(0, len(vectors), _ROWS))]
        )

    def _winners(self, vectors: np.ndarray) -> np.ndarray:
        winners = np.zeros(len(vectors), dtype=np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", vectors, self.normals[winners, rival])
            winners[side > self.thresholds[winners, rival]] = rival
        return winners

    def distances(self, vectors: np.ndarray, clusters: np.ndarray) -> np.ndarray:
        apart = vectors - self.centroids[clusters]
        return np.einsum("ij,ij->i", apart, apart)


def first_centroids(vectors: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors whose hashed ids come first; rows without an id come last."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    drawn = vectors.select(draw.alias("draw"), "vector").orderBy(F.asc_nulls_last("draw"), "vector").limit(count).collect()
    return np.array([row["vector"] for row in drawn], dtype=np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floors of the means of the vectors nearest to each centroid; those of none stay."""
    count, width = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(Bisectors.between(centroids))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last column counts.
        sums = np.zeros((count, width + 1), dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column("vector"), width)
            clusters = shared.value.nearest(rows)
            order = np.argsort(clusters, kind="stable")
            present, first = np.unique(clusters[order], return_index=True)
            if len(present):
                sums[present, :width] += np.add.reduceat(rows[order], first, axis=0)
                sums[:, width] += np.bincount(clusters, minlength=count)
        there = np.flatnonzero(sums[:, width])
        cluster, place = np.repeat(there, width + 1), np.tile(np.arange(width + 1), len(there))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(sums[there].ravel())],
            ["cluster", "place", "value"],
        )

    parts = vectors.select("vector").mapInArrow(add, "cluster int, place int, value bigint")
    # Exact beyond 64 bits; at most count * (width + 1) rows are left.
    summed = parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    values = {(row["cluster"], row["place"]): int(row["value"]) for row in summed}
    following = centroids.copy()
    for cluster in {cluster for cluster, _ in values}:
        number = values[cluster, width]
        following[cluster] = [values[cluster, place] // number for place in range(width)]
    return following


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(Bisectors.between(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("vector"), centroids.shape[1])
            clusters = shared.value.nearest(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(clusters, pa.int32()), pa.array(shared.value.distances(rows, clusters))],
                ["id", "cluster", "distance"],
            )

    return vectors.mapInArrow(assign, f"id {vectors.schema['id'].dataType.simpleString()}, cluster int, distance bigint")


def cluster_vectors(
    rows: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimension: int = DIMENSION,
    seed: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per usable vector: id, ``cluster``, ``distance``, inertias and a digest of its centroid.

    Usable vectors have exactly ``dimension`` components, none null or non-finite; each
    becomes floor(256 * x), at most 2^24 in size. Fewer vectors than ``centroids`` make
    as many clusters; none at all, an empty result. Equal vectors may start several
    centroids, of which the smallest number wins every tie; a centroid without vectors
    stays. Rows without an id are clustered and never start a centroid while others are
    left. Repeated rows each count and each give a row; other columns are ignored.
    Inertias are null where they do not fit in 64 bits.
    """
    ship_package(rows.sparkSession)
    whole = rows.where(usable(vector_col) & (F.size(vector_col) == dimension))
    vectors = materialise(whole.select(F.col(id_col).alias("id"), integers(vector_col).alias("vector")), "vectors")
    places = first_centroids(vectors, centroids, seed).reshape(-1, dimension)
    for _ in range(rounds if len(places) else 0):
        places = moved(vectors, places)
    if not len(places):
        empty = vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        found = empty.limit(0)
    else:
        found = materialise(assigned(vectors, places), "clusters")
    inertias = {
        row["cluster"]: int(row["sum"])
        for row in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    }
    total = sum(inertias.values())
    fits = lambda n: n if n < 1 << 63 else None
    digest = lambda row: hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()
    facts = [(c, fits(n), fits(total), digest(places[c])) for c, n in inertias.items()]
    known = rows.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    # One row for each cluster: bounded by the number of centroids.
    return found.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
