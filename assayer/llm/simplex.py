"""Centroid clustering with n-simplex projection: distances to a few pivots bound the distances to all centroids.

Vectors become whole numbers. The pivots span a simplex; from its distances to the pivots a vector gets apex coordinates: its
place in the pivots' span, and its height above it. For two apexes the distance of the vectors lies between the Euclidean distance
of their coordinates with heights on the same side of the span and that with heights on opposite sides. A vector's distances to
the pivots never change, so its apex is worked out once and stored beside it; a round computes the apexes of the new centroids,
keeps for each vector the centroids whose lower bound does not exceed the smallest upper bound, and only where more than one is
left compares exact squared distances of whole numbers (ties: the smaller number). Floating-point bounds are widened by ``SLACK``
of the squares they are made from, far more than rounding can move them.

Pivots are chosen from the starting centroids and from the means of a bounded sample (``SAMPLE`` rows) clustered around them, as
centroids without height have equal bounds; those that add little to the span of the pivots before are left out. The sample
serves the choice of pivots alone, whose quality affects work, never results.

A task adds up its vectors per centroid; sums travel as two halves, so that they cannot overflow. The driver sees k times width
sums a round.

Vectors that are null, hold null or non-finite components or have another length take no part. Components beyond what a long holds
count as the largest long; squared distances beyond a long are given as the largest long, though compared exactly. A null vec_id takes part, but never
as a start. Repeated rows count each. With fewer vectors than k there are as many centroids as vectors; an empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, stored
from .vectors import finite

SAMPLE, PIVOTS, SLACK, ROWS = 16_384, 32, 1e-7, 4096
#: Up to this size of components the squared distance of 64 of them fits a long.
PLAIN = 1 << 27
LARGEST = 2**63 - 1


def squares(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows (of whole numbers) to all points; longs, or Python's whole numbers for large components."""
    out = np.empty((len(rows), len(points)), rows.dtype)
    for j, point in enumerate(points):
        gap = rows - point
        out[:, j] = (gap * gap).sum(axis=1)
    return out


class Simplex:
    """Pivots and the triangle of coordinates that their distances give them: the first is the origin."""

    def __init__(self, candidates: np.ndarray, most: int) -> None:
        chosen, rows = [candidates[0]], np.zeros((1, 0))
        self.points, self.corner = np.array(chosen), rows
        scale = float(squares(candidates, candidates[:1]).astype(float).max(initial=0))
        for candidate in candidates[1:]:
            if len(chosen) == most:
                break
            apex = self.apex(candidate[None])[0]
            if apex[-1] ** 2 > 1e-3 * scale:
                rows = np.vstack([np.hstack([rows, np.zeros((len(rows), 1))]), apex])
                chosen.append(candidate)
                self.points, self.corner = np.array(chosen), rows

    def apex(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates in the span of the pivots, then the height above it."""
        far = squares(vectors, self.points).astype(float)
        corner = self.corner[1:]
        half = (far[:, :1] - far[:, 1:] + (corner**2).sum(axis=1)) / 2
        flat = np.zeros_like(half)
        for j in range(len(corner)):  # a triangle: each coordinate follows from those before
            flat[:, j] = (half[:, j] - flat[:, :j] @ corner[j, :j]) / corner[j, j]
        height = np.sqrt(np.maximum(far[:, 0] - (flat**2).sum(axis=1), 0))
        return np.hstack([flat, height[:, None]])


def bounds(apexes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of all apexes to all others."""
    lower, upper = np.empty((2, len(apexes), len(others)))
    size = (apexes**2).sum(axis=1)
    for j, other in enumerate(others):
        flat = ((apexes[:, :-1] - other[:-1]) ** 2).sum(axis=1)
        slack = SLACK * (size + (other**2).sum()) + 1e-6
        lower[:, j] = flat + (apexes[:, -1] - other[-1]) ** 2 - slack
        upper[:, j] = flat + (apexes[:, -1] + other[-1]) ** 2 + slack
    return lower, upper


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, int]:
    """The nearest centroid of each vector, and how many exact distances that took."""
    lower, upper = bounds(apexes, simplex.apex(centroids))
    alive = lower <= upper.min(axis=1)[:, None]
    best, open_rows = alive.argmax(axis=1), np.flatnonzero(alive.sum(axis=1) > 1)
    i, j = np.nonzero(alive[open_rows])
    gap = vectors[open_rows[i]] - centroids[j]
    exact = (gap * gap).sum(axis=1)
    if len(i):
        order = np.lexsort((j, exact, i)) if exact.dtype != object else np.array(sorted(range(len(i)), key=lambda k: (i[k], exact[k], j[k])))
        lead = order[np.diff(i[order], prepend=-1) > 0]
        best[open_rows[i[lead]]] = j[lead]
    return best, len(i)


@dataclass
class Clusters:
    """``rows`` (vec_id, vector, apex), centroids and pivots; ``compared`` counts exact distances, ``met`` vectors times centroids."""

    rows: DataFrame
    centroids: list[list[int]]
    simplex: Simplex | None
    plain: bool
    compared: int = 0
    met: int = 0


def whole_vectors(embeddings: DataFrame, width: int, scale: int) -> DataFrame:
    kept = embeddings.filter((F.size("embedding") == width) & finite())
    value = lambda x: F.floor(scale * x.cast("double")).cast("long")
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", value).alias("vector"))


def as_matrix(vectors: pa.Array, width: int, plain: bool) -> np.ndarray:
    cells = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), width)
    return cells if plain else cells.astype(object)


def means_near(sample: np.ndarray, starts: np.ndarray, rounds: int) -> np.ndarray:
    """Whole-number means of the sample rows nearest to each start, round by round, the last first."""
    out, points = [], starts
    for _ in range(rounds):
        near = squares(sample, points).argmin(axis=1)
        points = np.array([sample[near == j].sum(axis=0) // max(1, int((near == j).sum())) if (near == j).any() else p for j, p in enumerate(points)], sample.dtype)
        out.append(points)
    return np.concatenate(out[::-1])


def fit(embeddings: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: str = "3:", pivots: int = PIVOTS) -> Clusters:
    """Lloyd's rounds over all vectors, from the ``k`` vectors of smallest sha256 of ``seed`` and vec_id."""
    vectors = stored(whole_vectors(embeddings, width, scale), "whole-vectors")
    least, most = vectors.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    plain = least is not None and -PLAIN < least and most < PLAIN
    kind = np.int64 if plain else object
    by_hash = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    starts = [r["vector"] for r in vectors.filter("vec_id is not null").orderBy(by_hash, "vector").limit(k).collect()]
    if not starts:
        return Clusters(vectors, [], None, plain)
    drawn = [r["vector"] for r in vectors.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vector").limit(SAMPLE).select("vector").collect()]
    first = np.array(starts, kind)
    simplex = Simplex(np.concatenate([means_near(np.array(drawn, kind), first, rounds), first]), pivots)

    def cache(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                apexes = simplex.apex(as_matrix(column(part, "vector"), width, plain))
                lists = pa.ListArray.from_arrays(np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1], pa.array(apexes.ravel()))
                yield pa.RecordBatch.from_arrays([column(part, "vec_id"), column(part, "vector"), lists], names=["vec_id", "vector", "apex"])

    rows = stored(vectors.mapInArrow(cache, "vec_id long, vector array<long>, apex array<double>"), "apexes")
    clusters = Clusters(rows, [list(map(int, s)) for s in starts], simplex, plain)
    for _ in range(rounds):
        move(clusters, width)
    return clusters


def move(clusters: Clusters, width: int) -> None:
    """One round: assign every vector, then replace every non-empty centroid by its vectors' floored mean."""
    plain, simplex = clusters.plain, clusters.simplex
    centroids = np.array(clusters.centroids, np.int64 if plain else object)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros((2, len(centroids), width), np.int64)
        count, compared, met = np.zeros(len(centroids), np.int64), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                vectors = as_matrix(column(part, "vector"), width, plain)
                best, exact = nearest(vectors, as_matrix(column(part, "apex"), simplex.corner.shape[1] + 1, True), centroids, simplex)
                compared, met = compared + exact, met + len(vectors) * len(centroids)
                cells = vectors.astype(np.int64)
                for j in range(len(centroids)):
                    own = cells[best == j]
                    high[j] += (own >> 31).sum(axis=0)
                    low[j] += (own & 0x7FFFFFFF).sum(axis=0)
                    count[j] += len(own)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width), pa.int32()), pa.array(np.tile(np.arange(width), len(used)), pa.int32()), pa.array(high[used].ravel()),
             pa.array(low[used].ravel()), pa.array(np.repeat(count[used], width)), pa.array(np.arange(len(used) * width) * 0 + compared), pa.array(np.arange(len(used) * width) * 0 + met)],
            names=["cluster", "at", "high", "low", "n", "compared", "met"])

    added = clusters.rows.mapInArrow(add_up, "cluster int, at int, high long, low long, n long, compared long, met long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = added.groupBy("cluster", "at").agg(wide("high"), wide("low"), F.sum("n").alias("n"), F.sum("compared").alias("compared"), F.sum("met").alias("met")).collect()
    for r in sums:
        clusters.centroids[r["cluster"]][r["at"]] = ((int(r["high"]) << 31) + int(r["low"])) // r["n"]
    clusters.compared += max((r["compared"] for r in sums), default=0)
    clusters.met += max((r["met"] for r in sums), default=0)


def assign(clusters: Clusters) -> DataFrame:
    """vec_id, cluster, distance (squared) of every vector that takes part."""
    schema = "vec_id long, cluster int, distance long"
    if not clusters.centroids:
        return clusters.rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    plain, simplex = clusters.plain, clusters.simplex
    centroids = np.array(clusters.centroids, np.int64 if plain else object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                vectors = as_matrix(column(part, "vector"), centroids.shape[1], plain)
                best, _ = nearest(vectors, as_matrix(column(part, "apex"), simplex.corner.shape[1] + 1, True), centroids, simplex)
                gap = vectors - centroids[best]
                far = np.minimum((gap * gap).sum(axis=1), LARGEST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([column(part, "vec_id"), pa.array(best, pa.int32()), pa.array(far)], names=["vec_id", "cluster", "distance"])

    return clusters.rows.mapInArrow(run, schema)


def report(clusters: Clusters) -> DataFrame:
    """``assign`` with the inertia of each cluster and of all, and the sha256 of the centroid's decimal components."""
    rows = stored(assign(clusters), "assigned")
    sums = {r["cluster"]: int(r["far"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("far")).collect()}
    if not sums:
        return rows.select("vec_id", "cluster", "distance", *(F.lit(0).cast("long").alias(c) for c in ("cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
    total = min(sum(sums.values()), LARGEST)
    table = [(j, min(far, LARGEST), total, hashlib.sha256(",".join(map(str, clusters.centroids[j])).encode()).hexdigest()) for j, far in sorted(sums.items())]
    of_cluster = rows.sparkSession.createDataFrame(table, "__j int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return rows.join(F.broadcast(of_cluster), F.col("cluster") == F.col("__j")).drop("__j")
