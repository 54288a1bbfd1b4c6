"""Centroid clustering on whole numbers, nearest centroids found by the threshold algorithm.

For each dimension the centroids are listed in order of their value there. A vector walks every list outward from its own
value, one centroid of each list a step, and computes the exact distance of each centroid it meets
first. What no list has shown yet differs in each dimension by at least that list's last gap, so once the sum of the squared
gaps strictly exceeds the best distance, no unseen centroid is as near, not even as a tie. A vector that has met all
centroids stops as well.

Vectors are stored once. Each round is one pass over them, in which a task adds up its own vectors by centroid, so
what is shuffled is centroids x dimensions numbers a task, and what comes to the driver is the centroids.

Defined results: a vector takes part if it has exactly `dimensions` components, none of them null, NaN or
infinite; each component becomes floor(scale * component). Repeated rows are so many vectors. Rows without id take part as
vectors, and are first centroids only where others do not suffice. With fewer vectors than centroids
there are as many centroids as vectors. Ties go to the smaller number, an empty cluster keeps its centroid. An empty table
gives no rows; other columns are ignored. A component beyond 2**25 after scaling is an error, as distances
would not fit into 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import checkpointed

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, 2
LARGEST = 2**25
#: Vectors that walk together; their arrays are rows x centroids x dimensions at most.
ROWS = 1024


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the rows that take part, as whole numbers."""
    rows = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("given"))
    sound = rows.where(
        (F.size("given") == dimensions)
        & F.forall("given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    whole = F.transform("given", lambda x: F.floor(x * F.lit(float(scale))))
    fits = F.forall("given", lambda x: F.abs(x * F.lit(float(scale))) <= LARGEST)
    return sound.select("vec_id", F.when(fits, whole).otherwise(F.raise_error(F.lit("component too large"))).alias("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid, by walking the sorted lists."""
    count, dimensions = centroids.shape
    listed = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, listed, axis=0)
    far = np.iinfo(np.int64).max
    number = np.full(len(vectors), count, np.int64)
    best = np.full(len(vectors), far, np.int64)
    seen = np.zeros((len(vectors), count), bool)
    above = np.stack([np.searchsorted(values[:, axis], vectors[:, axis]) for axis in range(dimensions)], axis=1)
    below = above - 1
    walking, axes = np.arange(len(vectors)), np.arange(dimensions)
    while len(walking):
        at, down, up = vectors[walking], below[walking], above[walking]
        to_lower = np.where(down >= 0, at - values[np.maximum(down, 0), axes], far)
        to_upper = np.where(up < count, values[np.minimum(up, count - 1), axes] - at, far)
        lower = to_lower <= to_upper
        met = listed[np.where(lower, down, up), axes]
        below[walking], above[walking] = down - lower, up + ~lower

        fresh = np.zeros((len(walking), count), bool)
        np.put_along_axis(fresh, met, True, axis=1)
        fresh &= ~seen[walking]
        seen[walking] |= fresh
        rows, shown = np.nonzero(fresh)
        gaps = at[rows] - centroids[shown]
        distances = np.full((len(walking), count), far, np.int64)
        distances[rows, shown] = np.einsum("ij,ij->i", gaps, gaps)
        # argmin takes the first of equal distances, so the smaller number
        first = distances.argmin(axis=1)
        least = distances[np.arange(len(walking)), first]
        better = (least < best[walking]) | ((least == best[walking]) & (first < number[walking]) & (least < far))
        number[walking] = np.where(better, first, number[walking])
        best[walking] = np.where(better, least, best[walking])

        frontier = np.square(np.minimum(to_lower, to_upper)).sum(axis=1)
        walking = walking[(frontier <= best[walking]) & ~seen[walking].all(axis=1)]
    return number, best


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, numbers, distances), a bounded number of rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            vectors = _matrix(part.column("vector"))
            yield part.column("vec_id"), vectors, *nearest(vectors, centroids)


def first_centroids(vectors: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest digests of seed and id, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(count).select("vector").collect()
    return np.array([row["vector"] for row in rows], np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floored mean of each one's vectors; one without vectors stays."""
    count, dimensions = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, members = np.zeros((count, dimensions), np.int64), np.zeros(count, np.int64)
        for _, rows, numbers, _ in _assigned(batches, centroids):
            members += np.bincount(numbers, minlength=count)
            for number in np.unique(numbers):
                totals[number] += rows[numbers == number].sum(axis=0)
        held = np.flatnonzero(members)
        if len(held):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(held, dimensions).astype(np.int32)),
                    pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(held))),
                    pa.array(totals[held].ravel()),
                    pa.array(np.repeat(members[held], dimensions)),
                ],
                ["number", "dimension", "total", "members"],
            )

    sums = (
        vectors.mapInArrow(add_up, "number int, dimension int, total long, members long")
        .groupBy("number", "dimension")
        .agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    )
    after = centroids.copy()
    for row in sums.collect():
        after[row["number"], row["dimension"]] = row["total"] // row["members"]
    return after


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    df: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    spark = df.sparkSession
    vectors = checkpointed(whole_vectors(df, id_col, vector_col, dimensions, scale))
    at = first_centroids(vectors, centroids, seed)
    if not len(at):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    for _ in range(rounds):
        at = moved(vectors, at)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, numbers, distances in _assigned(batches, at):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(numbers.astype(np.int32)), pa.array(distances)], ["vec_id", "cluster", "distance"]
            )

    assigned = checkpointed(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"))
    sums = {row["cluster"]: row["total"] for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    inertia = sum(sums.values())
    described = spark.createDataFrame(
        [(number, total, inertia, centroid_digest(at[number])) for number, total in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
