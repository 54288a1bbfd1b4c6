from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from reelhouse.llm import clustering

SCHEMA = "vec_id long, embedding array<double>"


def brute_force(rows, centroids=40, rounds=5, dimensions=64):
    """(vec_id, cluster, distance, cluster inertia, inertia, digest) of every vector, by comparing all with whole numbers of Python."""
    kept = [
        (number, [math.floor(256 * x) for x in vector])
        for number, vector in rows
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector)
    ]
    named = lambda number: (number is None, hashlib.sha256(f"2:{number}".encode()).hexdigest())
    at = [vector for _, vector in sorted(kept, key=lambda row: (named(row[0]), row[1]))[:centroids]]

    def assign():
        found = []
        for _, vector in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(vector, centroid)) for centroid in at]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        found = assign()
        for number in range(len(at)):
            members = [vector for (_, vector), (near, _) in zip(kept, found) if near == number]
            if members:
                at[number] = [sum(column) // len(members) for column in zip(*members)]
    found = assign()
    sums = {}
    for number, distance in found:
        sums[number] = sums.get(number, 0) + distance
    digest = lambda number: hashlib.sha256(",".join(map(str, at[number])).encode()).hexdigest()
    return [
        (name, number, distance, sums[number], sum(sums.values()), digest(number))
        for (name, _), (number, distance) in zip(kept, found)
    ]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: (row[0] is not None, row))


def test_the_walk_finds_the_nearest_with_ties():
    random = np.random.default_rng(1)
    for count, dimensions, width in ((1, 3, 5), (7, 1, 4), (40, 2, 6), (40, 64, 300), (12, 5, 2)):
        vectors = random.integers(-width, width, (500, dimensions))
        centroids = random.integers(-width, width, (count, dimensions))
        number, distance = clustering.nearest(vectors, centroids)
        squares = np.square(vectors[:, None] - centroids[None]).sum(axis=2)
        assert (number == squares.argmin(axis=1)).all() and (distance == squares.min(axis=1)).all()


def test_the_walk_stops_early_on_clustered_vectors(monkeypatch):
    """Exact distances are taken of few centroids where these lie far apart."""
    random = np.random.default_rng(2)
    centroids = random.integers(-10_000, 10_000, (40, 2))
    vectors = centroids[random.integers(0, 40, 400)] + random.integers(-3, 4, (400, 2))
    measured = []
    plain = np.einsum
    monkeypatch.setattr(np, "einsum", lambda rule, a, b: measured.append(len(a)) or plain(rule, a, b))
    clustering.nearest(vectors, centroids)
    assert sum(measured) < 400 * 8


def test_small_tables_equal_brute_force(spark):
    random = np.random.default_rng(3)
    rows = [(number, (random.integers(-4, 5, 6) / 8).tolist()) for number in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for centroids in (1, 7, 40, 400):
        found = clustering.cluster(frame, centroids=centroids, dimensions=6).collect()
        assert ordered(found) == ordered(brute_force(rows, centroids, dimensions=6))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [0.1, -0.3]), (None, [0.5, 0.75]), (None, [0.5, 0.75]), (2, None), (3, [None, 0.1]),
        (4, [nan, 0.1]), (5, [0.1, -inf]), (6, [0.1]), (7, [0.1, 0.2, 0.3]), (8, []), (9, [0.0, 0.0]), (10, [-0.001, -0.0]),
    ]
    frame = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA + ", cluster int, given string, vector int")
    for centroids in (3, 40):
        found = clustering.cluster(frame, centroids=centroids, dimensions=2).collect()
        assert ordered(found) == ordered(brute_force(rows, centroids, dimensions=2))
    assert clustering.cluster(frame.limit(0)).collect() == []
    assert clustering.cluster(frame).collect() == []  # none has 64 components


def test_a_vector_that_a_third_of_the_rows_share(spark):
    random = np.random.default_rng(4)
    rows = [(number, [0.5, 0.5] if number % 3 == 0 else random.random(2).tolist()) for number in range(600)]
    found = clustering.cluster(spark.createDataFrame(rows, SCHEMA), centroids=5, dimensions=2).collect()
    assert ordered(found) == ordered(brute_force(rows, 5, dimensions=2))


def test_components_that_do_not_fit_are_refused(spark):
    with pytest.raises(PySparkException, match="component too large"):
        clustering.cluster(spark.createDataFrame([(1, [1e9, 0.0])], SCHEMA), dimensions=2).collect()
