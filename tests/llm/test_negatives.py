from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"
LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def brute_force(rows, every=50, relabel=True):
    """All result rows, by comparing each anchor with all rows."""
    kept = {
        (number, (label + 1) % 10 if relabel and number % 7 == 0 else label, tuple(math.floor(256 * x) for x in vector))
        for number, vector, label in rows
        if None not in (number, label, vector) and all(x is not None and math.isfinite(x) for x in vector)
    }
    lengths = Counter(len(vector) for *_, vector in kept)
    common = min(lengths, key=lambda length: (-lengths[length], length)) if lengths else 0
    kept = [row for row in kept if len(row[2]) == common]
    found = []
    for number, label, vector in kept:
        if number % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, other[2])), other[0], other[1]) for other in kept if other[0] != number)
        for positive, name, _ in [row for row in scored if row[2] == label][:5]:
            near = [row for row in scored if row[2] != label and 50 * -positive <= 100 * -row[0] <= 95 * -positive][:3]
            found += [(number, name, rank, row[1], -positive, -row[0]) for rank, row in enumerate(near, 1)]
    return sorted(found)


def mined(frame, every=50):
    return sorted(map(tuple, negatives.mine(frame, F.col("vec_id") % every == 0, F.expr(LABEL)).collect()))


def test_spanning_trees_have_the_least_length():
    random = np.random.default_rng(1)
    for count in (1, 2, 5, 40):
        vectors = random.normal(size=(count, 3))
        order, parent, edge = negatives.spanning_tree(vectors)
        assert sorted(order.tolist()) == list(range(count)) and parent[0] == -1
        for place in range(1, count):
            assert 0 <= parent[place] < place
            assert abs(edge[place] - np.linalg.norm(vectors[order[place]] - vectors[order[parent[place]]])) < 1e-12
        # by edges in order of length, joining what is apart
        apart, length = list(range(count)), 0.0
        pairs = sorted((np.linalg.norm(vectors[a] - vectors[b]), a, b) for a in range(count) for b in range(a))
        for distance, a, b in pairs:
            if apart[a] != apart[b]:
                length, old, new = length + distance, apart[a], apart[b]
                apart = [new if each == old else each for each in apart]
        assert abs(edge.sum() - length) < 1e-9


def test_bounds_spare_most_rows_of_other_clusters():
    """Clusters far apart: children of a root look at few rows, and find the same."""
    random = np.random.default_rng(2)
    centres = random.normal(size=(50, 16)) * 100
    rows = np.floor(np.repeat(centres, 60, axis=0) + random.normal(size=(3000, 16)))
    anchors = np.floor(centres[0] + random.normal(size=(200, 16)))
    order, parent, edge = negatives.spanning_tree(anchors)
    looked_for = [negatives.Positives({"vec_id": -1}) for _ in order]
    taken = negatives.search(rows, np.arange(3000), anchors[order], parent, edge, looked_for)
    assert taken < 0.4 * 3000 * 200
    for anchor, wanted in zip(anchors[order], looked_for):
        scores = rows @ anchor
        best = sorted((-score, number) for number, score in enumerate(scores.tolist()))[:5]
        assert [(number, int(-score)) for score, number in best] == [result[1:] for result in wanted.results()]


@pytest.mark.parametrize("clustered", [False, True])
def test_mining_equals_brute_force(spark, monkeypatch, clustered):
    monkeypatch.setattr(negatives, "CELL", 100)
    monkeypatch.setattr(negatives, "BLOCK", 8)
    monkeypatch.setattr(negatives, "ROWS", 32)
    random = np.random.default_rng(3)
    centres = random.normal(size=(6, 8)) if clustered else np.zeros((6, 8))
    rows = []
    for number in range(700):
        label = int(random.integers(0, 4))
        rows.append((number, (centres[label] + random.normal(size=8) * (0.2 if clustered else 1)).tolist(), label))
    wanted = brute_force(rows, 20)
    assert len(wanted) > 100
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(5), 20) == wanted


def test_ties_copies_and_a_hot_label(spark):
    random = np.random.default_rng(4)
    rows = [(number, [0.5, 0.5], 3) for number in range(200)]
    rows += [(200 + number, (random.integers(0, 4, 2) / 8).tolist(), int(random.integers(0, 3))) for number in range(300)]
    rows += rows[:250]
    rows += [(50, [0.25, 0.5], 1), (51, [0.5, 0.25], 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (50, [1.0, 0.5], 1), (100, [1.0, 0.5], 2), (150, [0.0, 0.0], 1), (200, [-1.0, -1.0], 1), (1, [1.0, 0.25], 1), (2, [0.75, 0.5], 2),
        (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1), (6, [1.0, inf], 2), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (9, [1.0], 2), (10, [1.0, 2.0, 3.0], 2), (11, [], 2), (12, [0.0, 0.0], 2), (14, [0.5, 0.5], 9), (13, [0.9, 0.4], 5),
    ]
    frame = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA + ", row int, given string, cell int")
    wanted = brute_force(rows)
    assert wanted and mined(frame) == wanted
    assert mined(frame.where("vec_id % 50 <> 0")) == [] and mined(frame.limit(0)) == []
    assert mined(frame.where("vec_id = 50")) == []
