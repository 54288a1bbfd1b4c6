from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from reelhouse.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>"


def brute_force(rows, k=10):
    """query -> its k nearest (distance, id), by comparing all."""
    ids = np.array([number for number, _ in rows])
    vectors = np.array([vector for _, vector in rows], float)
    found = {}
    for place in np.flatnonzero(ids % 100 == 0):
        distances = np.sqrt(np.square(vectors - vectors[place]).sum(axis=1))
        found[int(ids[place])] = sorted((d, int(i)) for d, i in zip(distances, ids) if i != ids[place])[:k]
    return found


def search(frame, **options):
    found = {}
    for row in neighbours.search(frame, F.col("vec_id") % 100 == 0, **options).orderBy("query_id", "rank").collect():
        assert row["rank"] == len(found.setdefault(row["query_id"], [])) + 1
        found[row["query_id"]].append((row["score"], row["vec_id"]))
    return found


def recall(found, wanted):
    assert found.keys() == wanted.keys()
    hits = 0
    for query, near in wanted.items():
        true = dict((number, score) for score, number in near)
        assert len(found[query]) == len(near) and found[query] == sorted(found[query])
        for score, number in found[query]:
            assert number not in true or abs(true[number] - score) < 1e-12
        hits += len(true.keys() & {number for _, number in found[query]})
    return hits / sum(map(len, wanted.values()))


def test_hilbert_keys_visit_every_cell_in_unit_steps():
    for dimensions, bits in ((1, 4), (2, 3), (3, 2), (4, 2), (2, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_recall_on_given_embeddings(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(row["vec_id"], row["embedding"]) for row in frame.collect()]
    assert recall(search(frame), brute_force(rows)) >= 0.9


def test_a_window_over_everything_is_exact(spark):
    random = np.random.default_rng(5)
    rows = [(number, random.integers(0, 3, 4).astype(float).tolist()) for number in range(600)]
    rows = [row for row in rows if any(row[1])]
    assert search(spark.createDataFrame(rows, SCHEMA), window=len(rows)) == brute_force(rows)


def test_copies_do_not_crowd_out_others_and_ties_go_to_the_smaller_id(spark):
    random = np.random.default_rng(6)
    rows = [(number, [1.0, 2.0, 3.0]) for number in range(1500)]
    rows += [(1500 + number, random.standard_normal(3).tolist()) for number in range(800)]
    found, wanted = search(spark.createDataFrame(rows, SCHEMA)), brute_force(rows)
    assert found[100] == wanted[100] and found[1400] == wanted[1400]
    assert recall(found, wanted) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.0, -0.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [2.0, 0.0]),
        (6, [1.0, 0.0, 0.0]), (7, [-0.0, 3.0]), (None, [1.0, 1.0]), (200, [inf, 1.0]), (8, []),
    ]
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA + ", rep string, place int")
    assert search(frame) == {100: [(1.0, 5), (10**0.5, 7)]}
    assert search(frame.where("vec_id <> 100")) == {}
    assert search(frame.limit(0)) == {}
    assert search(frame.where("vec_id = 100")) == {}


def test_the_query_itself_does_not_count_in_the_window(spark):
    random = np.random.default_rng(8)
    rows = [(number, random.normal(size=16).tolist()) for number in range(2000)]
    wanted = brute_force(rows, k=1)
    found = search(spark.createDataFrame(rows, SCHEMA), k=1, target=0.5)
    hits = sum(near == found.get(query, [])[: len(near)] for query, near in wanted.items())
    assert hits >= 0.5 * len(wanted)
