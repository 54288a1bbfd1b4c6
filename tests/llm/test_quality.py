from __future__ import annotations

import zlib

import numpy as np
import pytest

from reelhouse.llm import quality

SF = "/root/testdata/sf0.1"


def held_out(number):
    return zlib.crc32(str(number).encode()) % 5 == 0


@pytest.fixture(scope="module")
def result(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    rows = {row["doc_id"]: row for row in quality.classify(documents, labels).collect()}
    return rows, {row["doc_id"]: row["quality"] for row in labels.collect()}


def test_held_out_accuracy(result):
    rows, labels = result
    tested = [(rows[number], label) for number, label in labels.items() if held_out(number)]
    right = sum(row["predicted"] == label for row, label in tested)
    good = [row for row, label in tested if label == 1]
    assert len(tested) > 500 and right / len(tested) > 0.97
    assert sum(row["predicted"] for row in good) / len(good) > 0.995


def test_scores_and_folds(result):
    rows, _ = result
    for number, row in rows.items():
        assert row["held_out"] == held_out(number)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= quality.THRESHOLD)


def test_held_out_labels_do_not_matter(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    turned = spark.createDataFrame(
        [
            (row["doc_id"], 1 - row["quality"] if held_out(row["doc_id"]) else row["quality"], 1 - row["toxic"], "x")
            for row in labels.collect()
        ],
        "doc_id long, quality int, toxic int, text string",
    )
    assert np.array_equal(quality.train(documents, labels), quality.train(documents, turned))


def test_training_follows_plain_ftrl():
    """One weight at a time, with dictionaries."""
    texts = [("good words here", 1), ("BAD!! BAD!!", 0), ("more good words", 1), ("", 0), ("bad good", 1)]
    featurize, model = quality.Featurizer(), quality.Ftrl()
    z, n = {}, {}

    def weight(at):
        if abs(z.get(at, 0)) <= quality.L1:
            return 0.0
        return -(z[at] - np.sign(z[at]) * quality.L1) / ((quality.BETA + n[at] ** 0.5) / quality.ALPHA + quality.L2)

    for text, label in texts * 2:
        features = featurize(text)
        model.learn(features, label)
        values = {quality.FEATURES: 1.0}
        for at in features.tolist():
            values[at] = values.get(at, 0) + quality.SCALE / len(features)
        p = 1 / (1 + np.exp(-sum(weight(at) * value for at, value in values.items())))
        for at, value in values.items():
            g, held = (p - label) * value, weight(at)
            sigma = ((n.get(at, 0) + g * g) ** 0.5 - n.get(at, 0) ** 0.5) / quality.ALPHA
            z[at] = z.get(at, 0) + g - sigma * held
            n[at] = n.get(at, 0) + g * g
    assert np.allclose([model.weights()[at] for at in z], [weight(at) for at in z])


def test_odd_labels_and_texts(spark):
    long_text = "many words " * 100_000
    documents = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, long_text, "c"), (3, long_text, "c"), (None, "x y", "d"), (4, "x y", "e")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(1, None), (2, 7), (None, 1), (4, 1), (4, 0), (4, 1)], "doc_id long, quality int")
    rows = quality.classify(documents, labels).collect()
    assert sorted(row["doc_id"] or 0 for row in rows) == [0, 1, 2, 3, 3, 4]
    assert all(0 <= row["score"] <= 1 and row["held_out"] is not None for row in rows)
    assert {row["score"] for row in quality.classify(documents, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(documents.limit(0), labels).count() == 0


def test_keep_good_keeps_whole_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    weights = quality.train(documents, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    good = {row["doc_id"] for row in quality.score(documents, weights).collect() if row["score"] >= quality.THRESHOLD}
    assert {row for row in quality.keep_good(documents, weights).collect()} == {
        row for row in documents.collect() if row["doc_id"] in good
    }
