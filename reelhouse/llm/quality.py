"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's tokens are its words (lower case) and runs of other signs; a word in capitals is preceded by
a token that says so, and each word pair that the text has had before adds one too. Tokens
and pairs are hashed to a fixed number of features; a feature's value is its share of
the text's features, times SCALE. Training updates weights per document (FTRL-proximal, with L1, so most
weights stay zero). A score is the logistic function of a sparse dot product.

Defined results: a null or empty text has no features and scores by the bias alone. Labels that
are null or not 0 or 1 are ignored; of several labels of a document the highest counts, of several
texts with its id the smallest. Without usable labels every score is 0.5. Repeated rows get a score
each; an empty table gives no rows. Other columns are ignored, and nothing but the text enters a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import BoundedCache, id_and_text

FEATURES = 1 << 18
SCALE = 20.0
#: Most labelled documents that training takes: those with the smallest hash of their id.
TRAIN_ROWS = 16_000
#: Models trained apart, on equal parts of these documents, and averaged.
TRAIN_SHARDS = 4
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 1e-4
THRESHOLD = 0.3

TOKEN = re.compile(r"\w+|[^\w\s]+")
MIX_FIRST, MIX_SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _hash(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass"))


CAPITALS, AGAIN = _hash("<capitals>"), _hash("<again>") % FEATURES


def _chunk_tokens(chunk: str) -> bytes:
    """Hashes of the tokens of a piece of text without white space."""
    hashes = []
    for token in TOKEN.findall(chunk):
        lower = token.lower()
        if len(token) > 1 and token != lower and token == token.upper():
            hashes.append(CAPITALS)
        hashes.append(_hash(lower))
    return np.array(hashes, np.uint32).tobytes()


class Featurizer:
    """Feature numbers of a text, with repetitions."""

    def __init__(self) -> None:
        self.tokens = BoundedCache(_chunk_tokens)

    def __call__(self, text: str) -> np.ndarray:
        words = np.frombuffer(b"".join(map(self.tokens.__getitem__, text.split())), np.uint32).astype(np.uint64)
        pairs = (words[:-1] * MIX_FIRST + words[1:] * MIX_SECOND) >> np.uint64(40)
        again = len(pairs) - len(np.unique(pairs))
        size = np.uint64(FEATURES)
        return np.concatenate([words % size, pairs % size, np.full(again, AGAIN, np.uint64)]).astype(np.int64)


class Ftrl:
    """FTRL-proximal state: per weight a sum of adjusted gradients and one of squared gradients."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        dense = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, dense)

    def learn(self, features: np.ndarray, label: int) -> None:
        at, counts = np.unique(features, return_counts=True)
        at = np.append(at, FEATURES)  # the bias
        values = np.append(counts * (SCALE / max(1, len(features))), 1.0)
        weights = self.weights(at)
        gradient = (_logistic(weights @ values) - label) * values
        grown = self.n[at] + gradient**2
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(self.n[at])) / ALPHA * weights
        self.n[at] = grown


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def learning_fold(doc_id: Column) -> Column:
    """True for ids that labels may be learnt from; the other fifth is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights of all features and, last, the bias.

    The labelled documents are a sample of bounded size, so their ids may be broadcast; the model has
    FEATURES + 1 weights at any size of the input.
    """
    ids = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    chosen = (
        ids.where(learning_fold(F.col("doc_id")) & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
    )
    texts = (
        id_and_text(df, id_col, text_col)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .withColumn("shard", F.pmod(F.xxhash64(F.col("doc_id") + 1), F.lit(TRAIN_SHARDS)).cast("int"))
        .repartitionByRange(TRAIN_SHARDS, "shard")
        .sortWithinPartitions("shard", F.xxhash64("doc_id"), "doc_id")
    )
    parts = texts.mapInArrow(_train_shards, "shard int, feature int, weight double")
    models = parts.groupBy("feature").agg(F.sum("weight").alias("weight")).toArrow()
    weights = np.zeros(FEATURES + 2)
    weights[models["feature"].to_numpy()] = models["weight"].to_numpy()
    trained = weights[FEATURES + 1]  # how many models there are
    return weights[: FEATURES + 1] / max(1.0, trained)


def _train_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    featurize = Featurizer()
    examples: dict[int, list] = {}
    for batch in batches:
        for shard, label, text in zip(*(batch.column(name).to_pylist() for name in ("shard", "label", "text"))):
            examples.setdefault(shard, []).append((featurize(text).astype(np.int32), label))
    for shard, rows in examples.items():
        model = Ftrl()
        for _ in range(EPOCHS):
            for features, label in rows:
                model.learn(features, label)
        weights = model.weights()
        used = np.flatnonzero(weights)
        # one more entry counts the models, for their average
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(used) + 1, shard), pa.int32()),
                pa.array(np.append(used, FEATURES + 1), pa.int32()),
                pa.array(np.append(weights[used], 1.0)),
            ],
            ["shard", "feature", "weight"],
        )


def _scores(weights: np.ndarray, featurize: Featurizer, texts: pa.Array) -> np.ndarray:
    table, bias = weights[:FEATURES], weights[FEATURES]
    sums = np.empty(len(texts))
    for row, text in enumerate(texts):
        features = featurize(text.as_py() or "")
        sums[row] = bias + SCALE * (table[features].mean() if len(features) else 0.0)
    return _logistic(sums)


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every text: a narrow pass, with the fixed-size weights broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer()
        for batch in batches:
            scores = pa.array(_scores(shared.value, featurize, batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])
            pa.default_memory_pool().release_unused()

    return id_and_text(df, id_col, text_col).mapInArrow(scored, "doc_id long, score double")


def keep_good(df: DataFrame, weights: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores at least `threshold`: the same narrow pass."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer()
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, featurize, batch.column(text_col)) >= threshold))
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(kept, df.schema)


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    scores = score(df, train(df, labels, id_col, text_col), id_col, text_col)
    return scores.select(
        "doc_id",
        F.coalesce(~learning_fold(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
