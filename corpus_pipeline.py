"""A training-data pipeline over `documents`, part of the subpackage `reelhouse.llm`.

Bad texts go, one document of each group of near copies stays, secrets are blotted out, and
what is left is packed into sequences. Each stage works on all that the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import near_dedup, packing, quality, secret_scan
from reelhouse.llm.common import checkpointed, small_batches, table
from reelhouse.session import scratch_path

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good.

    A null text is scored as an empty one. Each row, repeated ones too, is judged by itself; an empty table gives no rows. Labels
    belong to ids, so rows without id teach nothing.
    """
    small_batches(spark)
    documents = docs.select(DOCUMENTS)
    return quality.keep_good(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: that of the smallest id, rows without id after all others.

    What is judged is a row's text, so a text stays if nothing is like it, even if its id has another text that is a copy. Of
    rows that agree in id and text one stays. Null and empty texts are like nothing. An empty table gives no rows.

    Rows are named by a 64-bit digest of id and text. Names that two different rows share, by a second digest (about three in ten
    billion rows), are not deduplicated.
    """
    small_batches(spark)
    named = docs.select(
        *DOCUMENTS, F.xxhash64("doc_id", "text").alias("row_key"), F.xxhash64(F.lit(1), "text", "doc_id").alias("proof")
    )
    rows = checkpointed(
        named.groupBy("row_key").agg(
            F.min("doc_id").alias("doc_id"), (F.min("proof") == F.max("proof")).alias("sure"), F.count("*").alias("held")
        )
    )
    moved = near_dedup.near_duplicates(named.drop("doc_id"), id_col="row_key").where("not kept")
    moved = checkpointed(moved.select(F.col("doc_id").alias("row_key"), F.col("component_id").alias("component")).distinct())
    first = moved.select(F.col("component").alias("row_key"), "component").distinct()
    members = checkpointed(moved.unionByName(first).join(rows.where("sure"), "row_key"))
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row_key")
    best = members.groupBy("component").agg(F.min(order)["row_key"].alias("row_key"))
    copies = members.select("row_key").join(best, "row_key", "left_anti")

    left = named.join(copies, "row_key", "left_anti")
    repeated = checkpointed(rows.where("held > 1 AND sure").select("row_key"))
    if not repeated.isEmpty():
        # only these are reduced to one, each task its own first: a row of which there are very many reaches the next task once
        once = left.join(repeated, "row_key", "left_semi").dropDuplicates(["row_key"])
        left = left.join(repeated, "row_key", "left_anti").unionByName(once)
    return left.select(DOCUMENTS)


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by a mark.

    A null text becomes an empty one. Rows, repeated ones and those without id too, are cleaned one by one; an empty table
    gives no rows.
    """
    found = secret_scan.add_spans(docs.select(DOCUMENTS))
    clean = found.withColumn("clean", secret_scan.redacted(F.coalesce("text", F.lit("")), F.col("spans")))
    return clean.select(
        "doc_id",
        F.col("clean").alias("text"),
        "lang",
        "source",
        F.when(F.size("spans") > 0, F.char_length("clean").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences.

    A null or empty text is its end id alone. Rows, repeated ones and those without id too, are documents of their own; an empty
    table gives no rows.
    """
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", reject_bad),
    ("near copies", drop_near_copies),
    ("secrets", blot_secrets),
    ("packing", pack_sequences),
]

#: A trained classifier cannot be written in SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each but the last returns is stored in the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
