"""Shards of nearly equal bytes, by Karmarkar-Karp differencing of groups that may not be split.

A group is all documents of one text. What is differenced are units: a group of a GRAINS-th of all bytes or
more is a unit by itself, and the smaller groups are gathered into GRAINS units by their digest. So there are
2 * GRAINS units at most, whatever the size of the table, and the same ones however it is partitioned.
Differencing starts with a partial partition per unit, which holds it in one of `shards` places and nothing in the others.
The two partial partitions with the largest spreads are combined, the fullest place of one with the emptiest of the
other, until one is left: its places are the shards.

Bytes are summed by group in each task before anything is shuffled, texts are read once and never moved, and a row finds its
shard through two broadcast tables of GRAINS rows at most, so a text that a third of all documents share is
nowhere gathered. Only the units, with their sizes, come to one task.

Defined results: the size of a text is its UTF-8 bytes plus 1, so a null or an empty text has size 1, and both are the
same text. Every row is placed, repeated rows and rows without id too; all rows of a text share a shard. A text larger than an
even share makes its shard larger than the others, which then share the rest evenly. Slots number the rows of a
shard from 0 without gaps, by scan partition and then by id. An empty table gives no rows; of the other columns
only `write_shards` takes notice.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import checkpointed

#: Units that the smaller groups are gathered into, and the share of all bytes from which a group is a unit itself.
GRAINS = 8192
SHARDS = 8


def differenced(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size, by differencing.

    A partial partition is what its places hold beyond the emptiest one, fullest first. Of equal spreads the
    earlier made goes first.
    """
    held = [[size] + [0] * (shards - 1) for size in sizes]
    combined: list[tuple[int, int, list[int]]] = []
    spreads = [(places[-1] - places[0], number) for number, places in enumerate(held)]
    heapq.heapify(spreads)
    while len(spreads) > 1:
        _, one = heapq.heappop(spreads)
        _, other = heapq.heappop(spreads)
        sums = [full + empty for full, empty in zip(held[one], reversed(held[other]))]
        order = sorted(range(shards), key=lambda place: -sums[place])
        least = sums[order[-1]]
        combined.append((one, other, order))
        held.append([sums[place] - least for place in order])
        heapq.heappush(spreads, (-held[-1][0], len(held) - 1))
        held[one] = held[other] = []  # no longer needed
    # from the last partition down, each place's shard
    shard_of: list[list[int]] = [[] for _ in held]
    if sizes:
        shard_of[-1] = list(range(shards))
    for number in range(len(combined) - 1, -1, -1):
        one, other, order = combined[number]
        named = shard_of[len(sizes) + number]
        shard_of[one], shard_of[other] = [0] * shards, [0] * shards
        for place, shard in zip(order, named):
            shard_of[one][place] = shard
            shard_of[other][shards - 1 - place] = shard
    return [shard_of[number][0] for number in range(len(sizes))]


def _text(df: DataFrame, text_col: str) -> Column:
    return F.coalesce(df[text_col], F.lit(""))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _bucket(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(GRAINS)).cast("int")


def described(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, digest, part) of every row, stored; `part` is the partition it was read in."""
    text = _text(df, text_col)
    return checkpointed(
        df.select(
            df[id_col].cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            _digest(text).alias("digest"),
            F.spark_partition_id().alias("part"),
        )
    )


def shard_units(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(digest, bucket, shard) of every unit, stored: of a large group its digest, of a gathered unit its bucket."""
    groups = checkpointed(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") >= max(1, -(-total // GRAINS))
    units = (
        groups.select(
            F.when(large, F.col("digest")).alias("digest"), F.when(~large, _bucket(F.col("digest"))).alias("bucket"), "bytes"
        )
        .groupBy("digest", "bucket")
        .agg(F.sum("bytes").alias("bytes"))
    )

    def deal(table: pa.Table) -> pa.Table:
        # gathered units have no digest; the order makes the result the same in every run
        table = table.sort_by([("bytes", "descending"), ("digest", "ascending"), ("bucket", "ascending")])
        dealt = differenced(table.column("bytes").to_pylist(), shards)
        return table.select(["digest", "bucket"]).append_column("shard", pa.array(dealt, pa.int32()))

    return checkpointed(units.groupBy().applyInArrow(deal, "digest binary, bucket int, shard int"))


def with_shard(rows: DataFrame, units: DataFrame, digest: Column) -> DataFrame:
    """The rows with the shard of their text's digest; both tables that are broadcast have GRAINS rows at most."""
    large = units.where("digest IS NOT NULL").select(F.col("digest").alias("_digest"), F.col("shard").alias("_of_group"))
    gathered = units.where("bucket IS NOT NULL").select(F.col("bucket").alias("_bucket"), F.col("shard").alias("_of_bucket"))
    return (
        rows.join(F.broadcast(large), digest == F.col("_digest"), "left")
        .join(F.broadcast(gathered), _bucket(digest) == F.col("_bucket"), "left")
        .withColumn("shard", F.coalesce("_of_group", "_of_bucket"))
        .drop("_digest", "_of_group", "_bucket", "_of_bucket")
    )


def assign(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    rows = described(df, id_col, text_col)
    placed = with_shard(rows, shard_units(rows, shards), F.col("digest"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part", "shard").agg(F.count("*").alias("held")).select(
        "part", "shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start")
    )
    in_part = Window.partitionBy("part", "shard").orderBy("doc_id", "digest")
    numbered = placed.withColumn("place", F.row_number().over(in_part) - 1)
    return numbered.join(starts, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).cast("long").alias("slot")
    )


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole rows to a folder per shard, `shard=0` and so on; the rows are not shuffled for it.

    A column named `shard` is replaced.
    """
    units = shard_units(described(df, id_col, text_col), shards)
    kept = df.select(*(df[name] for name in df.columns if name.lower() != "shard"))
    with_shard(kept, units, _digest(_text(kept, text_col))).write.partitionBy("shard").parquet(path)
