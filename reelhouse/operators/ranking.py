"""Ranks within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.session import checkpointed

# Where monotonically_increasing_id() has the partition: above the row's number in it.
PART_SHIFT = 33


def rank_in_groups(df: DataFrame, groups: Sequence[str], order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Adds the place of a row in its group, from 1. The order should be total; rows that tie get places in any order.

    A window over a group sorts it in one task. Here all rows are sorted by range, so a group with a third of them
    lies in many partitions: a row's place is its number in its partition, plus the rows of the partitions before, less
    those before its group. One shuffle of the rows; counts by partition and group are what else moves.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*groups, *order]
    ordered = checkpointed(
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    )
    part, number = F.shiftright("_at", PART_SHIFT), F.col("_at").bitwiseAND(F.lit((1 << PART_SHIFT) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each partition
    offsets = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_held")).select(
        "_part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_offset")
    )

    def placed(rows: DataFrame, place: str) -> DataFrame:
        with_part = rows.withColumn("_part", part).withColumn("_number", number)
        return with_part.join(offsets, "_part").withColumn(place, F.col("_offset") + F.col("_number")).drop("_part", "_number", "_offset")

    starts = placed(ordered.groupBy(*groups).agg(F.min("_at").alias("_at")), "_start").drop("_at")
    rows, first = placed(ordered, "_place").alias("rows"), starts.alias("first")
    same = reduce(lambda so_far, each: so_far & each, (F.col(f"rows.{name}").eqNullSafe(F.col(f"first.{name}")) for name in groups))
    return rows.join(first, same).select(
        *(F.col(f"rows.{name}") for name in df.columns), (F.col("_place") - F.col("_start") + 1).alias(rank)
    )
