"""Differences of two snapshots as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES, CHANGE = "copies", "change"
# Copies of a row that are made at a time.
AT_ONCE = 10_000


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(columns, copies): how many more copies of a row the second table has; rows that both have as often are left out.

    Nulls are equal to each other, and NaN to NaN. Copies are added up in each task, so one
    shuffle of different rows gives both directions, where EXCEPT ALL each way would take two.
    """
    columns = before.columns
    if set(columns) != set(after.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(after.columns))}")
    signed = before.select(*columns, F.lit(-1).alias(COPIES)).unionByName(after.select(*columns, F.lit(1).alias(COPIES)))
    return signed.groupBy(*columns).agg(F.sum(COPIES).alias(COPIES)).where(F.col(COPIES) != 0)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(change, columns, copies): what was added and removed, and rows that changed under the same key.

    A key with rows on both sides of the difference has changed: its old rows are `changed_from` and its new ones
    `changed_to`. Nulls in a key are equal. `copies` is always positive.
    """
    changes = row_changes(before, after)
    sides = changes.groupBy(*keys).agg((F.min(COPIES) < 0).alias("_lost"), (F.max(COPIES) > 0).alias("_won"))
    rows, by_key = changes.alias("rows"), sides.alias("by_key")
    same = reduce(lambda so_far, each: so_far & each, (F.col(f"rows.{key}").eqNullSafe(F.col(f"by_key.{key}")) for key in keys))
    both, won = F.col("_lost") & F.col("_won"), F.col(COPIES) > 0
    kind = (
        F.when(both & won, "changed_to").when(both, "changed_from").when(won, "added").otherwise("removed")
    )
    return rows.join(by_key, same).select(
        kind.alias(CHANGE), *(F.col(f"rows.{name}") for name in before.columns), F.abs(COPIES).alias(COPIES)
    )


def apply_diff(before: DataFrame, diff: DataFrame) -> DataFrame:
    """The later table, from the earlier one and their difference; copies of rows included.

    A difference that takes away rows which the table does not have is an error.
    """
    columns = before.columns
    sign = F.when(F.col(CHANGE).isin("added", "changed_to"), 1).otherwise(-1)
    signed = before.select(*columns, F.lit(1).cast("long").alias(COPIES)).unionByName(
        diff.select(*columns, (F.col(COPIES) * sign).cast("long").alias(COPIES))
    )
    left = signed.groupBy(*columns).agg(F.sum(COPIES).alias(COPIES)).where(F.col(COPIES) != 0)
    fits = F.when(F.col(COPIES) > 0, F.col(COPIES)).otherwise(F.raise_error(F.lit("the difference removes rows that are not there")))
    return repeated(left.withColumn(COPIES, fits), F.col(COPIES)).drop(COPIES)


def repeated(df: DataFrame, copies: Column) -> DataFrame:
    """Each row so many times, made in two steps: a row of a billion copies needs no array of a billion."""
    runs = df.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1, F.lit(AT_ONCE).cast("long"))))
    length = F.least(copies - F.col("_from"), F.lit(AT_ONCE).cast("long")).cast("int")
    return runs.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), length))).drop("_from", "_copy")
