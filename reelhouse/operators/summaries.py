"""Subtotals, and exact and sketched distinct counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TITLE_DIMENSIONS = ("platform", "release_year", "age_certification")
# 2 ** SKETCH_BITS registers: a standard error of 1.04 / 2 ** (SKETCH_BITS / 2), which is 1.6 %.
SKETCH_BITS = 12


def subtotals(
    df: DataFrame, measures: Sequence[Column], dimensions: Sequence[str] = TITLE_DIMENSIONS, sets: Sequence[Sequence[str]] | str = "cube"
) -> DataFrame:
    """Measures of every set of dimensions: "cube" is all subsets, "rollup" all leading ones, or the sets themselves.

    `is_total_<dimension>` is 1 where the dimension was added up over, so that its null is not taken for a null of the
    data. One pass: Spark expands each row to the sets and combines in the task before it shuffles.
    """
    if sets == "cube":
        grouped = df.cube(*dimensions)
    elif sets == "rollup":
        grouped = df.rollup(*dimensions)
    else:
        unknown = {name for each in sets for name in each} - set(dimensions)
        if unknown:
            raise ValueError(f"sets of unknown dimensions: {sorted(unknown)}")
        grouped = df.groupingSets([[F.col(name) for name in each] for each in sets], *(F.col(name) for name in dimensions))
    flags = (F.grouping(name).cast("int").alias(f"is_total_{name}") for name in dimensions)
    return grouped.agg(*flags, *measures)


def distinct_counts(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values of several columns in each group; nulls do not count.

    Spark expands a row to one for each column and removes repeats in the task, by (group, column, value): the shuffle
    holds distinct values, and a group with a third of all rows is spread over its values.
    """
    return df.groupBy(*by).agg(*(F.count_distinct(name).alias(f"distinct_{name}") for name in columns))


def distinct_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of the distinct values of each column in each group, to be stored and merged.

    A sketch has a fixed size, whatever it has seen; nulls do not count.
    """
    return df.groupBy(*by).agg(*(F.hll_sketch_agg(name, bits).alias(name) for name in columns))


def merged_sketches(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sketches of several days, parts or tables as one for each group: what a sketch of all their rows would be."""
    return sketches.groupBy(*by).agg(*(F.hll_union_agg(name).alias(name) for name in columns))


def sketched_counts(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Estimated number of distinct values of each column in each group, named as by `distinct_counts`."""
    return sketches.select(*by, *(F.hll_sketch_estimate(name).alias(f"distinct_{name}") for name in columns))


def within_error(exact: Column, estimate: Column, bits: int = SKETCH_BITS, standard_errors: float = 4.0) -> Column:
    """Whether an estimate is as close to the exact count as its sketch promises."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * (standard_errors * 1.04 / 2 ** (bits / 2)))


def differing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """Rows of both tables by key, nulls being equal, with 0/1 flags for conditions over `left` and `right` columns."""
    same = reduce(lambda so_far, each: so_far & each, (F.col(f"left.{key}").eqNullSafe(F.col(f"right.{key}")) for key in keys))
    joined = left.alias("left").join(right.alias("right"), same, "full")
    both = (F.coalesce(F.col(f"left.{key}"), F.col(f"right.{key}")).alias(key) for key in keys)
    return joined.select(*both, *(F.coalesce(held, F.lit(False)).cast("int").alias(name) for name, held in conditions.items()))
