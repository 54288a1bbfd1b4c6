"""Equi-joins over the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest table, in bytes of its rows in memory, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024**2
# What a row, and a value of a fixed width, take beside the bytes of texts.
ROW_BYTES, VALUE_BYTES = 16, 8
# Parts that rows without a key are spread over.
SPREAD = 4096


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table's rows in memory, by one pass over it.

    Files say little about this: they are compressed, and a scan that is filtered or joined has no files
    of its own.
    """
    texts = [name for name, kind in df.dtypes if kind in ("string", "binary")]
    fixed = ROW_BYTES + VALUE_BYTES * len(df.columns)
    length = reduce(lambda total, name: total + F.coalesce(F.octet_length(name), F.lit(0)), texts, F.lit(fixed))
    return df.agg(F.sum(length.cast("long"))).first()[0] or 0


def sized(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The smaller side of a join, hinted by its measured size: broadcast up to `most_bytes`, else sort-merge.

    In a sort-merge join, adaptive execution splits partitions that are much larger than the others, so a key with
    a large share of the other side's rows is met by several tasks.
    """
    return df.hint("broadcast" if measured_bytes(df) <= most_bytes else "merge")


def equal_keys(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> Column:
    """Equality of all key columns, left name -> right name."""
    return reduce(lambda so_far, each: so_far & each, (left[mine] == right[theirs] for mine, theirs in keys.items()))


def lookup_join(
    facts: DataFrame, dimension: DataFrame, keys: dict[str, str], add: Sequence[str], keep_unmatched: bool = True, most_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Facts with columns of the dimension row of their key.

    A null in a key matches nothing: with `keep_unmatched` such facts stay, with nulls added. A dimension with several
    rows of a key gives each of them, as in SQL; `unique_rows` makes it one.

    A further key, 0 on both sides, differs where a key is null: facts without key, a third of all
    rows perhaps, are spread over the shuffle instead of being sent to one task.
    """
    named = [F.col(theirs).alias(f"_{theirs}") for theirs in keys.values()] + [F.col(name) for name in add]
    # a hash modulo 1 is 0, which the optimizer does not know: a literal would leave the join's keys
    zero = F.pmod(F.xxhash64(*keys.values()), F.lit(1))
    side = sized(dimension.where(_all_present(keys.values())).select(*named, zero.alias("_spread_of")), most_bytes)
    spread = F.when(_all_present(keys), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)))
    keyed = facts.withColumn("_spread", spread.cast("long"))
    on = {mine: f"_{theirs}" for mine, theirs in keys.items()} | {"_spread": "_spread_of"}
    joined = keyed.join(side, equal_keys(keyed, side, on), "left" if keep_unmatched else "inner")
    return joined.select(*facts.columns, *add)


def _all_present(names) -> Column:
    return reduce(lambda so_far, each: so_far & each, (F.col(name).isNotNull() for name in names))


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key: the smallest by the other columns, nulls last.

    An aggregate, so rows of a frequent key are reduced in each task before they are shuffled.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    # nulls sort first in a struct, so each column is led by whether it is null
    order = F.struct(*(part for name in others for part in (F.col(name).isNull().alias(f"{name}_absent"), F.col(name))))
    least = df.groupBy(*keys).agg(F.min(order).alias("_least"))
    return least.select(*keys, *(F.col(f"_least.{name}").alias(name) for name in others)).select(*df.columns)


def star_join(
    facts: DataFrame,
    titles: DataFrame,
    persons: DataFrame,
    title_columns: Sequence[str] = ("title", "show_type", "release_year"),
    keep_unmatched: bool = True,
    most_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """fact_credits with columns of their title, by (id, platform), and the name of their person.

    No fact is multiplied: of several rows of a title's key the smallest is taken, and of a person's
    names the alphabetically first. A fact whose title or person is unknown has nulls there, or is left out.
    """
    named = unique_rows(persons.select(F.col("person_ID").alias("person_id"), "name"), ["person_id"])
    title_key = {"id": "id", "platform": "platform"}
    described = unique_rows(titles.select(*title_key, *title_columns), list(title_key))
    with_titles = lookup_join(facts, described, title_key, title_columns, keep_unmatched, most_bytes)
    return lookup_join(with_titles, named, {"person_id": "person_id"}, ["name"], keep_unmatched, most_bytes)
