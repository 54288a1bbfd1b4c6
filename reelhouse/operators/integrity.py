"""Referential checks in both directions, with a Bloom filter of the smaller side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.joins import equal_keys, sized
from reelhouse.session import checkpointed

# Bits for each key of the filter and positions set by it: 1 in 120 absent keys passes.
BITS_PER_KEY, POSITIONS = 10, 7
# Largest filter, in 64-bit words (32 MB). More keys than it has room for only let more rows through to the join.
MOST_WORDS = 1 << 22


def _positions(keys: Sequence[str], words: int) -> list[Column]:
    """Bit numbers of a key: multiples of one hash added to another."""
    first, step = (F.pmod(each, F.lit(1 << 40)) for each in (F.xxhash64(*keys), F.xxhash64(F.lit("step"), *keys)))
    return [F.pmod(first + step * number, F.lit(words * 64)) for number in range(POSITIONS)]


def bloom_filter(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """A row (bits) with the filter of all keys as an array of 64-bit words, stored, and its number of words.

    Words are or-ed together in each task first, so what is shuffled is at most the filter's own size from each.
    """
    count = df.select(*keys).distinct().count()
    words = min(max(1, -(-count * BITS_PER_KEY // 64)), MOST_WORDS)
    set_bits = df.select(F.explode(F.array(*_positions(keys, words))).alias("position")).select(
        F.shiftright("position", 6).alias("word"),
        F.expr("shiftleft(1L, CAST(position & 63 AS INT))").alias("bit"),
    )
    empty = df.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    held = set_bits.unionByName(empty).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return checkpointed(held.agg(F.transform(in_order, lambda each: each["bits"]).alias("bits"))), words


def may_contain(keys: Sequence[str], bits: Column, words: int) -> Column:
    """Whether a key may be in the filter; false is certain."""
    return reduce(
        lambda so_far, each: so_far & each,
        (
            F.getbit(F.get(bits, F.shiftright(position, 6).cast("int")), position.bitwiseAND(F.lit(63)).cast("int")) == 1
            for position in _positions(keys, words)
        ),
    )


def _present(keys: Sequence[str]) -> Column:
    return reduce(lambda so_far, each: so_far & each, (F.col(name).isNotNull() for name in keys))


def unreferenced(
    smaller: DataFrame, larger: DataFrame, smaller_keys: Sequence[str], larger_keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows of the smaller table whose key the larger one lacks, rows of the larger whose key the smaller lacks).

    Every row counts, repeated ones too. A null in a key refers to nothing, so such rows are in the result.

    A Bloom filter of the smaller table's keys is put before both joins, as a scalar subquery. Rows of the larger one that do not
    pass it are orphans without being joined, and are no one's reference: only those that pass are
    shuffled, by distinct key in one direction, and against distinct keys in the other, so
    that a key of a third of all rows is one row of a join's side.
    """
    names = [f"_key{number}" for number in range(len(smaller_keys))]
    bits, words = bloom_filter(smaller.where(_present(smaller_keys)), smaller_keys)
    passes = _present(larger_keys) & may_contain(larger_keys, bits.scalar(), words)

    known = smaller.where(_present(smaller_keys)).select(*(F.col(key).alias(name) for key, name in zip(smaller_keys, names))).distinct()
    met = larger.where(passes).select(*(F.col(key).alias(name) for key, name in zip(larger_keys, names))).distinct()

    def on(df: DataFrame, keys: Sequence[str], other: DataFrame) -> Column:
        return equal_keys(df, other, dict(zip(keys, names)))

    lacking = smaller.where(_present(smaller_keys))
    unmet = lacking.join(met, on(lacking, smaller_keys, met), "left_anti").unionByName(smaller.where(~_present(smaller_keys)))
    doubtful, side = larger.where(passes), sized(known)
    orphans = doubtful.join(side, on(doubtful, larger_keys, side), "left_anti").unionByName(larger.where(~passes))
    return unmet, orphans


def reference_counts(
    smaller: DataFrame, larger: DataFrame, smaller_keys: Sequence[str], larger_keys: Sequence[str]
) -> DataFrame:
    """(side, row_count, orphan_rows, orphan_keys) of both tables; rows with a null in their key are orphans without a key.

    Each table is read once, to count the rows of each key; what is looked up, and passes the filter, are keys.
    """

    def by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return checkpointed(df.groupBy(*keys).agg(F.count("*").alias("held")))

    counts = by_key(smaller, smaller_keys), by_key(larger, larger_keys)
    unmet, orphans = unreferenced(*counts, smaller_keys, larger_keys)

    def counted(side: str, all_keys: DataFrame, bad: DataFrame, keys: Sequence[str]) -> DataFrame:
        rows = F.coalesce(F.sum("held"), F.lit(0))
        found = bad.agg(rows.alias("orphan_rows"), F.count_if(_present(keys)).alias("orphan_keys"))
        return all_keys.agg(F.lit(side).alias("side"), rows.alias("row_count")).crossJoin(F.broadcast(found))

    return counted("smaller", counts[0], unmet, smaller_keys).unionByName(counted("larger", counts[1], orphans, larger_keys))
