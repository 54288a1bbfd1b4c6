"""Genres and countries as values: list text to rows, and summaries that count a title once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.schemas import TITLE_KEY


def list_values(text: Column) -> Column:
    """The values of a cleaned list text, in order: split at commas, without padding and enclosing single quotes.

    Empty items are left out, a null text is null, and repeated values stay.
    """
    items = F.transform(F.split(text, ","), lambda item: F.regexp_replace(F.trim(item), r"^'(.*)'$", "$1"))
    return F.filter(items, lambda item: F.trim(item) != "")


def list_rows(df: DataFrame, column: str, keys: Sequence[str] = TITLE_KEY, keep_empty: bool = False) -> DataFrame:
    """(keys, position, value): a row for each value of a list column, positions from 1.

    A row without values gives none, or with `keep_empty` one with nulls. Made row by row, without a shuffle.
    """
    values = list_values(F.col(column))
    each = F.posexplode_outer(values) if keep_empty else F.posexplode(values)
    return df.select(*keys, each.alias("position", "value")).withColumn("position", F.col("position") + 1)


def summary_by_value(titles: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, titles, rated, avg_imdb_score, share) of each value of a list column.

    A title counts once for a value, however often its list repeats it: repeats go within the row, so
    that no distinct is shuffled. `share` deals a title out evenly among its values, so shares add up to the number of
    titles that have any. NaN scores do not count as rated.
    """
    values = F.array_distinct(list_values(F.col(column)))
    score = F.when(~F.isnan("imdb_score"), F.col("imdb_score"))
    rows = titles.select(*by, score.alias("score"), F.size(values).alias("among"), F.explode(values).alias("value"))
    return rows.groupBy(*by, "value").agg(
        F.count("*").alias("titles"),
        F.count("score").alias("rated"),
        F.avg("score").alias("avg_imdb_score"),
        F.sum(F.lit(1.0) / F.col("among")).alias("share"),
    )
