"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.operators.clean import clean_credits, clean_titles, require_keys
from reelhouse.schemas import CREDIT_KEY, CREDIT_REQUIRED, TITLE_KEY, TITLE_REQUIRED


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: str = "ingestion_timestamp") -> DataFrame:
    """The latest row of each key; ties fall to the other columns, ascending, nulls last.

    Nulls in a key are equal to each other. The order covers every column, so the result
    does not depend on partitioning or input order. `row_number() = 1` lets Spark keep one
    row per key in each task before the shuffle: a key that holds a large share of
    all rows reaches its reducer as one row per task.
    """
    others = [name for name in df.columns if name not in keys and name != order_by]
    window = Window.partitionBy(*keys).orderBy(
        F.col(order_by).desc_nulls_last(), *(F.col(name).asc_nulls_last() for name in others)
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def transformed_titles(bronze: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Clean titles, one per (id, platform).

    The platform leads the key, so the rows leave the dedupe sorted by platform and the
    files written from it let readers of one platform skip the pages of the others.

    `before` is an earlier result over other bronze rows. A survivor is the first by a total order, so the
    survivors of old survivors and new rows are those of all rows.
    """
    return _survivors(clean_titles(require_keys(bronze, TITLE_REQUIRED)), before, TITLE_KEY)


def transformed_credits(bronze: DataFrame, before: DataFrame | None = None) -> DataFrame:
    return _survivors(clean_credits(require_keys(bronze, CREDIT_REQUIRED)), before, CREDIT_KEY)


def _survivors(clean: DataFrame, before: DataFrame | None, key: Sequence[str]) -> DataFrame:
    return keep_latest(clean if before is None else clean.unionByName(before), key)
