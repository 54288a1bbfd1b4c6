"""Top-N marts and repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.schemas import MART_ROWS


def top_n(
    titles: DataFrame,
    platform: str,
    metric: str,
    n: int = MART_ROWS,
    tie_break: str = "id",
    nan_as_null: bool = False,
) -> DataFrame:
    """The `n` titles of one platform with the highest metric, nulls last, ties by id.

    NaN ranks above every number, as in any descending Spark sort; `nan_as_null=True`
    ranks it with the nulls. Titles are unique per id and platform, as the dedupe leaves them.

    Ranked are only the metric and the id: each task keeps a heap of `n`, and the last one merges narrow
    rows. The `n` ids, no more at any input size, then fetch their rows.
    """
    value = F.col(metric)
    if nan_as_null:
        value = F.when(~F.isnan(value), value)
    order = [value.desc_nulls_last(), F.col(tie_break).asc_nulls_last()]
    rows = titles.where(F.col("platform") == platform)
    best = rows.select(metric, tie_break).orderBy(*order).limit(n).select(F.col(tie_break).alias("_best"))
    found = rows.join(F.broadcast(best.distinct()), F.col(tie_break).eqNullSafe(F.col("_best")), "left_semi")
    return found.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first `n` rows by the given columns and then all others: the same rows each time.

    Rows need not be unique, so whole rows are ranked; each task keeps a heap of `n`.
    """
    names = order_by + [name for name in df.columns if name not in order_by]
    return df.orderBy(*(F.col(name).asc_nulls_last() for name in names)).limit(n)
