"""What became of each title over the days of its snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.operators.ranking import rank_in_groups
from reelhouse.schemas import TITLE_KEY

DAY = "snapshot_date"


def title_history(snapshots: DataFrame, metric: str = "tmdb_popularity", days: int = 7) -> DataFrame:
    """A row for each title and day that has it, with ranks on the day and frames over its days.

    `day_rank` is the title's place on its platform that day: metric descending, nulls and NaN last, ties by id.
    `previous_day` is the last day before that has the title, and `rank_change` the places won since; days without a
    snapshot, or without the title, are passed over. `rolling_avg` averages the metric over the last `days` calendar
    days, this one included, and `rolling_days` says how many of them have it, so a gap shortens a frame and does not
    stretch it. `first_value` and `last_value` are those of the first and last day that have a value.

    A day written twice counts once, with the largest value of each title. Ranks are made by a distributed sort, as a
    platform may hold most rows; the frames of a title span its days only. Titles without id or platform are kept, as
    one title each for all that lack it.
    """
    value = F.when(~F.isnan(metric), F.col(metric))
    daily = snapshots.groupBy(*TITLE_KEY, F.col(DAY).cast("date").alias(DAY)).agg(F.max(value).alias("value"))
    ranked = rank_in_groups(
        daily, ["platform", DAY], [F.col("value").desc_nulls_last(), F.col("id").asc_nulls_last()], "day_rank"
    )
    by_day = Window.partitionBy(*TITLE_KEY).orderBy(DAY)
    # a frame of calendar days needs a number to order by
    lately = Window.partitionBy(*TITLE_KEY).orderBy(F.unix_date(DAY)).rangeBetween(-(days - 1), 0)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return ranked.select(
        *TITLE_KEY,
        DAY,
        "value",
        "day_rank",
        F.lag(DAY).over(by_day).alias("previous_day"),
        (F.lag("day_rank").over(by_day) - F.col("day_rank")).alias("rank_change"),
        F.avg("value").over(lately).alias("rolling_avg"),
        F.count("value").over(lately).alias("rolling_days"),
        F.first("value", ignorenulls=True).over(whole).alias("first_value"),
        F.last("value", ignorenulls=True).over(whole).alias("last_value"),
    )
