"""Dated Parquet snapshots."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.sinks.folders import remove_folder


def write_snapshot(
    df: DataFrame,
    path: str,
    snapshot_date: datetime.date | None = None,
    replace_day: bool = False,
    files_per_day: int | None = None,
) -> None:
    """Write `df` below `path`, partitioned by `snapshot_date` (today unless given).

    By default rows are appended, so a second run on one day doubles that day;
    `replace_day=True` replaces that day only and makes reruns safe; without rows it removes
    the day. `files_per_day` bounds the number of files; every file is still written by a task of its own.
    """
    day = snapshot_date or df.sparkSession.range(1).select(F.current_date()).first()[0]
    if replace_day and df.isEmpty():
        # a dynamic overwrite touches only partitions that get rows
        remove_folder(df.sparkSession, f"{path}/snapshot_date={day.isoformat()}")
        return
    dated = df.withColumn("snapshot_date", F.lit(day))
    if files_per_day:
        dated = dated.coalesce(files_per_day)
    writer = dated.write.partitionBy("snapshot_date")
    if replace_day:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)
