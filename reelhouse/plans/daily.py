"""The whole run: ingest, bronze, transform, publish, in that order.

When it runs, and what happens after a failure, is up to the scheduler that calls it.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reelhouse import schemas
from reelhouse.plans.bronze import Receive, land_topics
from reelhouse.plans.ingest import Deliver, Feed, ingest
from reelhouse.plans.lake import Lake
from reelhouse.plans.publish import publish_tables
from reelhouse.plans.transform import transform
from reelhouse.sinks.jdbc import JdbcTarget


@dataclass(frozen=True)
class DailyRun:
    """Settings of one run; without a `target` nothing is published."""

    feeds: tuple[Feed, ...]
    deliver: Deliver
    receive: Receive
    lake: Lake
    database: str = schemas.DATABASE
    location: str | None = None
    target: JdbcTarget | None = None
    column_types: dict[str, str | None] | None = None
    jdbc_batch_rows: int = schemas.JDBC_BATCH_ROWS
    jdbc_writers: int = schemas.JDBC_WRITERS
    sample: int | None = None
    multi_line: bool | None = None
    reject: Deliver | None = None
    files_per_day: int | None = None
    nan_as_null: bool = False
    side_by_side: int = 3
    ingested_at: str | None = None
    snapshot_date: datetime.date | None = None
    replace_day: bool = False
    keep_rejects: bool = False
    by_day: bool = False
    unique_within: str | None = None
    since: datetime.date | None = None
    stream_window_secs: float | None = schemas.STREAM_WINDOW_SECS


def run_daily(spark: SparkSession, run: DailyRun) -> dict[str, DataFrame]:
    """Run every step and return scans of the tables by name; the first failure is raised."""
    ingest(spark, run.feeds, run.deliver, run.ingested_at, run.sample, run.multi_line, run.reject)
    land_topics(spark, run.receive, run.lake, run.stream_window_secs, run.keep_rejects, run.by_day, run.unique_within)
    tables = transform(
        spark,
        run.lake.titles,
        run.lake.credits,
        run.lake.snapshots,
        database=run.database,
        location=run.location,
        snapshot_date=run.snapshot_date,
        replace_day=run.replace_day,
        files_per_day=run.files_per_day,
        nan_as_null=run.nan_as_null,
        side_by_side=run.side_by_side,
        since=run.since,
    )
    if run.target:
        publish_tables(
            spark, run.target, run.database, run.column_types, run.jdbc_batch_rows, run.jdbc_writers
        )
    return tables
