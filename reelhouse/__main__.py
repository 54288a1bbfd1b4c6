"""Command line: python -m reelhouse {ingest,bronze,transform,publish,daily} ...

Every step is a plain call of the job of the same name, for use with spark-submit and any
scheduler. A failed step ends with an error.
"""

from __future__ import annotations

import argparse
import datetime
import os

from pyspark.sql import SparkSession

from reelhouse import schemas
from reelhouse.plans.bronze import land_topics
from reelhouse.plans.daily import DailyRun, run_daily
from reelhouse.plans.ingest import Feed, ingest
from reelhouse.plans.lake import Lake
from reelhouse.plans.publish import publish_tables
from reelhouse.plans.transform import transform
from reelhouse.session import build_session
from reelhouse.sinks import events as event_sink
from reelhouse.sinks.jdbc import JdbcTarget
from reelhouse.sources import events as event_source


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="reelhouse", description=__doc__)
    steps = root.add_subparsers(dest="step", required=True)

    feeds = argparse.ArgumentParser(add_help=False)
    feeds.add_argument(
        "--feed",
        nargs=3,
        action="append",
        required=True,
        metavar=("PLATFORM", "TITLES_CSV", "CREDITS_CSV"),
        help="one platform's exports; repeat for every platform",
    )
    feeds.add_argument("--sample", type=int, help="send only this many rows of each export")
    feeds.add_argument(
        "--multi-line",
        choices=("yes", "no"),
        help="whether quoted CSV fields hold line breaks; by default each file is searched for them",
    )
    feeds.add_argument("--csv-rejects", metavar="FOLDER", help="keep the text of CSV records with a field that does not parse")
    feeds.add_argument("--ingested-at", metavar="TIME", help="yyyy-MM-dd HH:mm:ss; default: now")

    topics = argparse.ArgumentParser(add_help=False)
    place = topics.add_mutually_exclusive_group(required=True)
    place.add_argument("--kafka", metavar="SERVERS", help="bootstrap servers")
    place.add_argument("--topic-folder", help="shared folder that holds the events as Parquet files")

    streams = argparse.ArgumentParser(add_help=False)
    streams.add_argument(
        "--max-per-batch", type=int, help="upper bound of one batch: Kafka offsets, or files of a topic folder"
    )
    streams.add_argument("--min-partitions", type=int, help="split large Kafka partitions into this many tasks")
    streams.add_argument("--by-day", action="store_true", help="write bronze by ingestion day, for --since")
    streams.add_argument("--unique-within", metavar="TIME", help='leave out messages delivered again within a time, such as "1 day"')
    streams.add_argument("--keep-rejects", action="store_true", help="keep the raw text of bad messages")
    streams.add_argument(
        "--window-secs",
        type=float,
        default=schemas.STREAM_WINDOW_SECS,
        help="time limit of the streams; 0 for none (default %(default)s)",
    )

    lake = argparse.ArgumentParser(add_help=False)
    lake.add_argument("--lake", required=True, help="shared base folder of bronze, checkpoints and snapshots")

    tables = argparse.ArgumentParser(add_help=False)
    tables.add_argument("--database", default=schemas.DATABASE)
    tables.add_argument("--location", help="folder of the database, if it does not exist yet")
    tables.add_argument(
        "--catalog",
        choices=("hive", "in-memory"),
        default="hive",
        help="in-memory forgets the tables when the session ends (default %(default)s)",
    )

    snapshots = argparse.ArgumentParser(add_help=False)
    snapshots.add_argument("--snapshot-date", type=datetime.date.fromisoformat, help="default: today")
    snapshots.add_argument("--replace-day", action="store_true", help="replace the day's snapshot, not append")
    snapshots.add_argument(
        "--since",
        type=datetime.date.fromisoformat,
        help="merge bronze of this and later ingestion days into the tables, instead of all bronze",
    )
    snapshots.add_argument("--files-per-day", type=int, help="most files of a day's snapshot")
    snapshots.add_argument("--nan-as-null", action="store_true", help="rank NaN last in the marts")
    snapshots.add_argument("--side-by-side", type=int, default=3, help="writes that run at a time (default %(default)s)")

    def jdbc(required: bool) -> argparse.ArgumentParser:
        options = argparse.ArgumentParser(add_help=False)
        options.add_argument("--jdbc-url", required=required)
        options.add_argument("--jdbc-driver", default="com.mysql.cj.jdbc.Driver")
        options.add_argument("--jdbc-user")
        options.add_argument("--jdbc-password-env", help="environment variable that holds the password")
        options.add_argument("--jdbc-writers", type=int, default=schemas.JDBC_WRITERS)
        options.add_argument("--jdbc-batch-rows", type=int, default=schemas.JDBC_BATCH_ROWS)
        return options

    steps.add_parser("ingest", parents=[feeds, topics], help="CSV exports to event topics")
    steps.add_parser("bronze", parents=[topics, streams, lake], help="event topics to bronze Parquet")
    steps.add_parser("transform", parents=[lake, tables, snapshots], help="bronze to tables and snapshots")
    steps.add_parser("publish", parents=[tables, jdbc(True)], help="transformed tables to a database")
    steps.add_parser(
        "daily",
        parents=[feeds, topics, streams, lake, tables, snapshots, jdbc(False)],
        help="all steps in order",
    )
    return root


def _deliver(arguments):
    if arguments.kafka:
        return lambda events, topic: event_sink.to_kafka(events, arguments.kafka, topic)
    return lambda events, topic: event_sink.to_folder(events, f"{arguments.topic_folder}/{topic}")


def _receive(arguments):
    limit = arguments.max_per_batch
    if arguments.kafka:
        return lambda spark, topic: event_source.from_kafka(
            spark,
            arguments.kafka,
            topic,
            max_offsets_per_trigger=limit,
            min_partitions=arguments.min_partitions,
        )
    return lambda spark, topic: event_source.from_folder(spark, f"{arguments.topic_folder}/{topic}", limit)


def _multi_line(arguments) -> bool | None:
    return None if arguments.multi_line is None else arguments.multi_line == "yes"


def _reject(arguments):
    folder = arguments.csv_rejects
    return None if folder is None else lambda rows, topic: rows.write.mode("append").json(f"{folder}/{topic}")


def _target(arguments) -> JdbcTarget | None:
    if not arguments.jdbc_url:
        return None
    password = os.environ[arguments.jdbc_password_env] if arguments.jdbc_password_env else None
    return JdbcTarget(arguments.jdbc_url, arguments.jdbc_driver, arguments.jdbc_user, password)


def run(spark: SparkSession, arguments: argparse.Namespace) -> None:
    if arguments.step == "ingest":
        feeds = [Feed(*feed) for feed in arguments.feed]
        ingest(
            spark,
            feeds,
            _deliver(arguments),
            arguments.ingested_at,
            arguments.sample,
            _multi_line(arguments),
            _reject(arguments),
        )
    elif arguments.step == "bronze":
        land_topics(
            spark,
            _receive(arguments),
            Lake(arguments.lake),
            arguments.window_secs or None,
            arguments.keep_rejects,
            arguments.by_day,
            arguments.unique_within,
        )
    elif arguments.step == "transform":
        lake = Lake(arguments.lake)
        transform(
            spark,
            lake.titles,
            lake.credits,
            lake.snapshots,
            database=arguments.database,
            location=arguments.location,
            snapshot_date=arguments.snapshot_date,
            replace_day=arguments.replace_day,
            files_per_day=arguments.files_per_day,
            nan_as_null=arguments.nan_as_null,
            side_by_side=arguments.side_by_side,
            since=arguments.since,
        )
    elif arguments.step == "publish":
        publish_tables(
            spark,
            _target(arguments),
            arguments.database,
            batch_rows=arguments.jdbc_batch_rows,
            writers=arguments.jdbc_writers,
        )
    else:
        run_daily(
            spark,
            DailyRun(
                feeds=tuple(Feed(*feed) for feed in arguments.feed),
                deliver=_deliver(arguments),
                receive=_receive(arguments),
                lake=Lake(arguments.lake),
                database=arguments.database,
                location=arguments.location,
                target=_target(arguments),
                sample=arguments.sample,
                multi_line=_multi_line(arguments),
                reject=_reject(arguments),
                ingested_at=arguments.ingested_at,
                files_per_day=arguments.files_per_day,
                nan_as_null=arguments.nan_as_null,
                side_by_side=arguments.side_by_side,
                by_day=arguments.by_day,
                unique_within=arguments.unique_within,
                since=arguments.since,
                snapshot_date=arguments.snapshot_date,
                replace_day=arguments.replace_day,
                keep_rejects=arguments.keep_rejects,
                jdbc_batch_rows=arguments.jdbc_batch_rows,
                jdbc_writers=arguments.jdbc_writers,
                stream_window_secs=arguments.window_secs or None,
            ),
        )


def main(words: list[str] | None = None) -> None:
    arguments = parser().parse_args(words)
    spark = build_session(f"reelhouse {arguments.step}", hive=getattr(arguments, "catalog", "") == "hive")
    run(spark, arguments)


if __name__ == "__main__":
    main()
