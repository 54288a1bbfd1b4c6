"""Ingest job: CSV exports of any number of platforms to event topics."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions.codec import encode
from reelhouse.functions.tagging import tag
from reelhouse.operators.combine import union_all
from reelhouse.operators.marts import sample_rows
from reelhouse.sources.csv import RAW_RECORD, read_csv, unparsed
from reelhouse.sources.errors import MissingInput

# Exports whose files are looked at side by side before the ingest.
LOOKED_AT_ONCE = 8

# Takes the encoded events and the topic they belong to.
Deliver = Callable[[DataFrame, str], None]


@dataclass(frozen=True)
class Feed:
    """One platform's two CSV exports (a file, folder or glob each)."""

    platform: str
    titles: str
    credits: str


def ingest(
    spark: SparkSession,
    feeds: Iterable[Feed],
    deliver: Deliver,
    ingested_at: str | None = None,
    sample: int | None = None,
    multi_line: bool | None = None,
    reject: Deliver | None = None,
) -> None:
    """Tag, unite and encode all feeds, and deliver titles and credits, one job each.

    Both entities of all feeds are looked at before anything is delivered: a missing file, or one
    without a key column, raises with nothing sent.

    `sample` sends only that many rows of each export, always the same ones; the default
    sends all. `ingested_at` replaces the current time (`yyyy-MM-dd HH:mm:ss`). `multi_line`
    says whether quoted fields hold line breaks; by default the files are searched for them.
    `reject` takes, per topic, the (platform, text) of the records that have a field which does not
    parse; they are delivered with that field null all the same.
    """
    feeds = list(feeds)
    if not feeds:
        raise MissingInput("no feeds to ingest")
    entities = {
        schemas.TITLES_TOPIC: (schemas.TITLES, schemas.TITLE_REQUIRED, ["id"]),
        schemas.CREDITS_TOPIC: (schemas.CREDITS, schemas.CREDIT_REQUIRED, ["person_ID", "id"]),
    }

    def scan(feed: Feed, topic: str) -> DataFrame:
        columns, required, _ = entities[topic]
        path = feed.titles if topic == schemas.TITLES_TOPIC else feed.credits
        keys = [name for name in required if name not in schemas.TAG_COLUMNS]
        return read_csv(spark, path, schemas.csv_columns(columns), multi_line, keys, keep_raw=reject is not None)

    # Each scan looks at its files first (header, split records): do that for some of them at once.
    with ThreadPoolExecutor(LOOKED_AT_ONCE) as pool:
        looked = {topic: [pool.submit(scan, feed, topic) for feed in feeds] for topic in entities}
    scans = {topic: [each.result() for each in found] for topic, found in looked.items()}

    for topic, (_, _, first) in entities.items():
        tagged, bad = [], []
        for feed, rows in zip(feeds, scans[topic]):
            if reject is not None:
                bad.append(unparsed(rows).select(F.lit(feed.platform).alias("platform"), RAW_RECORD))
                rows = rows.drop(RAW_RECORD)
            if sample is not None:
                rows = sample_rows(rows, sample, first)
            tagged.append(tag(rows, feed.platform, ingested_at))
        if reject is not None:
            reject(union_all(bad), topic)
        deliver(encode(union_all(tagged)), topic)
