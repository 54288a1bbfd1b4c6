"""Streams with state: event-time windows, deduplication of deliveries, joins of two streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelhouse.streaming.drain import start_drain

# 128 bits: among 10^12 messages, two have one digest with a chance of 10^-15.
DIGEST_BYTES = 16
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
# Session settings for a drain of unique events, from its start to its end.
UNIQUE_SETTINGS = {
    # The state lies on the executors' disks; as objects on the heap, a digest takes 200 to 400 bytes. A checkpoint that was begun
    # with another store goes on with that.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch adds its own digests to the checkpoint, not the files that the store has merged anew.
    f"{ROCKSDB}.changelogCheckpointing.enabled": "true",
    # One limit of memory (500 MB) for all partitions of an executor, not 64 MB of buffers for each.
    f"{ROCKSDB}.boundedMemoryUsage": "true",
    f"{ROCKSDB}.allowFAllocate": "false",
    # A new message is not looked up once more to count the rows of the state; progress reports none.
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",
    # A batch without messages would only go through the state for what is out of time, as the next one does.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # What a batch has shuffled is removed when it ends, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A task holds the messages that it deals in memory, and spills what does not fit: about a million in 16 MB of files.
    "spark.sql.files.maxPartitionBytes": "16m",
}


def event_windows(
    rows: DataFrame, time: str, length: str, delay: str, keys: Sequence[str], measures: Sequence[Column], slide: str | None = None
) -> DataFrame:
    """(window_start, window_end, keys, measures) of windows over a stream's own times, of all that closed.

    A window closes, and is given out once, when the watermark (the largest time of the batches before, less `delay`)
    reaches its end. Then its state is dropped, so the state holds open windows only. Rows that come after their window closed
    are dropped by Spark: put `late.start_split` with the same delay in front, which keeps them.
    """
    window = F.window(time, length, slide) if slide else F.window(time, length)
    closed = rows.withWatermark(time, delay).groupBy(window.alias("window"), *keys).agg(*measures)
    return closed.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *(name for name in closed.columns if name != "window")
    )


def start_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows to a Parquet folder; a rerun goes on from the checkpoint's state."""
    return start_drain(windows, path, checkpoint)


def unique_events(events: DataFrame, within: str) -> DataFrame:
    """An event stream without redelivered messages: of equal `value`s that arrive within a time, the first.

    What counts is the time of arrival, so no event is ever late and none is lost: an event that comes again after
    longer than `within` passes once more, which the later dedupe absorbs. The state holds a digest of each message of that
    time, the first DIGEST_BYTES of its SHA-256, and is dropped as arrivals go on. A null value is a message like others: its
    digest is null. A state with digests of another form cannot be gone on from. Drain it with UNIQUE_SETTINGS, and with
    batches that the disks can hold: all messages of a batch are shuffled.
    """
    digest = F.substring(F.unhex(F.sha2("value", 256)), 1, DIGEST_BYTES)
    arrived = events.withColumn("_arrived", F.current_timestamp()).withColumn("_digest", digest)
    return arrived.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_digest"]).select(*events.columns)


def join_in_time(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    earliest: str,
    latest: str,
    delay: str,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Pairs of two streams with equal keys whose times lie near: right between left + `earliest` and left + `latest`.

    `earliest` and `latest` are intervals such as "0 hours" and "1 day". Pairs are given out when the later of the two
    arrives. With `keep_unmatched`, a left row that found none is given out with nulls once the watermark, which
    both streams have to reach, has passed its time: after that no partner can come. Rows of both sides leave the
    state when no partner can come any more, so the state is bounded by the interval and the delay. A null key or time matches
    nothing. Columns but the keys must differ in name; keys are those of the left side.
    """
    ours, theirs = left.withWatermark(left_time, delay).alias("l"), right.withWatermark(right_time, delay).alias("r")
    near = " AND ".join(
        [
            *(f"l.`{key}` = r.`{key}`" for key in keys),
            f"r.`{right_time}` >= l.`{left_time}` + INTERVAL {earliest}",
            f"r.`{right_time}` <= l.`{left_time}` + INTERVAL {latest}",
        ]
    )
    joined = ours.join(theirs, F.expr(near), "leftOuter" if keep_unmatched else "inner")
    added = [F.col(f"r.{name}") for name in right.columns if name not in keys]
    return joined.select(*(F.col(f"l.{name}") for name in left.columns), *added)
