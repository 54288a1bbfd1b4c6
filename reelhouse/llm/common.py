"""What several operators share: column pairs, checkpoints, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of 8 MB.

    Spark's own bound of 64 MB, held on both sides of each of several workers, is much beside an executor's
    heap where rows are whole texts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def id_and_text(df: DataFrame, id_col: str, text_col: str, text_name: str = "text") -> DataFrame:
    """Only the two columns an operator works on, under its own names; other columns cannot clash."""
    return df.select(
        df[id_col].cast("long").alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias(text_name)
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """Store a frame in the shared checkpoint folder, so that losing an executor repeats nothing before it.

    The folder is the session's `spark.checkpoint.dir`; only a local session without that
    setting gets one of its own. Spark removes the files when the frame is no longer referenced, if
    `spark.cleaner.referenceTracking.cleanCheckpoints` is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def parts_for(df: DataFrame) -> int:
    """The session's shuffle width, which the user sets by the size of the input."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def blocks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.Table]:
    """Merge or cut Arrow batches into tables of about `most_bytes` in one text column.

    A single longer row is a block of its own. Rows keep their order.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            rest = batch.slice(at)
            take, taken = _fitting(rest, column, most_bytes - size)
            if not take and not held:
                take, taken = 1, _bytes(rest.slice(0, 1), column)
            if take:
                held.append(rest.slice(0, take))
                size += taken
                at += take
            if size >= most_bytes or (at < batch.num_rows and held):
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _lengths(batch: pa.RecordBatch, column: str):
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)


def _bytes(batch: pa.RecordBatch, column: str) -> int:
    return int(_lengths(batch, column).sum())


def _fitting(batch: pa.RecordBatch, column: str, room: int) -> tuple[int, int]:
    """How many leading rows fit into `room` bytes, and their bytes."""
    ends = _lengths(batch, column).cumsum(dtype="int64")
    count = int(ends.searchsorted(room, side="right"))
    return count, int(ends[count - 1]) if count else 0


class BoundedCache(dict):
    """Computes what is missing; starts over when full, so a task's memory does not grow with its input.

    Long keys are computed each time: they seldom repeat, and would make the bound on entries no
    bound on bytes.
    """

    def __init__(self, compute, entries: int = 120_000, longest: int = 64) -> None:
        super().__init__()
        self.compute, self.entries, self.longest = compute, entries, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value
