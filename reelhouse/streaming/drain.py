"""Run-once streaming appends with checkpoint, resume and time limit."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


POLL_SECS = 0.1
# How often a job of the next batch is looked for past the time limit, and for how long at most.
JOB_POLL_SECS = 0.02
JOB_WAIT_SECS = 10


def start_drain(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> StreamingQuery:
    """Append everything that arrived since the checkpoint to a Parquet folder, then end.

    The available data is cut into batches by the source's own limits. Each batch commits
    as a whole through the checkpoint and the sink's commit log, so a lost executor, a
    stopped run or a rerun neither loses nor doubles rows.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.start()


def finish(query: StreamingQuery, timeout_secs: float | None = None) -> None:
    """Wait for a drain to end; past the time limit stop it after a committed batch and raise.

    The limit acts between batches: the first batch of a run is always waited for, so each run gets on by
    a batch at least, however short the limit. What was committed stays, and the next run goes on
    from the checkpoint. A batch is as large as the source's own limits allow, and a run may exceed its
    time by one. It is stopped while a job of the next batch runs: between batches the file source may have logged
    files that the query has not yet, and the next run would take them and a whole batch of others as one.
    """
    if timeout_secs is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_secs):
        # progress is reported once a batch has been committed
        while query.lastProgress is None:
            if query.awaitTermination(POLL_SECS):
                return
        waited_until = time.monotonic() + JOB_WAIT_SECS
        while not _job_runs(query) and time.monotonic() < waited_until:
            if query.awaitTermination(JOB_POLL_SECS):
                return
        query.stop()
        raise TimeoutError("stream did not drain within its time limit; rerun to continue")


def _job_runs(query: StreamingQuery) -> bool:
    """Whether Spark runs a job of the query; its jobs are grouped by the run's id.

    Of other queries, as those of Spark Connect, jobs are not known, and they are stopped without waiting.
    """
    if not isinstance(query, StreamingQuery):
        return True
    tracker = SparkSession.active().sparkContext.statusTracker()
    return not set(tracker.getJobIdsForGroup(str(query.runId))).isdisjoint(tracker.getActiveJobsIds())


def drain_all(starts: Iterable[Callable[[], StreamingQuery]], timeout_secs: float | None = None) -> None:
    """Run several drains side by side within one time limit.

    Past the limit each of them is still waited for until it has committed a batch, so a rerun of any gets on. If
    one fails, the others are stopped at once.
    """
    deadline = None if timeout_secs is None else time.monotonic() + timeout_secs
    queries: list[StreamingQuery] = []
    late: TimeoutError | None = None
    try:
        for start in starts:
            queries.append(start())
        for query in queries:
            try:
                finish(query, None if deadline is None else max(deadline - time.monotonic(), 0.001))
            except TimeoutError as error:
                late = late or error
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    if late:
        raise late
