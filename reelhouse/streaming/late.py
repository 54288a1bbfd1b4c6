"""Late rows kept apart, so that stateful streams after it lose none.

A stateful operator drops rows older than its watermark without a trace. Here a stream is first dealt into two folders: rows
that are on time and rows that are late, by the largest time of all batches before. What reads the folder of
rows on time with the same delay, batch by batch or several at once, never has a watermark that one of them is below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelhouse.sinks.folders import subfolders

LATE, BATCH = "_late", "_batch"
# Files a task writes at once: two folders are all that a batch is dealt into.
WRITERS_SETTING, OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters", "2"


def start_split(stream: DataFrame, time: str, delay: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Deal what arrived since the checkpoint into rows on time and late ones, then end.

    A row is late if its time is more than `delay` (such as "2 days") before the largest time of the batches before its own;
    a row without time is late too, as no window can hold it. Within its own batch a row is never late. A batch that is repeated after a failure
    replaces its own rows, and is judged by the same batches before it, so every row lands once. Let readers of the
    folders begin when the split has ended.
    """

    def deal(batch: DataFrame, number: int) -> None:
        # the stream's own copy of the session: tasks write to both folders at once, without sorting their rows by folder
        batch.sparkSession.conf.set(WRITERS_SETTING, OPEN_WRITERS)
        seen = Observation()
        highest = _highest_before(batch.sparkSession, folder, number)
        bound = F.lit(highest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.col(time).isNull() | F.coalesce(F.col(time) < bound, F.lit(False))
        rows = batch.observe(seen, F.max(time).cast("string").alias("highest"))
        dealt = rows.withColumn(LATE, late.cast("int")).withColumn(BATCH, F.lit(number))
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LATE, BATCH)
        writer.parquet(f"{folder}/rows")
        mark = batch.sparkSession.createDataFrame([(seen.get["highest"],)], "highest string")
        mark.write.mode("overwrite").parquet(f"{folder}/highest/{BATCH}={number}")

    return (
        stream.writeStream.foreachBatch(deal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _highest_before(spark: SparkSession, folder: str, number: int) -> str | None:
    """The largest time of all batches before one, as text."""
    marks = f"{folder}/highest"
    if not any(place.rstrip("/").endswith(f"{BATCH}={before}") for place in subfolders(spark, marks) for before in range(number)):
        return None
    known = spark.read.schema(f"highest string, {BATCH} long").parquet(marks).where(F.col(BATCH) < number)
    return known.agg(F.max(F.col("highest").cast("timestamp")).cast("string")).first()[0]


def on_time(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows on time as a stream; all that has landed is one batch."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/rows/{LATE}=0")


def late_rows(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All late rows so far; none is no error."""
    if not any(place.rstrip("/").endswith(f"{LATE}=1") for place in subfolders(spark, f"{folder}/rows")):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/rows/{LATE}=1")
