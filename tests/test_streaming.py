"""Drains: resume, bounded batches, stray files, time limit, rejects."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelhouse import schemas
from reelhouse.functions.codec import encode
from reelhouse.plans.bronze import land_topics, start_bronze
from reelhouse.plans.lake import Lake
from reelhouse.registry import inputs, spark_queries
from reelhouse.sinks.events import to_folder
from reelhouse.sources.bronze import read_bronze
from reelhouse.sources.events import from_folder
from reelhouse.streaming.drain import drain_all, finish, start_drain


def drain(spark, folder, **limits):
    stream = from_folder(spark, f"{folder}/landing", **limits)
    finish(start_bronze(stream, schemas.TITLES, f"{folder}/bronze", f"{folder}/checkpoint"))
    return read_bronze(spark, f"{folder}/bronze", schemas.TITLES)


def test_rerun_adds_nothing_and_a_new_file_only_itself(spark, sf_dir, folder):
    titles = inputs.bronze_titles(spark, sf_dir)
    to_folder(encode(titles), f"{folder}/landing")
    first = drain(spark, folder).count()
    assert first == titles.count()
    assert drain(spark, folder).count() == first
    to_folder(encode(titles.where("release_year = 2000")), f"{folder}/landing")
    assert drain(spark, folder).count() == first + titles.where("release_year = 2000").count()


def test_a_windowed_backlog_lies_in_files_of_bounded_size(spark, folder, monkeypatch):
    """The files of the backlog grow in number with its rows, and its runs stay as many."""
    rows = spark.range(5000).selectExpr("cast(id AS string) AS person_ID", "concat('tm', id % 70) AS id", "'x' AS platform", *(
        f"cast(NULL AS string) AS {name}" for name in ("name", "character_name", "role", "ingestion_timestamp")
    )).select(*schemas.CREDITS)
    monkeypatch.setattr(spark_queries, "_bronze", lambda *_: rows)
    monkeypatch.setattr(spark_queries, "scratch_path", lambda _, label: f"{folder}/{label}")
    monkeypatch.setattr(spark_queries, "ROWS_PER_FILE", 500)
    landed = spark_queries.stream_window("credits", spark, "").collect()
    assert sorted(map(repr, landed)) == sorted(map(repr, rows.collect()))
    files = spark.read.parquet(f"{folder}/landing").groupBy("_metadata.file_path").count().collect()
    assert len(files) == 10 and max(row["count"] for row in files) <= 520
    assert len(list((Path(folder) / "checkpoint" / "commits").glob("[0-9]*"))) == 3


def test_bounded_batches_land_the_same_rows(spark, sf_dir, folder):
    titles = inputs.bronze_titles(spark, sf_dir)
    to_folder(encode(titles.repartition(5)), f"{folder}/landing")
    landed = drain(spark, folder, max_files_per_trigger=1)
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, titles.collect()))


def test_uncommitted_files_are_not_read(spark, sf_dir, folder):
    titles = inputs.bronze_titles(spark, sf_dir)
    to_folder(encode(titles), f"{folder}/landing")
    landed = drain(spark, folder).count()
    titles.write.mode("append").parquet(f"{folder}/stray")
    import glob
    import shutil

    for file in glob.glob(f"{folder}/stray/*.parquet"):
        shutil.copy(file, f"{folder}/bronze")
    assert read_bronze(spark, f"{folder}/bronze", schemas.TITLES).count() == landed


def test_bad_messages_are_null_rows_in_bronze_and_raw_text_in_rejects(spark, folder):
    for topic, lines in {
        schemas.TITLES_TOPIC: ['{"id":"a"}', "not json", '{"id":"b","runtime":"x"}'],
        schemas.CREDITS_TOPIC: ['{"id":"c"}'],
    }.items():
        rows = [(bytearray(line, "utf-8"),) for line in lines]
        to_folder(spark.createDataFrame(rows, "value binary"), f"{folder}/{topic}")
    lake = Lake(f"{folder}/lake")
    for _ in range(2):
        land_topics(spark, lambda session, topic: from_folder(session, f"{folder}/{topic}"), lake, keep_rejects=True)
    titles = read_bronze(spark, lake.titles, schemas.TITLES).collect()
    assert sorted((row.id or "", row.runtime) for row in titles) == [("", None), ("a", None), ("b", None)]
    bad = {row[0] for row in spark.read.parquet(lake.rejects(schemas.TITLES_TOPIC)).collect()}
    assert bad == {"not json", '{"id":"b","runtime":"x"}'}
    assert read_bronze(spark, lake.credits, schemas.CREDITS).count() == 1


class Endless:
    """A query that does not end in time, with a batch already committed."""

    lastProgress = {"batchId": 0}

    def __init__(self):
        self.isActive = True

    def awaitTermination(self, timeout=None):
        return False

    def stop(self):
        self.isActive = False


def test_time_limit_stops_the_stream_and_raises():
    query = Endless()
    with pytest.raises(TimeoutError, match="rerun"):
        finish(query, 1)
    assert not query.isActive


def test_failure_of_one_stream_stops_the_others():
    queries = [Endless(), Endless()]
    with pytest.raises(TimeoutError):
        drain_all([lambda: queries[0], lambda: queries[1]], 1)
    assert not any(query.isActive for query in queries)


def test_stream_that_cannot_start_stops_the_others():
    running = Endless()

    def broken():
        raise RuntimeError("no such topic")

    with pytest.raises(RuntimeError):
        drain_all([lambda: running, broken])
    assert not running.isActive


def test_interrupted_drain_goes_on_where_it_stopped(spark, sf_dir, folder):
    titles = inputs.bronze_titles(spark, sf_dir)
    to_folder(encode(titles.repartition(6)), f"{folder}/landing")
    stream = from_folder(spark, f"{folder}/landing", max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        finish(start_bronze(stream, schemas.TITLES, f"{folder}/bronze", f"{folder}/checkpoint"), 0.001)
    landed = drain(spark, folder, max_files_per_trigger=1)
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, titles.collect()))


def test_time_limit_stops_a_stream_while_a_job_of_its_next_batch_runs(spark, folder, monkeypatch):
    """Stopped between batches, the source may have logged files that the next run adds to a batch of its own."""
    to_folder(encode(spark.range(400).selectExpr("cast(id AS string) AS id").repartition(4)), f"{folder}/landing")
    slow = F.udf(lambda value: time.sleep(0.01) or value, "binary")
    tracker, at_stop, stop = spark.sparkContext.statusTracker(), [], StreamingQuery.stop

    def watched(query):
        at_stop.append(set(tracker.getJobIdsForGroup(str(query.runId))) & set(tracker.getActiveJobsIds()))
        stop(query)

    monkeypatch.setattr(StreamingQuery, "stop", watched)
    for _ in range(3):
        stream = from_folder(spark, f"{folder}/landing", max_files_per_trigger=1).select(slow("value").alias("value"))
        with pytest.raises(TimeoutError):
            finish(start_drain(stream, f"{folder}/out", f"{folder}/checkpoint"), 0.001)
    assert len(at_stop) == 3 and all(at_stop)
    assert len(list((Path(folder) / "checkpoint" / "commits").glob("[0-9]*"))) == 3


def test_time_limit_waits_for_the_first_batch():
    class Slow(Endless):
        waits = 0

        @property
        def lastProgress(self):
            return {"batchId": 0} if self.waits > 3 else None

        def awaitTermination(self, timeout=None):
            self.waits += 1
            return False

    query = Slow()
    with pytest.raises(TimeoutError):
        finish(query, 0.001)
    assert query.waits == 4 and not query.isActive


def test_time_limit_waits_for_the_first_batch_of_each_stream():
    class Slow(Endless):
        waits = 0

        @property
        def lastProgress(self):
            return {"batchId": 0} if self.waits > 5 else None

        def awaitTermination(self, timeout=None):
            self.waits += 1
            return False

    quick, slow = Endless(), Slow()
    with pytest.raises(TimeoutError):
        drain_all([lambda: quick, lambda: slow], 0.001)
    assert slow.waits == 6 and not quick.isActive and not slow.isActive


def test_failure_among_streams_is_not_waited_for():
    class Broken(Endless):
        def awaitTermination(self, timeout=None):
            raise RuntimeError("lost")

    broken, other = Broken(), Endless()
    with pytest.raises(RuntimeError, match="lost"):
        drain_all([lambda: broken, lambda: other], 1)
    assert not other.isActive


def test_two_streams_both_get_on_at_every_limited_run(spark, sf_dir, folder):
    """Each run commits a batch of both topics at least, however short the limit is."""
    rows = {schemas.TITLES_TOPIC: inputs.bronze_titles(spark, sf_dir), schemas.CREDITS_TOPIC: inputs.bronze_credits(spark, sf_dir)}
    for topic, df in rows.items():
        to_folder(encode(df).repartition(3), f"{folder}/{topic}")
    lake, seen = Lake(f"{folder}/lake"), []
    receive = lambda session, topic: from_folder(session, f"{folder}/{topic}", max_files_per_trigger=1)
    for _ in range(2):
        with pytest.raises(TimeoutError):
            land_topics(spark, receive, lake, 0.001)
        seen.append([spark.read.parquet(path).count() for path in (lake.titles, lake.credits)])
    assert all(before < after for before, after in zip(*seen)) and all(seen[0])


def test_limited_reruns_with_default_settings_drain_everything(spark, sf_dir, folder):
    """The limit is far below what the backlog takes, and every rerun gets on."""
    titles = inputs.bronze_titles(spark, sf_dir)
    to_folder(encode(titles.repartition(6)), f"{folder}/landing")
    lake = Lake(f"{folder}/lake")
    receive = lambda session, topic: from_folder(session, f"{folder}/landing")
    for _ in range(4):
        try:
            land_topics(spark, receive, lake, 0.001)
            break
        except TimeoutError:
            continue
    else:
        raise AssertionError("reruns did not drain the topics")
    landed = read_bronze(spark, lake.titles, schemas.TITLES)
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, titles.collect()))


def test_folder_batches_are_bounded_by_bytes(spark, sf_dir, folder, monkeypatch):
    titles = inputs.bronze_titles(spark, sf_dir)
    to_folder(encode(titles.repartition(5)), f"{folder}/landing")
    monkeypatch.setattr("reelhouse.sources.events.BATCH_BYTES", 1)
    query = start_bronze(from_folder(spark, f"{folder}/landing"), schemas.TITLES, f"{folder}/bronze", f"{folder}/checkpoint")
    finish(query)
    assert query.lastProgress["batchId"] == 4
