from __future__ import annotations

import datetime
import time

import pytest
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions import codec
from reelhouse.plans.bronze import land_topics
from reelhouse.plans.lake import Lake
from reelhouse.registry import analysis_queries, inputs
from reelhouse.session import settings
from reelhouse.sinks import events
from reelhouse.sinks.events import to_folder
from reelhouse.sinks.folders import remove_folder
from reelhouse.sources.bronze import read_bronze
from reelhouse.sources.events import from_folder
from reelhouse.streaming import late, stateful
from reelhouse.streaming.drain import finish, start_drain

EVENTS = "k string, ts timestamp, v int"


def at(hour, minute=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour, minutes=minute)


def deliver(spark, rows, path, schema=EVENTS, files=1):
    spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(path)


class Windows:
    """Hourly counts with a delay of two hours, over deliveries one after the other."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def drain(self, rows=()):
        if rows:
            deliver(self.spark, rows, f"{self.folder}/landing", files=2)
        landed = self.spark.readStream.schema(EVENTS).parquet(f"{self.folder}/landing")
        finish(late.start_split(landed, "ts", "2 hours", f"{self.folder}/dealt", f"{self.folder}/split"))
        self.count()

    def count(self):
        windows = stateful.event_windows(
            late.on_time(self.spark, f"{self.folder}/dealt", EVENTS), "ts", "1 hour", "2 hours", ["k"], [F.count("*").alias("n"), F.sum("v").alias("v")]
        )
        query = stateful.start_windows(windows, f"{self.folder}/windows", f"{self.folder}/state")
        finish(query)
        self.progress = query.lastProgress

    def closed(self):
        rows = self.spark.read.parquet(f"{self.folder}/windows").collect()
        assert len(rows) == len({(row["window_start"], row["k"]) for row in rows})
        return {(row["window_start"].hour, row["k"]): (row["n"], row["v"]) for row in rows}

    def late(self):
        return sorted((row["k"], row["ts"], row["v"]) for row in late.late_rows(self.spark, f"{self.folder}/dealt", EVENTS).where("ts IS NOT NULL").collect())


def test_windows_close_once_and_late_rows_are_kept(spark, folder):
    windows = Windows(spark, folder)
    windows.drain([("a", at(0, 5), 1), ("a", at(0, 50), 2), ("b", at(3, 30), 3), (None, at(0, 1), 9), ("a", None, 7)])
    assert windows.closed() == {(0, "a"): (2, 3), (0, None): (1, 9)} and windows.late() == []
    # out of order, but not late: the watermark is at 1:30
    windows.drain([("a", at(1, 45), 4), ("a", at(1, 10), 5), ("a", at(0, 20), 6), ("b", at(6), 1)])
    assert windows.late() == [("a", at(0, 20), 6), ("a", at(1, 10), 5)]
    assert windows.closed() == {(0, "a"): (2, 3), (0, None): (1, 9), (1, "a"): (1, 4), (3, "b"): (1, 3)}
    # nothing new, then the rest
    windows.drain()
    windows.drain([("b", at(5, 59), 10), ("c", at(20), 1)])
    assert windows.closed()[(5, "b")] == (1, 10) and windows.closed()[(6, "b")] == (1, 1) and len(windows.late()) == 2
    undated = late.late_rows(spark, f"{folder}/dealt", EVENTS).where("ts IS NULL").collect()
    assert [row["v"] for row in undated] == [7]
    everything = sum(n for n, _ in windows.closed().values()) + len(windows.late()) + len(undated)
    assert everything == 11 - 1  # the last window is open
    assert sum(each.numRowsTotal for each in windows.progress.stateOperators) == 1


def test_a_batch_that_is_repeated_lands_once(spark, folder):
    """The split fails after it has written a batch; the rerun replaces what it wrote."""
    rows = [("a", at(0, 5), 1), ("b", at(5), 2)]
    windows = Windows(spark, folder)
    windows.drain(rows)
    deliver(spark, [("a", at(1), 3), ("a", at(6), 4)], f"{folder}/landing")
    landed = spark.readStream.schema(EVENTS).parquet(f"{folder}/landing")
    finish(late.start_split(landed, "ts", "2 hours", f"{folder}/dealt", f"{folder}/split"))
    first = sorted(map(tuple, spark.read.parquet(f"{folder}/dealt/rows").collect()), key=repr)
    remove_folder(spark, f"{folder}/split/commits/1")
    finish(late.start_split(landed, "ts", "2 hours", f"{folder}/dealt", f"{folder}/split"))
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/dealt/rows").collect()), key=repr) == first and len(first) == 4
    assert windows.late() == [("a", at(1), 3)]


def test_several_dealt_batches_at_once_lose_nothing(spark, folder):
    """The windows fall behind by three batches; none of the rows on time is dropped by their watermark."""
    windows = Windows(spark, folder)
    windows.drain([("a", at(0), 1)])
    for hour in (4, 8, 12):
        deliver(spark, [("a", at(hour), 1), ("a", at(hour - 5, 59), 1), ("a", at(hour - 3, 30), 1)], f"{folder}/landing", files=3)
        landed = spark.readStream.schema(EVENTS).parquet(f"{folder}/landing")
        finish(late.start_split(landed, "ts", "2 hours", f"{folder}/dealt", f"{folder}/split"))
    deliver(spark, [("z", at(40), 1)], f"{folder}/landing")
    windows.drain()
    on_time = spark.read.parquet(f"{folder}/dealt/rows").where("_late = 0 AND k = 'a'").count()
    assert on_time + len(windows.late()) == 10 and sum(n for n, _ in windows.closed().values()) == on_time


def test_the_split_writes_both_folders_without_a_sort(spark, folder, monkeypatch):
    """Its setting for that is the stream's own; the caller's session keeps what it had."""
    given, seen, looked = spark.conf.get(late.WRITERS_SETTING), [], late._highest_before

    def recorded(session, *rest):
        seen.append(session.conf.get(late.WRITERS_SETTING))
        return looked(session, *rest)

    monkeypatch.setattr(late, "_highest_before", recorded)
    windows = Windows(spark, folder)
    windows.drain([("a", at(0), 1), ("a", at(9), 1)])
    windows.drain([("a", at(1), 2), ("a", at(8), 3), ("a", None, 4), ("a", at(2), 5), ("a", at(10), 6)])
    assert seen == ["2", "2"] and spark.conf.get(late.WRITERS_SETTING) == given
    assert {row["v"] for row in late.late_rows(spark, f"{folder}/dealt", EVENTS).collect()} == {2, 4, 5}
    assert {row["v"] for row in spark.read.parquet(f"{folder}/dealt/rows/_late=0").collect()} == {1, 3, 6}


def test_the_joined_streams_store_only_what_they_deliver(spark, sf_dir, monkeypatch):
    stored, kept = [], analysis_queries._kept
    monkeypatch.setattr(analysis_queries, "_kept", lambda df: stored.append(df.columns) or kept(df))
    rows = analysis_queries.stream_join(False, spark, sf_dir)
    assert stored == [["id", "platform", "title", "title_time"], ["id", "platform", "person_ID", "role", "credit_time"]]
    assert rows.columns == ["id", "platform", "title", "person_ID", "role"]


def test_no_late_rows_is_no_error(spark, folder):
    windows = Windows(spark, folder)
    windows.drain([("a", at(0), 1)])
    assert late.late_rows(spark, f"{folder}/dealt", EVENTS).count() == 0


# --- redelivered messages


def unique(spark, folder, within):
    events = stateful.unique_events(from_folder(spark, f"{folder}/landing"), within)
    query = start_drain(events, f"{folder}/out", f"{folder}/state")
    finish(query)
    return query


def test_redelivered_messages_land_once(spark, folder):
    rows = spark.createDataFrame([(f"t{number % 30}", number % 3) for number in range(90)], "id string, n int")
    for _ in range(3):
        to_folder(codec.encode(rows).repartition(2), f"{folder}/landing")
        unique(spark, folder, "1 hour")
    landed = codec.decode(spark.read.parquet(f"{folder}/out"), {"id": "string", "n": "int"})
    assert sorted(map(tuple, landed.collect())) == sorted(set(map(tuple, rows.collect())))


def test_null_and_empty_messages_are_messages(spark, folder):
    spark.createDataFrame([(None,), (None,), (b"",), (b"",), (b"x",)], "value binary").write.parquet(f"{folder}/landing")
    unique(spark, folder, "1 hour")
    assert sorted((row["value"] for row in spark.read.parquet(f"{folder}/out").collect()), key=repr) == sorted([None, b"", b"x"], key=repr)


def test_a_message_takes_a_short_digest_in_the_state(spark, folder):
    """What is shuffled and kept beside a message is small, and differs between messages; null has a row of its own."""
    values = [(f"message {number}".encode(),) for number in range(500)] * 2 + [(None,), (b"",), (None,)]
    spark.createDataFrame(values, "value binary").write.parquet(f"{folder}/landing")
    unique(spark, folder, "1 hour")
    held = spark.read.format("statestore").load(f"{folder}/state").select("key.*").collect()
    assert len(held) == 502 and len(set(map(tuple, held))) == 502
    assert sorted({sum(len(each) for each in row if isinstance(each, (str, bytes, bytearray))) for row in held}) == [0, 16]


def test_the_state_is_bounded_by_time(spark, folder):
    """What arrived longer ago than the time is dropped; a message that comes again after it passes again."""
    held = []
    for number in range(3):
        values = [(f"{number} {each}".encode(),) for each in range(50)] + [(b"again",)]
        spark.createDataFrame(values, "value binary").write.mode("append").parquet(f"{folder}/landing")
        progress = unique(spark, folder, "1 second").lastProgress
        held.append(sum(each.numRowsTotal for each in progress.stateOperators))
        time.sleep(2.5)
    assert max(held) <= 2 * 51
    assert held[-1] < 3 * 50
    landed = [row["value"] for row in spark.read.parquet(f"{folder}/out").collect()]
    assert len(set(landed)) == 151 and landed.count(b"again") >= 2


def test_the_bronze_job_lands_redelivered_messages_once(spark, sf_dir, folder):
    """Both topics delivered twice, in two runs; without the option everything lands twice."""
    rows = {schemas.TITLES_TOPIC: inputs.bronze_titles(spark, sf_dir), schemas.CREDITS_TOPIC: inputs.bronze_credits(spark, sf_dir)}
    receive = lambda session, topic: from_folder(session, f"{folder}/{topic}")
    lakes = {"1 day": Lake(f"{folder}/unique"), None: Lake(f"{folder}/all")}
    for _ in range(2):
        for topic, df in rows.items():
            to_folder(codec.encode(df), f"{folder}/{topic}")
        for within, lake in lakes.items():
            land_topics(spark, receive, lake, keep_rejects=True, unique_within=within)
    for topic, columns, place in ((schemas.TITLES_TOPIC, schemas.TITLES, "titles"), (schemas.CREDITS_TOPIC, schemas.CREDITS, "credits")):
        landed = {within: read_bronze(spark, getattr(lake, place), columns) for within, lake in lakes.items()}
        assert sorted(map(repr, landed["1 day"].collect())) == sorted(map(repr, rows[topic].distinct().collect()))
        assert landed[None].count() == 2 * rows[topic].count()


def shuffled_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(each).getName() for each in range(files.size()) if files.apply(each).getName().startswith("shuffle_")}


def test_a_drain_leaves_nothing_shuffled_and_its_state_on_disk(spark, folder):
    """Each batch removes what it dealt; the session has its own settings again afterwards, even if the drain fails."""
    given = {key: spark.conf.get(key, None) for key in stateful.UNIQUE_SETTINGS}
    for delivery in range(2):
        rows = [(f"message {number}".encode(),) for number in range(500 * delivery, 500 * delivery + 1000)]
        spark.createDataFrame(rows, "value binary").repartition(3).write.mode("append").parquet(f"{folder}/landing")
        before = shuffled_files(spark)
        with settings(spark, stateful.UNIQUE_SETTINGS):
            arrived = from_folder(spark, f"{folder}/landing", max_bytes_per_trigger=1)
            query = start_drain(stateful.unique_events(arrived, "1 hour"), f"{folder}/out", f"{folder}/state")
            finish(query)
        assert query.lastProgress.batchId == 3 * delivery + 2
        assert shuffled_files(spark) <= before
        assert query.lastProgress.stateOperators[0].customMetrics["rocksdbPutCount"] > 0
    assert spark.read.parquet(f"{folder}/out").distinct().count() == spark.read.parquet(f"{folder}/out").count() == 1500
    with pytest.raises(ZeroDivisionError), settings(spark, stateful.UNIQUE_SETTINGS):
        raise ZeroDivisionError
    assert {key: spark.conf.get(key, None) for key in stateful.UNIQUE_SETTINGS} == given


def test_a_checkpoint_with_its_state_in_memory_goes_on(spark, folder):
    """A drain begun without the settings is gone on from with them, and the other way round."""
    for delivery, values in enumerate((stateful.UNIQUE_SETTINGS, {}, stateful.UNIQUE_SETTINGS)):
        for first in ("memory", "disk"):
            rows = [(f"message {number}".encode(),) for number in range(50 * (delivery + 1))] + [(None,)]
            spark.createDataFrame(rows, "value binary").write.mode("append").parquet(f"{folder}/{first}/landing")
            with settings(spark, {} if delivery == 0 and first == "memory" else values):
                unique(spark, f"{folder}/{first}", "1 hour")
    for first in ("memory", "disk"):
        assert spark.read.parquet(f"{folder}/{first}/out").count() == 151


def test_unique_events_are_drained_in_bounded_batches_with_their_settings(spark, sf_dir, monkeypatch):
    """The query's two drains, of some batches each, both with their state on disk."""
    seen, finished = [], analysis_queries.finish

    def recorded(query):
        finished(query)
        seen.append((query.lastProgress.batchId, "rocksdbPutCount" in query.lastProgress.stateOperators[0].customMetrics))

    monkeypatch.setattr(analysis_queries, "finish", recorded)
    monkeypatch.setattr(analysis_queries, "UNIQUE_BATCH_BYTES", 1)
    rows = analysis_queries.stream_unique("credits", spark, sf_dir)
    assert [on_disk for _, on_disk in seen] == [True, True] and 0 < seen[0][0] < seen[1][0]
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, inputs.bronze_credits(spark, sf_dir).distinct().collect()))


def test_a_landed_file_is_read_in_parts(spark, folder, monkeypatch):
    monkeypatch.setattr(events, "ROW_GROUP_BYTES", 100_000)
    rows = spark.range(50_000).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("value"))
    to_folder(rows.coalesce(1), f"{folder}/landing")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "200k"}):
        parts = spark.read.parquet(f"{folder}/landing").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 4 and sum(part["count"] for part in parts) == 50_000


# --- two streams

TITLES, CREDITS = "id string, title string, t timestamp", "id string, person string, c timestamp"


class Joined:
    def __init__(self, spark, folder, keep):
        self.spark, self.folder, self.keep = spark, folder, keep

    def drain(self, titles=(), credits=()):
        streams = []
        for name, rows, time_column, schema in (("titles", titles, "t", TITLES), ("credits", credits, "c", CREDITS)):
            if rows:
                deliver(self.spark, rows, f"{self.folder}/{name}/landing", schema)
            landed = self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}/landing")
            finish(late.start_split(landed, time_column, "1 hour", f"{self.folder}/{name}", f"{self.folder}/{name}/split"))
            streams.append(late.on_time(self.spark, f"{self.folder}/{name}", schema))
        near = stateful.join_in_time(*streams, ["id"], "t", "c", "0 hours", "2 hours 30 minutes", "1 hour", self.keep)
        query = start_drain(near, f"{self.folder}/out", f"{self.folder}/state")
        finish(query)
        self.held = sum(each.numRowsTotal for each in query.lastProgress.stateOperators)

    def pairs(self):
        return sorted(((row["id"], row["title"], row["person"]) for row in self.spark.read.parquet(f"{self.folder}/out").collect()), key=repr)


@pytest.mark.parametrize("keep", [False, True])
def test_pairs_in_time_over_several_deliveries(spark, folder, keep):
    joined = Joined(spark, folder, keep)
    joined.drain(
        [("t1", "One", at(0)), ("t2", "Two", at(1)), (None, "None", at(1)), ("t3", "Three", at(3))],
        [("t1", "p1", at(1)), ("t1", "p2", at(3)), (None, "p3", at(1)), ("t2", "p4", at(0))],
    )
    assert joined.pairs() == [("t1", "One", "p1")]
    # a credit that follows later, and one whose title had come before
    joined.drain([("t4", "Four", at(6))], [("t3", "p5", at(5)), ("t3", "p5", at(5)), ("t9", "p6", at(6))])
    wanted = [("t1", "One", "p1"), ("t3", "Three", "p5"), ("t3", "Three", "p5")]
    assert [pair for pair in joined.pairs() if pair[2]] == wanted
    # time goes on: what found none is given out, and its state dropped
    joined.drain([("t5", "Five", at(30))], [("t0", "p0", at(30))])
    lone = sorted([("t2", "Two", None), (None, "None", None), ("t4", "Four", None)], key=repr) if keep else []
    assert joined.pairs() == sorted(wanted + lone, key=repr)
    assert joined.held <= 4
    # a late match: its title's state is gone; the credit is among the late rows and no pair
    joined.drain([], [("t4", "p7", at(7))])
    assert joined.pairs() == sorted(wanted + lone, key=repr)
    apart = late.late_rows(spark, f"{folder}/credits", CREDITS).collect()
    assert [(row["id"], row["person"]) for row in apart] == [("t4", "p7")]
