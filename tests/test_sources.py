"""CSV scan, bronze scan, event options, scratch folder."""

from __future__ import annotations

import csv
import io
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions.tagging import tag
from reelhouse.operators.combine import union_all
from reelhouse.session import scratch_path
from reelhouse.sinks import events as event_sink
from reelhouse.sources import events as event_source
from reelhouse.sources.bronze import read_bronze
from reelhouse.sources.csv import RAW_RECORD, _unfinished_lines, has_split_records, read_csv
from reelhouse.sources.errors import MissingInput

COLUMNS = {"id": "string", "title": "string", "seasons": "int", "imdb_score": "float"}


def write(folder, text, name="data.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as file:
        file.write(text)


def test_columns_are_matched_by_name(spark, folder):
    write(folder, "title,extra,id,imdb_score\nA,x,t1,7.5\n")
    scan = read_csv(spark, folder, COLUMNS)
    assert scan.dtypes == list(COLUMNS.items())
    assert [tuple(row) for row in scan.collect()] == [("t1", "A", None, 7.5)]


def test_quoted_commas_quotes_and_line_breaks(spark, folder):
    write(folder, 'id,title,seasons,imdb_score\nt1,"a, ""b""\nc",2,\nt2,"",,1.5\n')
    rows = sorted(tuple(row) for row in read_csv(spark, folder, COLUMNS).collect())
    assert rows == [("t1", 'a, "b"\nc', 2, None), ("t2", None, None, 1.5)]


def test_line_ends_backslashes_and_marks(spark, folder):
    write(f"{folder}/lf", 'id,title,seasons,imdb_score\nt1,"a\r\nb\\",1,2\nNA,#x,1,2\n')
    rows = {row.id: row.title for row in read_csv(spark, f"{folder}/lf", COLUMNS).collect()}
    assert rows == {"t1": "a\r\nb\\", "NA": "#x"}
    # Where lines end in CR LF, a CR LF inside a field is read as LF.
    write(f"{folder}/crlf", 'id,title,seasons,imdb_score\r\nt1,"a\r\nb",1,2\r\n')
    row = read_csv(spark, f"{folder}/crlf", COLUMNS).first()
    assert (row.id, row.title, row.imdb_score) == ("t1", "a\nb", 2.0)


def test_bad_number_is_null_and_the_row_stays(spark, folder):
    write(folder, "id,title,seasons,imdb_score\nt1,A,2.0,x\n")
    assert [tuple(row) for row in read_csv(spark, folder, COLUMNS).collect()] == [("t1", "A", None, None)]


def test_padding_is_kept(spark, folder):
    write(folder, "id,title,seasons,imdb_score\n t1 ,  A,1,2\n")
    row = read_csv(spark, folder, COLUMNS).first()
    assert (row.id, row.title) == (" t1 ", "  A")


def test_file_with_another_header_fails_the_scan(spark, folder):
    write(folder, "id,title,seasons,imdb_score\nt1,A,1,2\n", "a.csv")
    write(folder, "title,id,seasons,imdb_score\nB,t2,1,2\n", "b.csv")
    with pytest.raises(Py4JJavaError, match="header does not conform"):
        read_csv(spark, folder, COLUMNS).collect()


def test_single_line_files_read_the_same_either_way(spark, folder):
    write(folder, 'id,title,seasons,imdb_score\nt1,"a, b",1,2\nt2,,3,\n')
    whole = read_csv(spark, folder, COLUMNS, multi_line=True).collect()
    assert read_csv(spark, folder, COLUMNS, multi_line=False).collect() == whole
    assert read_csv(spark, folder, COLUMNS).collect() == whole


@pytest.mark.parametrize(
    "text, split",
    [
        ("a,b\n1,2\n", False),
        ('"a","b"\n"1, ""x""","",""\n', False),
        ('a,b\r\n"1",2\r\n', False),
        ('a,b\n"1\n2",3\n', True),
        ('a,b\n"1""\n2",3\n', True),
        # stray quotes that even out per line, around a field that goes on
        ('a,b\ndisk 5","x\ny",6" z\n', True),
        ('a,b\n5" disk,2\n', True),
    ],
)
def test_records_that_span_lines_are_found(spark, folder, text, split):
    write(folder, text)
    assert has_split_records(spark, folder) is split


def test_only_unfinished_lines_leave_the_scan(spark, folder):
    """Not a row per line or file: whole records, with quotes or without, are dropped where they are read."""
    write(folder, 'a,b\n1,2\n"1, ""x""",""\n', "whole.csv")
    write(folder, 'a,b\n1,2\n"1\n2",3\n', "split.csv")
    found = [row["file_path"] for row in _unfinished_lines(spark, folder).collect()]
    assert len(found) == 2 and all(path.endswith("/split.csv") for path in found)


cells = st.text(alphabet='ab", \n\\#', max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(cells, cells), min_size=1, max_size=8))
def test_any_text_survives(spark, rows):
    with tempfile.TemporaryDirectory() as folder:
        text = io.StringIO()
        writer = csv.writer(text, lineterminator="\n")
        writer.writerow(["id", "title", "seasons"])
        writer.writerows((first, second, 1) for first, second in rows)
        write(folder, text.getvalue())
        found = read_csv(spark, folder, {"id": "string", "title": "string", "seasons": "int"}).collect()
        assert [tuple(row) for row in found] == [(first or None, second or None, 1) for first, second in rows]


def test_large_file_is_split_only_where_no_record_spans_lines(spark, folder):
    body = "".join(f"t{number},some title {number},{number},1.5\n" for number in range(400_000))
    write(f"{folder}/plain", "id,title,seasons,imdb_score\n" + body)
    write(f"{folder}/spanning", "id,title,seasons,imdb_score\n" + body + 'last,"a\nb",1,2\n')

    def rows_and_tasks(path):
        placed = read_csv(spark, path, COLUMNS).select("id", F.spark_partition_id().alias("task"))
        return tuple(placed.agg(F.count("*"), F.countDistinct("task")).first())

    plain, spanning = rows_and_tasks(f"{folder}/plain"), rows_and_tasks(f"{folder}/spanning")
    assert plain[0] == 400_000 and plain[1] > 1
    assert spanning == (400_001, 1)


def test_one_file_with_a_spanning_record_leaves_the_others_split(spark, folder):
    body = "".join(f"t{number},some title {number},{number},1.5\n" for number in range(400_000))
    write(f"{folder}", "id,title,seasons,imdb_score\n" + body, "a b%.csv")
    write(f"{folder}", 'id,title,seasons,imdb_score\nlast,"a\nb",1,2\n5" disk,x,1,2\n', "b.csv")
    placed = read_csv(spark, folder, COLUMNS).select("id", "title", F.spark_partition_id().alias("task"))
    assert tuple(placed.where("id like 't%'").agg(F.count("*"), F.countDistinct("task") > 1).first()) == (400_000, True)
    assert {row.title for row in placed.where("id not like 't%'").collect()} == {"a\nb", "x"}


def test_missing_required_column_raises(spark, folder):
    write(folder, "id,name\nt1,A\n")
    with pytest.raises(MissingInput, match="person_ID"):
        read_csv(spark, folder, {"person_ID": "string", "id": "string"}, required=["person_ID", "id"])
    assert read_csv(spark, folder, {"person_ID": "string", "id": "string"}, required=["id"]).first().person_ID is None


def test_text_of_records_that_do_not_parse_is_kept(spark, folder):
    write(folder, "id,title,seasons,imdb_score\nt1,A,2.0,7\nt2,B,2,7\nt3,C,,bad\n")
    rows = {row.id: (row.seasons, row[RAW_RECORD]) for row in read_csv(spark, folder, COLUMNS, keep_raw=True).collect()}
    assert rows == {"t1": (None, "t1,A,2.0,7"), "t2": (2, None), "t3": (None, "t3,C,,bad")}


def test_file_without_a_header_raises(spark, folder):
    write(folder, "")
    with pytest.raises(MissingInput, match="no header row"):
        read_csv(spark, folder, COLUMNS)


def test_only_needed_columns_are_read(spark, folder):
    write(folder, "id,title,seasons,imdb_score,extra\nt1,A,1,2,x\n")
    plan = read_csv(spark, folder, COLUMNS).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan


def test_tag_and_union(spark):
    part = spark.createDataFrame([("t1",)], "id string")
    rows = union_all(tag(part, platform, "2024-01-01 00:00:00") for platform in schemas.PLATFORMS).collect()
    assert {row.platform for row in rows} == set(schemas.PLATFORMS)
    assert {row.ingestion_timestamp for row in rows} == {"2024-01-01 00:00:00"}


def test_tag_uses_the_current_time_as_text(spark):
    row = tag(spark.createDataFrame([("t1",)], "id string"), "Hulu").first()
    assert len(row.ingestion_timestamp) == 19 and row.ingestion_timestamp[10] == " "


def test_missing_bronze_raises_and_creates_nothing(spark, folder):
    path = f"{folder}/absent"
    with pytest.raises(MissingInput, match="no bronze data"):
        read_bronze(spark, path, schemas.TITLES)
    assert not os.path.exists(path)


def test_empty_bronze_folder_raises(spark, folder):
    with pytest.raises(MissingInput, match="no bronze data"):
        read_bronze(spark, folder, schemas.TITLES)


def test_bronze_without_a_column_raises(spark, folder):
    spark.createDataFrame([("t1",)], "id string").write.parquet(f"{folder}/bronze")
    with pytest.raises(MissingInput, match="title"):
        read_bronze(spark, f"{folder}/bronze", schemas.TITLES)


def test_kafka_options():
    source = event_source.kafka_options("b1:9092", schemas.TITLES_TOPIC, max_offsets_per_trigger=1000, min_partitions=64)
    assert source == {
        "kafka.bootstrap.servers": "b1:9092",
        "subscribe": "ott_titles",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }
    assert event_sink.kafka_options("b1:9092", schemas.CREDITS_TOPIC) == {
        "kafka.bootstrap.servers": "b1:9092",
        "kafka.acks": "all",
        "topic": "ott_credits",
    }


class Recorder:
    """Stands in for a reader or writer whose connector is not here."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*arguments, **options):
            self.calls[name] = options or arguments
            return self

        return call

    # a session's readStream and a frame's write are attributes, not calls
    readStream = write = property(lambda self: self)


def test_kafka_source_and_sink_pass_their_options_on():
    source = Recorder()
    event_source.from_kafka(source, "b1:9092", "t", max_offsets_per_trigger=5)
    assert source.calls["format"] == ("kafka",)
    assert source.calls["options"] == event_source.kafka_options("b1:9092", "t", max_offsets_per_trigger=5)
    assert source.calls["select"] == ("value",)
    sink = Recorder()
    event_sink.to_kafka(sink, "b1:9092", "t")
    assert sink.calls["select"] == ("value",) and sink.calls["format"] == ("kafka",)
    assert sink.calls["options"] == event_sink.kafka_options("b1:9092", "t")


def test_scratch_folder_follows_the_session(spark):
    one, other = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != other
    assert one.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
