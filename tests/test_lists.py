from __future__ import annotations

import pytest

from reelhouse.operators import lists

SCHEMA = "id string, platform string, genres string, imdb_score double"
NAN = float("nan")
ROWS = [
    ("t1", "A", "drama, comedy, drama", 7.0), ("t2", "A", "drama", 5.0), ("t3", "A", "", 9.0), ("t4", "A", None, 9.0), ("t5", "B", "'GB', 'US'", None),
    ("t6", "A", " , drama,, ", NAN), ("t7", "B", "it's, O'Neil", 1.0), ("t1", "A", "drama, comedy, drama", 7.0), (None, None, "x", 2.0), ("t8", "B", "''", 3.0),
]


def test_values_keep_their_order_and_repeats(spark):
    rows = lists.list_rows(spark.createDataFrame(ROWS, SCHEMA), "genres")
    assert rows.columns == ["platform", "id", "position", "value"]
    found = {}
    for row in rows.collect():
        found.setdefault(row["id"], []).append((row["position"], row["value"]))
    assert sorted(found["t1"]) == [(1, "drama"), (1, "drama"), (2, "comedy"), (2, "comedy"), (3, "drama"), (3, "drama")]
    assert found["t5"] == [(1, "GB"), (2, "US")] and found["t6"] == [(1, "drama")]
    assert found["t7"] == [(1, "it's"), (2, "O'Neil")] and found[None] == [(1, "x")]
    assert not {"t3", "t4", "t8"} & set(found)


def test_rows_without_values_are_kept_on_demand(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    rows = lists.list_rows(frame, "genres", keep_empty=True)
    assert {(row["id"], row["position"], row["value"]) for row in rows.collect() if row["value"] is None} == {
        ("t3", None, None), ("t4", None, None), ("t8", None, None)
    }
    assert lists.list_rows(frame.limit(0), "genres", keep_empty=True).count() == 0


def test_a_title_counts_once_for_a_value(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    found = {row["value"]: tuple(row)[1:] for row in lists.summary_by_value(frame, "genres").collect()}
    assert found["drama"] == (4, 3, pytest.approx(19 / 3), pytest.approx(3.0))
    assert found["comedy"] == (2, 2, 7.0, 1.0) and found["GB"] == (1, 0, None, 0.5)
    assert sum(row[3] for row in found.values()) == pytest.approx(7)  # titles that have any value
    assert lists.summary_by_value(frame.limit(0), "genres", ["platform"]).count() == 0
    by_platform = lists.summary_by_value(frame, "genres", ["platform"]).collect()
    assert {(row["platform"], row["value"]) for row in by_platform if row["value"] == "x"} == {(None, "x")}


def test_nothing_is_shuffled_but_partial_sums(spark, folder):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{folder}/titles")
    titles = spark.read.parquet(f"{folder}/titles")
    text = lists.summary_by_value(titles, "genres")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("partial_count") >= 1
    assert "Exchange" not in lists.list_rows(titles, "genres")._jdf.queryExecution().executedPlan().toString()


def test_a_value_of_most_titles(spark):
    frame = spark.range(30_000).selectExpr("concat('t', id) AS id", "'A' AS platform", "concat('drama, g', id % 1000) AS genres", "1.5 AS imdb_score")
    found = {row["value"]: row["titles"] for row in lists.summary_by_value(frame, "genres").collect()}
    assert found["drama"] == 30_000 and found["g7"] == 30 and len(found) == 1001
