from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from reelhouse.operators.history import title_history
from reelhouse.operators.ranking import rank_in_groups

SCHEMA = "platform string, id string, snapshot_date date, tmdb_popularity double"
NAN = float("nan")


def day(number):
    return datetime.date(2024, 3, number)


def test_gaps_ties_and_missing_values(spark):
    rows = [
        ("A", "t1", day(1), 5.0), ("A", "t2", day(1), 5.0), ("A", "t3", day(1), NAN), ("A", "t4", day(1), None), ("B", "t1", day(1), 1.0),
        ("A", "t1", day(2), 4.0), ("A", "t2", day(2), 9.0), ("A", "t2", day(2), 3.0),  # written twice
        ("A", "t1", day(9), 8.0), ("A", "t3", day(9), 2.0), ("A", "t4", day(9), None),
    ]
    found = {(row["platform"], row["id"], row["snapshot_date"].day): row for row in title_history(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == 10
    ranks = {key: row["day_rank"] for key, row in found.items()}
    assert [ranks["A", f"t{n}", 1] for n in (1, 2, 3, 4)] == [1, 2, 3, 4] and ranks["B", "t1", 1] == 1
    assert ranks["A", "t2", 2] == 1 and ranks["A", "t1", 2] == 2 and ranks["A", "t4", 9] == 3
    last = found["A", "t1", 9]
    # the week up to the 9th begins on the 3rd
    assert (last["previous_day"], last["rank_change"], last["rolling_avg"], last["rolling_days"]) == (day(2), 1, 8.0, 1)
    second = found["A", "t1", 2]
    assert (second["rank_change"], second["rolling_avg"], second["rolling_days"]) == (-1, 4.5, 2)
    assert found["A", "t2", 2]["value"] == 9.0 and found["A", "t2", 2]["rolling_avg"] == 7.0
    assert (last["first_value"], last["last_value"]) == (5.0, 8.0)
    assert (found["A", "t3", 1]["first_value"], found["A", "t3", 1]["rolling_avg"], found["A", "t3", 1]["rolling_days"]) == (2.0, None, 0)
    assert found["A", "t4", 9]["last_value"] is None and found["A", "t3", 9]["previous_day"] == day(1)
    assert title_history(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ranks_of_a_group_with_most_rows_are_made_by_many_tasks(spark):
    frame = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 <> 0 THEN 'hot' WHEN id % 2 = 0 THEN concat('g', id % 40) END AS g", "(id * 7919) % 10007 AS v", "id"
    )
    ranked = rank_in_groups(frame, ["g"], [F.desc("v"), F.col("id")])
    groups = {}
    for row in ranked.collect():
        groups.setdefault(row["g"], []).append((row["rank"], -row["v"], row["id"]))
    assert sum(map(len, groups.values())) == 20_000 and len(groups["hot"]) > 13_000
    for rows in groups.values():
        rows.sort()
        assert [rank for rank, *_ in rows] == list(range(1, len(rows) + 1))
        assert [rest for _, *rest in rows] == sorted(rest for _, *rest in rows)
    text = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" not in text
    assert rank_in_groups(frame.limit(0), ["g"], [F.col("id")]).count() == 0
