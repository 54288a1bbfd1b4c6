from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import summaries

SCHEMA = "platform string, release_year int, age_certification string, imdb_score double"
ROWS = [("A", 2000, "R", 5.0), ("A", 2000, None, 7.0), ("A", None, "R", 3.0), (None, None, None, 1.0), ("B", 2000, "R", None), ("B", 2000, "R", None)]
MEASURES = [("titles", lambda rows: len(rows)), ("score", lambda rows: round(sum((r[3] for r in rows if r[3] is not None), 0.0), 6))]


def brute_force(sets):
    found = []
    for kept in sets:
        groups = {}
        for row in ROWS:
            groups.setdefault(tuple(row[place] if place in kept else None for place in range(3)), []).append(row)
        if not kept and not groups:
            groups[(None, None, None)] = []
        flags = tuple(0 if place in kept else 1 for place in range(3))
        found += [(*key, *flags, *(measure(rows) for _, measure in MEASURES)) for key, rows in groups.items()]
    return sorted(map(repr, found))


def summed(df, sets):
    measures = [F.count("*").alias("titles"), F.round(F.coalesce(F.sum("imdb_score"), F.lit(0.0)), 6).alias("score")]
    return summaries.subtotals(df, measures, sets=sets)


@pytest.mark.parametrize(
    "sets, places",
    [
        ("cube", [[], [0], [1], [2], [0, 1], [0, 2], [1, 2], [0, 1, 2]]),
        ("rollup", [[], [0], [0, 1], [0, 1, 2]]),
        ([["platform"], ["release_year", "age_certification"], []], [[0], [1, 2], []]),
    ],
)
def test_nulls_of_the_data_are_told_from_totals(spark, sets, places):
    found = summed(spark.createDataFrame(ROWS, SCHEMA), sets)
    assert sorted(map(repr, map(tuple, found.collect()))) == brute_force(places)
    assert "Expand" in found._jdf.queryExecution().executedPlan().toString()


def test_unknown_dimensions_and_empty_tables(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError, match="genre"):
        summed(frame, [["genre"]])
    assert [row["titles"] for row in summed(frame.limit(0), "cube").collect()] in ([0], [])


def test_distinct_counts_ignore_nulls_and_repeats(spark):
    rows = [("A", "p1", "t1"), ("A", "p1", "t2"), ("A", None, "t2"), (None, "p1", None), ("B", None, None)]
    frame = spark.createDataFrame(rows, "platform string, person string, title string")
    found = summaries.distinct_counts(frame, ["platform"], ["person", "title"])
    assert {tuple(row) for row in found.collect()} == {("A", 1, 2), (None, 1, 0), ("B", 0, 0)}
    assert "Expand" in found._jdf.queryExecution().executedPlan().toString()


def test_merged_sketches_are_those_of_all_rows(spark, folder):
    """Days that overlap, one of them with a third of all rows in one group."""
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 5) END AS platform", "id % 7 AS day", "concat('p', (id * 7919) % 20011) AS person"
    )
    exact = {row["platform"]: row["distinct_person"] for row in summaries.distinct_counts(rows, ["platform"], ["person"]).collect()}
    summaries.distinct_sketches(rows, ["platform", "day"], ["person"]).write.partitionBy("day").parquet(f"{folder}/sketches")
    stored = spark.read.parquet(f"{folder}/sketches")
    assert stored.select(F.max(F.length("person"))).first()[0] < 3 * 2**summaries.SKETCH_BITS
    merged = summaries.sketched_counts(summaries.merged_sketches(stored, ["platform"], ["person"]), ["platform"], ["person"])
    whole = summaries.sketched_counts(summaries.distinct_sketches(rows, ["platform"], ["person"]), ["platform"], ["person"])
    estimates = {row["platform"]: row["distinct_person"] for row in merged.collect()}
    assert estimates.keys() == exact.keys()
    for platform, count in exact.items():
        assert abs(estimates[platform] - count) <= 4 * 1.04 / 64 * count
    apart = {row["platform"]: row["distinct_person"] for row in whole.collect()}
    assert all(abs(estimates[platform] - apart[platform]) <= 0.03 * apart[platform] for platform in apart)
    assert summaries.merged_sketches(stored.limit(0), ["platform"], ["person"]).count() == 0


def test_bounds_and_groups_with_null(spark):
    left = spark.createDataFrame([("A", 1000), (None, 5), ("C", 3)], "k string, distinct_p long")
    right = spark.createDataFrame([("A", 1500), (None, 5)], "k string, distinct_p long")
    found = summaries.differing_keys(
        left, right, ["k"], {"ok": summaries.within_error(F.col("left.distinct_p"), F.col("right.distinct_p"))}
    )
    assert {tuple(row) for row in found.collect()} == {("A", 0), (None, 1), ("C", 0)}
