from __future__ import annotations

import re

import pytest

from reelhouse.operators import joins

FACTS = "person_id string, id string, role string, platform string, character_name string"
TITLES = "id string, title string, show_type string, release_year int, platform string"
PERSONS = "person_ID string, name string"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def brute_force(facts, titles, persons, keep):
    """The joined rows, one for each fact."""
    last = lambda value: (value is None, value)
    found = []
    for fact in facts:
        same = [row for row in titles if None not in (fact[1], fact[3]) and (row[0], row[4]) == (fact[1], fact[3])]
        names = [name for person, name in persons if fact[0] is not None and person == fact[0]]
        if keep or (same and names):
            title = min(((row[1], row[2], row[3]) for row in same), key=lambda row: list(map(last, row))) if same else (None,) * 3
            found.append((*fact, *title, min(names, key=last) if names else None))
    return found


ODD_FACTS = [
    ("p1", "t1", "ACTOR", "A", "x"), ("p1", "t1", "ACTOR", "A", "x"), ("p2", "t1", None, "B", None), ("p3", "t9", "ACTOR", "A", "y"),
    (None, "t1", "ACTOR", "A", "z"), ("p1", None, "ACTOR", "A", "z"), ("p1", "t2", "ACTOR", None, "z"), (None, None, None, None, None),
    ("p4", "t2", "DIRECTOR", "A", ""),
]
ODD_TITLES = [
    ("t1", "One", "MOVIE", 2000, "A"), ("t1", "Another", "SHOW", None, "A"), ("t1", None, "MOVIE", 1990, "A"), ("t1", "B one", "MOVIE", 1, "B"),
    (None, "no id", "MOVIE", 2, "A"), ("t2", None, None, None, "A"), ("t2", "no platform", None, None, None),
]
ODD_PERSONS = [("p1", "Ann"), ("p1", "Anna"), ("p1", None), ("p2", None), (None, "nobody"), ("p4", "Zoe")]


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("most_bytes", [0, joins.BROADCAST_BYTES])
def test_no_fact_is_lost_or_multiplied(spark, keep, most_bytes):
    frames = [spark.createDataFrame(rows, kind) for rows, kind in ((ODD_FACTS, FACTS), (ODD_TITLES, TITLES), (ODD_PERSONS, PERSONS))]
    found = joins.star_join(*frames, keep_unmatched=keep, most_bytes=most_bytes)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute_force(ODD_FACTS, ODD_TITLES, ODD_PERSONS, keep)))
    empty = [frame.limit(0) for frame in frames]
    assert joins.star_join(empty[0], frames[1], frames[2], keep_unmatched=keep).count() == 0
    assert joins.star_join(frames[0], empty[1], empty[2], keep_unmatched=keep).count() == (len(ODD_FACTS) if keep else 0)


def test_duplicates_of_a_dimension_multiply_unless_made_unique(spark):
    facts, titles = spark.createDataFrame(ODD_FACTS, FACTS), spark.createDataFrame(ODD_TITLES, TITLES)
    keys = {"id": "id", "platform": "platform"}
    assert joins.lookup_join(facts, titles, keys, ["title"], keep_unmatched=False).count() == 3 * 3 + 1 + 1
    unique = joins.unique_rows(titles, ["id", "platform"])
    assert unique.columns == titles.columns
    assert joins.lookup_join(facts, unique, keys, ["title"], keep_unmatched=False).count() == 5


def test_the_size_decides_how_it_is_joined(spark):
    facts, titles = spark.createDataFrame(ODD_FACTS, FACTS), spark.createDataFrame(ODD_TITLES, TITLES)
    assert joins.measured_bytes(titles) == len(ODD_TITLES) * (16 + 8 * 5) + sum(
        len(value) for row in ODD_TITLES for value in row if isinstance(value, str)
    )
    assert joins.measured_bytes(titles.limit(0)) == 0
    keys = {"id": "id", "platform": "platform"}
    assert "BroadcastHashJoin" in plan(joins.lookup_join(facts, titles, keys, ["title"]))
    assert "SortMergeJoin" in plan(joins.lookup_join(facts, titles, keys, ["title"], most_bytes=10))


def test_a_title_with_a_third_of_all_credits_is_split(spark):
    """The plan after execution reads the large partition in several tasks."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        title = "CASE WHEN id % 3 = 0 THEN 't0' WHEN id % 3 = 1 THEN concat('t', id) END AS id"
        facts = spark.range(0, 120_000, 1, 8).selectExpr(
            "concat('p', id % 1000) AS person_id", title, "'ACTOR' AS role", "'A' AS platform", "repeat(md5(string(id)), 2) AS character_name"
        )
        titles = spark.range(2000).selectExpr("concat('t', id) AS id", "'A' AS platform", "concat('title ', id) AS title")
        joined = joins.lookup_join(facts, titles, {"id": "id", "platform": "platform"}, ["title"], most_bytes=0)
        rows = joined.collect()
        assert len(rows) == 120_000
        assert sum(row["title"] == "title 0" for row in rows) == 40_000
        assert re.search(r"SortMergeJoin\(skew=true\)", plan(joined))
        # facts without a key are spread as well: they are another third
        placed = joined.where("id IS NULL").selectExpr("spark_partition_id() AS part").groupBy("part").count().collect()
        assert len(placed) > 20 and max(row["count"] for row in placed) < 10_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_only_the_columns_asked_for_are_read(spark, folder):
    spark.createDataFrame(ODD_TITLES, TITLES).write.parquet(f"{folder}/titles")
    titles = spark.read.parquet(f"{folder}/titles")
    facts = spark.createDataFrame(ODD_FACTS, FACTS)
    text = plan(joins.lookup_join(facts, titles, {"id": "id", "platform": "platform"}, ["title"]))
    schemas = set(re.findall(r"ReadSchema: (\S+)", text))
    assert schemas == {"struct<id:string,title:string,platform:string>"}
