from __future__ import annotations

import random

import pytest

from reelhouse.operators.network import persons_within

SCHEMA = "person_ID string, id string, platform string"


def brute_force(rows, start, steps):
    """Fewest steps to each person, level by level."""
    links = {(person, (title, platform)) for person, title, platform in rows if None not in (person, title, platform)}
    reached = dict.fromkeys((person for person in start if person is not None), 0)
    for step in range(1, steps + 1):
        titles = {title for person, title in links if person in reached}
        for person, title in links:
            if title in titles:
                reached.setdefault(person, step)
    return reached


def found(spark, rows, start, steps):
    frame = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(person,) for person in start], "person_id string")
    result = [tuple(row) for row in persons_within(frame, asked, steps).collect()]
    assert len(result) == len(dict(result))
    return dict(result)


@pytest.mark.parametrize("steps", [0, 1, 2, 4])
def test_steps_equal_brute_force(spark, steps):
    chance = random.Random(1)
    rows = [(f"p{chance.randrange(120)}", f"t{chance.randrange(150)}", chance.choice("AB")) for _ in range(260)]
    start = ["p1", "p2", "p1", None, "stranger"]
    assert found(spark, rows, start, steps) == brute_force(rows, start, steps)


def test_nulls_connect_nothing_and_empty_tables(spark):
    rows = [("p1", "t1", None), ("p2", "t1", None), ("p1", None, "A"), ("p2", None, "A"), (None, "t2", "A"), ("p1", "t2", "A")]
    assert found(spark, rows, ["p1"], 3) == {"p1": 0}
    assert found(spark, [], ["p1"], 2) == {"p1": 0}
    assert found(spark, rows, [], 2) == {}


def test_a_hub_title_is_opened_once(spark):
    """Three hub titles shared by all persons: paths of 6 steps would be 3 ** 6 * 400 ** 6."""
    rows = [(f"p{number}", f"hub{hub}", "A") for number in range(400) for hub in range(3)] + [("p399", "t", "A"), ("far", "t", "A")]
    assert found(spark, rows, ["p0"], 6) == {"p0": 0, "far": 2} | {f"p{number}": 1 for number in range(1, 400)}
