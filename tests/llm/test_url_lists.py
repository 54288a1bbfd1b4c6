from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import url_lists

CAPTURES, ENTRIES = "page_id long, url string, fetched_on date", "rule string, day date, action string"
START = dt.date(2024, 1, 1)


def day(number):
    return None if number is None else START + dt.timedelta(days=number)


def covers(rule, host, path):
    if "/" in rule:
        steps = [step.lower() for step in path.split("/") if step]
        return any(rule == f"{host}/" + "/".join(steps[:k]) for k in range(1, len(steps) + 1))
    return host == rule or host.endswith("." + rule)


def brute_force(captures, entries, split):
    """Each capture against every entry: the last one of each rule up to the day, then the longest rule."""
    order, found = {"drop": 0, "allow": 1, "block": 2}, []
    for number, url, fetched in captures:
        best = None
        if url is not None and fetched is not None and split(url):
            host, path = split(url)
            for rule in {rule for rule, *_ in entries if rule}:
                log = [
                    (when, order[action])
                    for other, when, action in entries
                    if other and other.lower() == rule.lower() and when and action in order and when <= fetched
                ]
                if log and max(log)[1] and covers(rule.lower(), host, path):
                    best = max(best or (0,), (len(rule), rule.lower(), ("", "allow", "block")[max(log)[1]]))
        found.append((number, url, fetched, best and best[1], best and best[2], not best or best[2] != "block"))
    return sorted(found, key=str)


def check(spark, captures, entries, split):
    got = url_lists.filter_urls(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES))
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(captures, entries, split)


def test_random_histories(spark):
    source = random.Random(8)
    hosts = ["a.com", "www.a.com", "b.a.com", "b.org", "x.y.b.org", "com"]
    rules = [*hosts, "a.com/en", "www.a.com/en/1", "B.org/EN"]
    entries = [
        (source.choice([*rules, None]), day(source.choice([*range(0, 60, 3), None])), source.choice(["block", "allow", "drop", "odd", None]))
        for _ in range(150)
    ]
    captures = []
    for number in range(400):
        host, path = source.choice(hosts), source.choice(["", "/", "/en", "/en/1/", "/EN/1/2", "/de"])
        captures.append((number, f"https://{host}{path}?q=/en", day(source.choice([*range(-3, 66), None]))))
    captures += captures[:20]

    def split(url):
        host, _, path = url.removeprefix("https://").partition("?")[0].partition("/")
        return host, "/" + path

    check(spark, captures, entries, split)


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("HTTP://User:pw@Www.Example.COM.:8080/A/b?x#y", "www.example.com", "/A/b"),
        ("https://h.org", "h.org", "/"),
        ("https://h.org?q=a/b", "h.org", "/"),
        ("no scheme", None, "/"),
        ("http:///path", None, "/path"),
        ("http://[::1]:80/a", "[::1]", "/a"),
        ("http://u@[FE80::A]/", "[fe80::a]", "/"),
        (None, None, None),
    ],
)
def test_url_parts(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(url_lists.url_host(F.col("url")), url_lists.url_path(F.col("url"))).first()
    assert row[0] == host and (path is None or host is None or row[1] == path)


def test_nulls_ties_and_odd_urls(spark):
    entries = [("a.com", day(5), "block"), ("a.com", day(5), "drop"), ("a.com", day(9), "drop"), (None, day(0), "block"), ("a.com", None, "block")]
    captures = [
        (1, None, day(6)), (2, "nonsense", day(6)), (3, "http://a.com/", None), (None, "http://a.com/", day(6)), (5, "http://a.com/", day(4)),
        (6, "http://a.com/" + "p/" * 5000, day(5)), (7, "http://a.com/", day(9)), (7, "http://a.com/", day(9)),
    ]
    check(spark, captures, entries, lambda url: ("a.com", "/") if url.startswith("http://a.com") else None)


def test_empty_tables_and_clashing_columns(spark):
    captures = spark.createDataFrame([(1, "http://a.com/", day(1), "x", 1)], CAPTURES + ", rule string, day int")
    entries = spark.createDataFrame([("a.com", day(0), "block", "u")], ENTRIES + ", url string")
    assert [row["kept"] for row in url_lists.filter_urls(captures, entries).collect()] == [False]
    assert [row["kept"] for row in url_lists.filter_urls(captures, entries.limit(0)).collect()] == [True]
    assert url_lists.filter_urls(captures.limit(0), entries).count() == 0


def test_intervals_are_disjoint(spark):
    entries = [("r", day(1), "block"), ("r", day(3), "allow"), ("r", day(7), "drop"), ("r", day(9), "block"), ("R", day(9), "allow")]
    rows = url_lists.intervals(spark.createDataFrame(entries, ENTRIES)).orderBy("since").collect()
    assert [(row["action"], row["since"].date(), row["until"].date()) for row in rows] == [
        ("block", day(1), day(3)), ("allow", day(3), day(7)), ("block", day(9), dt.date(9999, 12, 31)),
    ]


TIMED, TIMED_ENTRIES = "page_id long, url string, fetched_on timestamp", "rule string, day timestamp, action string"


def moment(number, hour=0, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute) + dt.timedelta(days=number)


def test_entries_count_from_their_own_time_on(spark):
    """A capture at nine is not judged by an entry of three in the afternoon of that day."""
    entries = [("a.com", moment(3, 15), "block"), ("a.com", moment(4, 8, 30), "drop"), ("[::1]", moment(0), "block")]
    times = [(moment(3, 9), True), (moment(3, 15), False), (moment(3, 14, 59), True), (moment(4, 8, 29), False), (moment(4, 8, 30), True)]
    captures = [(number, "http://a.com/x", time) for number, (time, _) in enumerate(times)] + [(99, "http://[::1]:80/", moment(1))]
    found = url_lists.filter_urls(spark.createDataFrame(captures, TIMED), spark.createDataFrame(entries, TIMED_ENTRIES)).collect()
    assert {row["page_id"]: row["kept"] for row in found} == {number: kept for number, (_, kept) in enumerate(times)} | {99: False}
    assert {row["fetched_on"] for row in found} == {time for *_, time in captures}


def test_a_rule_of_most_captures_lies_in_many_partitions(spark):
    """Questions take intervals that began in an earlier partition; all equals brute force."""
    source = random.Random(9)
    captures = [(number, f"http://{'hot' if number % 3 else f'h{number % 50}'}.com/", moment(number % 300, number % 24)) for number in range(3000)]
    entries = [("hot.com", moment(day, 12), source.choice(["block", "allow", "drop"])) for day in range(0, 300, 40)]
    entries += [(f"h{number}.com", moment(source.randrange(300), 5), "block") for number in range(0, 50, 3)]
    got = url_lists.filter_urls(spark.createDataFrame(captures, TIMED), spark.createDataFrame(entries, TIMED_ENTRIES))
    wanted = brute_force(captures, entries, lambda url: (url.removeprefix("http://").rstrip("/"), "/"))
    assert sorted(map(tuple, got.collect()), key=str) == wanted
    valid = url_lists.intervals(spark.createDataFrame(entries, TIMED_ENTRIES))
    asked = spark.createDataFrame([("hot.com", time) for *_, time in captures], "rule string, at timestamp").distinct()
    assert url_lists.active_rules(asked, valid).count() > 0
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
