from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from reelhouse.llm import fingerprints

SCHEMA = "doc_id long, left string, right string"


def paragraphs(text):
    return set(re.findall(r"\S+(?:[^\S\n]+\S+){0,31}", text or "", re.A))


def likeness(left, right):
    both = paragraphs(left) | paragraphs(right)
    return len(paragraphs(left) & paragraphs(right)) / len(both) if both else 1.0


def compared(spark, pairs):
    frame = spark.createDataFrame([(number, *pair) for number, pair in enumerate(pairs)], SCHEMA)
    digests = frame.select(
        "doc_id", fingerprints.digests(F.col("left")).alias("ours"), fingerprints.digests(F.col("right")).alias("theirs")
    )
    rows = fingerprints.compare(digests, "ours", "theirs", "result").orderBy("doc_id").collect()
    for row, (left, right) in zip(rows, pairs):
        ours, theirs = set(row["ours"]), set(row["theirs"])
        assert set(row["result"]["removed"]) == ours - theirs and set(row["result"]["added"]) == theirs - ours
        assert len(ours) == len(paragraphs(left)) and abs(row["result"]["near"] - likeness(left, right)) < 1e-12
    return [row["result"]["near"] for row in rows]


def test_differences_are_recovered_at_any_size(spark):
    source, pairs = random.Random(1), []
    for common, changed in ((0, 0), (0, 1), (1, 0), (30, 2), (5, 12), (100, 40), (10, 300), (2000, 3), (0, 1500)):
        shared = [f"line {number} {source.random()}" for number in range(common)]
        left, right = ([*shared, *(f"{side} {source.random()}" for _ in range(changed))] for side in "lr")
        source.shuffle(left)
        pairs.append(("\n".join(left), "\n".join(right)))
    assert compared(spark, pairs)[0] == 1.0


def test_odd_texts(spark):
    pairs = [
        (None, None), ("", None), ("a", None), ("a\na\na", "a"), ("\n\n \n", "  "), ("é 😀", "é 😀"), ("word " * 5000, "word " * 4999),
        ("x" * 100_000, "x" * 100_000), ("a b\tc", "a b\tc"),
    ]
    near = compared(spark, pairs)
    assert near[0] == near[1] == 1.0 and near[2] == 0.0 and near[3] == 1.0 and near[7] == 1.0


def test_subtracting_small_sketches_fails_and_larger_ones_succeed(spark):
    text = "\n".join(f"line {number}" for number in range(60))
    frame = spark.createDataFrame([(text,)], "text string").select(fingerprints.digests(F.col("text")).alias("found"))
    nothing = F.array().cast(f"array<{fingerprints.CELL}>")
    for size, empties in ((fingerprints.CELLS, False), (fingerprints.CELLS * fingerprints.GROWTH**2, True)):
        peeled = frame.select(
            "found",
            fingerprints.peel(
                fingerprints.subtract(fingerprints.sketch(F.col("found"), F.lit(size)), nothing), F.lit(size)
            ).alias("peeled"),
        ).first()
        assert (not peeled["peeled"]["cells"]) == empties
        if empties:
            assert {each["digest"] for each in peeled["peeled"]["found"]} == set(peeled["found"])


def test_equal_texts_have_equal_fingerprints(spark):
    frame = spark.createDataFrame(
        [(1, "a\nb", 0, "x"), (2, "a\nb", 1, "y"), (3, "a\nc", 2, "z"), (4, None, 3, ""), (5, "", 4, "")],
        "doc_id long, text string, sketch int, digests string",
    )
    found = {row["doc_id"]: row["fingerprint"] for row in fingerprints.fingerprint(frame).collect()}
    assert found[1] == found[2] != found[3] and found[4] == found[5] == ""
    assert fingerprints.fingerprint(frame.limit(0)).count() == 0
    assert fingerprints.fingerprint(frame.unionByName(frame)).count() == 10


def test_plan_has_no_python(spark):
    frame = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    made = fingerprints.compare(fingerprints.fingerprint(frame), "digests", "digests", "result")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_half_of_a_line_of_64_words_is_recognised(spark):
    kept, end, other = ([f"{part}{number}" for number in range(32)] for part in "abc")
    assert compared(spark, [(" ".join([*kept, *end]), " ".join([*kept, *other]))]) == [1 / 3]
