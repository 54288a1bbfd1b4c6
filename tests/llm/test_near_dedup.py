from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import near_dedup


def shingle_set(text, words):
    found = [word for word in (text or "").encode().lower().split()]
    width = min(words, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1)) if found else frozenset()


def brute_force(rows, words, percent=80, common=frozenset()):
    """doc_id -> (set size, smallest reachable id), comparing all pairs that share a shingle.

    `common` shingles make no pairs: leave out only such as pairs with nothing else are too unlike for.
    """
    sets = [(number, shingle_set(text, words)) for number, text in rows]
    parent = {number: number for number, _ in rows}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for place, (number, own) in enumerate(sets):
        met = {other for shingle in own - common for other in holders[shingle]}
        for other in met:
            count = len(own & sets[other][1])
            if 100 * count >= percent * (len(own) + len(sets[other][1]) - count):
                a, b = find(number), find(sets[other][0])
                parent[max(a, b)] = min(a, b)
        for shingle in own - common:
            holders[shingle].append(place)
    return {number: (len(own), find(number)) for number, own in sets}


def check(spark, rows, words):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {
        row["doc_id"]: (row["n_shingles"], row["component_id"], row["kept"])
        for row in near_dedup.near_duplicates(frame, words=words).collect()
    }
    wanted = brute_force(rows, words)
    assert found == {number: (size, root, number == root) for number, (size, root) in wanted.items()}
    return found


def edited(words, share, source):
    return [source.choice(VOCABULARY) if source.random() < share else word for word in words]


VOCABULARY = [f"w{number}" for number in range(3000)]


def corpus(seed, groups=12, copies=12, length=120):
    """Exact copies, near copies around an original, chains of edits, unrelated texts, common openings."""
    source, rows = random.Random(seed), []
    opening = [source.choice(VOCABULARY) for _ in range(25)]
    for _ in range(groups):
        words = [source.choice(VOCABULARY) for _ in range(length)]
        for number in range(copies):
            kind = source.random()
            if kind < 0.3:
                rows.append(words)
            elif kind < 0.7:
                rows.append(edited(words, source.choice([0.01, 0.03, 0.05]), source))
            else:
                words = edited(words, 0.04, source)
                rows.append(words)
        rows.append(opening + [source.choice(VOCABULARY) for _ in range(length)])
    source.shuffle(rows)
    return [(7 * number, " ".join(row)) for number, row in enumerate(rows)]


@pytest.mark.parametrize("words", [2, 5])
def test_components_equal_brute_force(spark, words):
    found = check(spark, corpus(words), words)
    assert len({root for _, root, _ in found.values()}) < len(found) - 40


def test_given_documents_equal_brute_force(spark, sf_dir):
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, 2)


def test_large_nodes_and_groups_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE", 6)
    monkeypatch.setattr(near_dedup, "DEPTH", 2)
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 900)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    check(spark, corpus(9, groups=4, copies=40), 2)


def boilerplate(count, source, shared=60, own=34):
    """Pairs that are just alike enough, and near copies of some, all with the same opening."""
    opening = [source.choice(VOCABULARY) for _ in range(shared)]
    rows = []
    for number in range(count // 2):
        words = [f"own{source.randrange(10**9)}" for _ in range(own)]
        other = list(words)
        for place in range(6, 6 + source.choice([1, 3, 6, 9, 12])):
            other[place] = f"own{source.randrange(10**9)}"
        rows += [" ".join(opening + words), " ".join(opening + other)]
    source.shuffle(rows)
    return list(enumerate(rows)), {tuple(opening[place : place + 5]) for place in range(shared - 4)}


@pytest.mark.parametrize("settings", [{}, {"PART": 300, "NODE": 64}, {"VAST": 500, "PART": 200}])
def test_large_nodes_of_boilerplate_equal_brute_force(spark, monkeypatch, settings):
    """Nodes of thousands that share most of their words: no pair within a node is passed over, at any size."""
    for name, value in settings.items():
        monkeypatch.setattr(near_dedup, name, value)
    rows, opening = boilerplate(5000, random.Random(11))
    shared = frozenset(tuple(word.encode() for word in shingle) for shingle in opening)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    wanted = brute_force(rows, 5, common=shared)
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in found} == wanted
    assert len({root for _, root in wanted.values()}) < 4500


def test_all_pairs_of_a_large_node_are_compared_or_connected(spark, monkeypatch):
    """One tree, and no branching: the nodes' comparison alone has to find every pair."""
    monkeypatch.setattr(near_dedup, "DEPTH", 1)
    monkeypatch.setattr(near_dedup, "NODE", 16)
    monkeypatch.setattr(near_dedup, "PART", 50)
    monkeypatch.setattr(near_dedup, "trees_for", lambda *_: 1)
    monkeypatch.setattr(near_dedup, "_branches", lambda node, both=False: F.lit(7).cast("long"))
    rows, _ = boilerplate(600, random.Random(5), shared=10, own=60)
    check(spark, rows, 5)
    source = random.Random(6)
    copies = [" ".join(edited(VOCABULARY[:200], 0.01, source)) for _ in range(400)] + [" ".join(source.choices(VOCABULARY, k=200)) for _ in range(200)]
    check(spark, list(enumerate(copies)), 2)


def test_trees_follow_from_the_recall_sought():
    few, many = near_dedup.trees_for(0.9, 80), near_dedup.trees_for(0.999, 80)
    assert 1 <= few < many == 9 and near_dedup.trees_for(0.999, 95) < many
    # simulated: the share of pairs that all trees miss
    source = random.Random(3)

    def meets(depth):
        if depth == 0:
            return True
        branches = 2 if source.random() < 1 / near_dedup.SECOND_OF else 1
        return any(source.random() < 0.8 and meets(depth - 1) for _ in range(branches))

    missed = sum(not any(meets(near_dedup.DEPTH) for _ in range(many)) for _ in range(20_000))
    assert missed / 20_000 <= 1 - near_dedup.TARGET


def test_documents_no_pivot_reaches_are_searched_everywhere(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 400)
    monkeypatch.setattr(near_dedup, "PIVOTS", 1)
    # one candidate group of two components, each spread over many chunks
    source = random.Random(4)
    first = [source.choice(VOCABULARY) for _ in range(100)]
    second = edited(first, 0.16, source)
    rows = [" ".join(edited(words, 0.02, source)) for words in (first, second) for _ in range(25)]
    check(spark, list(enumerate(rows)), 2)


def test_nulls_empty_short_repeated_and_long_texts(spark):
    long_text = " ".join(VOCABULARY * 20)
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "One"), (5, "oNE"), (6, "one two"), (7, "ONE  TWO"), (8, "two one"),
        (9, "É two"), (10, "é two"), (11, "one two"), (12, long_text), (13, long_text.upper()), (14, long_text + " end"),
    ]
    found = check(spark, rows, 2)
    assert found[1] == (0, 1, True) and found[3] == (0, 3, True)
    assert found[5] == (1, 4, False) and found[7] == (1, 6, False) and found[8] == (1, 8, True)
    assert found[10][1] == 10 and found[13][1] == 12 and found[14][1] == 12


def test_repeated_rows_rows_without_id_and_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(1, "a b c", "x", 5), (1, "a b c", "x", 6), (None, "a b c", "x", 7), (2, "A b c", "x", 8)],
        "doc_id long, text string, class string, rep int",
    )
    found = sorted(
        ((row["doc_id"], row["component_id"], row["kept"]) for row in near_dedup.near_duplicates(frame).collect()),
        key=str,
    )
    assert found == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    edges = [(n, n + 1) for n in range(1, 40)] + [(100, n) for n in range(101, 160)] + [(160, 159)]
    found = {row["node"]: row["root"] for row in near_dedup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {n: 1 for n in range(2, 41)} | {n: 100 for n in range(101, 161)}
