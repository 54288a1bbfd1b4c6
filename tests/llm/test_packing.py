from __future__ import annotations

import functools
import itertools
import operator
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from reelhouse.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def padded(tokens):
    return tokens if tokens & (tokens - 1) == 0 else packing.SEQUENCE


def check(spark, rows, tokenizer, most_padding):
    """Every id in exactly one piece, pieces without gaps in sequences, digests of library ids, little padding."""
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    pieces = [row.asDict() for row in packing.pack(frame, PATH).collect()]
    ids = {
        number: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")
        for number, text in rows
    }
    assert {piece["doc_id"] for piece in pieces} == ids.keys()
    at = dict.fromkeys(ids, 0)
    for piece in sorted(pieces, key=lambda piece: (piece["doc_id"], piece["start"])):
        own, start, end = ids[piece["doc_id"]], piece["start"], piece["start"] + piece["length"]
        assert start == at[piece["doc_id"]] and end > start and piece["doc_tokens"] == len(own)
        assert piece["ids_crc32"] == zlib.crc32(own[start:end].tobytes())
        at[piece["doc_id"]] = end
    assert at == {number: len(own) for number, own in ids.items()}
    filled = {}
    for piece in sorted(pieces, key=lambda piece: (piece["sequence_id"], piece["offset"])):
        assert piece["offset"] == filled.get(piece["sequence_id"], 0)
        filled[piece["sequence_id"]] = piece["offset"] + piece["length"]
    assert max(filled.values()) <= packing.SEQUENCE
    assert 1 - sum(filled.values()) / sum(map(padded, filled.values())) <= most_padding
    return pieces


def test_special_strings_are_those_of_the_library(spark, tokenizer):
    texts = [
        "<|endoftext|>", "a <|startoftext|> b", "word<|endoftext|>word, Word.", "<|STARTOFTEXT|> x", "<|endoftext", "<|endoftext|><|endoftext|>",
        "plain, words.", "<| endoftext |>", "é<|EndOfText|>é", None, "",
    ]
    assert 49407 in tokenizer.encode(texts[0], add_special_tokens=False).ids
    check(spark, list(enumerate(texts)), tokenizer, 1)


def test_given_documents(spark, sf_dir, tokenizer):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    # less than the one sequence that tails did not suffice to fill, of 88
    check(spark, [tuple(row) for row in rows], tokenizer, 1 / 88)


def test_odd_texts(spark, tokenizer):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "<|endoftext|> A"), (5, "x" * 30_000), (6, "many words " * 40_000),
        (7, "Σίσυφος İstanbul ﬁ ½ 漢字 😀"), (8, "It's we'll; 'S a.b, c.,d ., .. x\x1cy\x85z\xa0w"), (9, "same"), (10, "same"),
    ]
    check(spark, rows, tokenizer, 0.05)


def test_repeated_ids_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, "c", "z")], SCHEMA + ", units string")
    found = packing.pack(frame, PATH).collect()
    assert sorted((row["doc_id"] or 0, row["doc_tokens"]) for row in found) == [(0, 2), (1, 3), (1, 3)]
    assert len({(row["sequence_id"], row["offset"]) for row in found}) == 3
    assert packing.pack(frame.limit(0), PATH).count() == 0


def test_words_equal_the_library_on_random_texts(tokenizer):
    source = random.Random(2)
    parts = [*" \t\n\x0b\x0c\r\x1c\x85\xa0　᠎abcABCÉéßİıΣσς.,'!_-<|>09²½́ëÅÅµªK漢字ㄅ٣😀\x00", "'s", " it's ", "<|endoftext|>"]
    texts = ["".join(source.choices(parts, k=source.randint(0, 40))) for _ in range(5000)]
    for text, ids in zip(texts, packing.WordBpe(PATH)(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_pieces_stay_right_when_the_known_ones_start_over(spark, sf_dir, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 300)
    monkeypatch.setattr(packing, "BLOCK_BYTES", 5000)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).collect()
    check(spark, [tuple(row) for row in rows], tokenizer, 0.1)


@pytest.mark.parametrize("seed", range(6))
def test_patterns_hold_exactly_the_demand(seed):
    random_ = np.random.default_rng(seed)
    demand = {
        int(units): int(random_.integers(0, 10 ** random_.integers(1, 7))) for units in random_.choice(np.arange(1, 128), 40, False)
    }
    patterns = packing.solve(demand)
    held = {}
    for pattern in patterns:
        assert 0 < pattern.used <= packing.WHOLE and pattern.times > 0
        for units, count in pattern.counts.items():
            held[units] = held.get(units, 0) + count * pattern.times
    assert held == {units: count for units, count in demand.items() if count}


def fewest(demand, room):
    """Fewest sequences for small demands, trying every set of pieces that shares one."""

    @functools.cache
    def need(left):
        if not any(count for _, count in left):
            return 0
        sizes = [units for units, _ in left]
        choices = itertools.product(*(range(min(count, room // units) + 1) for units, count in left))
        filled = [choice for choice in choices if sum(map(operator.mul, sizes, choice)) <= room and any(choice)]
        return 1 + min(need(tuple((u, c - k) for (u, c), k in zip(left, choice))) for choice in filled)

    return need(tuple(sorted(demand.items())))


@pytest.mark.parametrize("demand", [{5: 4, 4: 5, 3: 4}, {7: 3, 6: 3, 5: 3, 2: 3}, {11: 2, 1: 3}, {4: 9}])
def test_patterns_need_few_more_than_the_fewest_sequences(demand):
    used = sum(pattern.times for pattern in packing.solve(demand, room=12))
    assert fewest(demand, 12) <= used <= fewest(demand, 12) + 1


def test_knapsack_prices_by_brute_force():
    values, sizes = np.array([3.0, 4.1, 5.2]), np.array([2, 3, 4])
    best = max(
        a * 3.0 + b * 4.1 + c * 5.2 for a in range(6) for b in range(4) for c in range(3) if 2 * a + 3 * b + 4 * c <= 11
    )
    value, counts = packing.price(values, sizes, 11)
    assert abs(value - best) < 1e-9 and counts @ sizes <= 11 and abs(counts @ values - best) < 1e-9


def test_ranks_and_gaps_cover_every_place_once():
    patterns = [packing.Pattern({100: 1, 10: 2}, 3), packing.Pattern({60: 2}, 2)]
    rows = packing.places(patterns, 5)
    assert rows == [(100, 0, 3, 1, 5, 0), (10, 0, 6, 2, 5, 1600), (60, 0, 4, 2, 8, 0)]
    assert packing.gaps(patterns, 5, 3 * 128 + 100 + 0) == [(0, 384, 128, 5, 1920), (384, 484, 128, 8, 1920)]
    tail = packing.gaps([], 0, 2048 + 1024 + 5)
    assert [(end - begin, width) for begin, end, width, _, _ in tail] == [(2048, 2048), (1024, 1024), (4, 4), (1, 1)]
