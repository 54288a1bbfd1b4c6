from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken

from reelhouse.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={}
    )


def both_ways(frame):
    encoded = byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN)
    return [(row["doc_id"], list(row["ids"]), bytes(row["decoded"])) for row in byte_bpe.decode(encoded, RANKS).collect()]


def check(spark, rows, library):
    wanted = [(number, library.encode_ordinary(text or ""), (text or "").encode()) for number, text in rows]
    assert sorted(both_ways(spark.createDataFrame(rows, SCHEMA)), key=str) == sorted(wanted, key=str)


def test_given_documents(spark, sf_dir, library):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(row) for row in rows], library)


def test_odd_texts(spark, library):
    texts = [
        None, "", " ", "\n\n  \t", "a  b   c ", "it's we'll 'S", "漢字 ひらがな 😀😀 é", "<|endoftext|>", "x" * 20_000,
        "word " * 30_000, "123 4567 ½²", "\x00\x1c\x85  ", "same", "same",
    ]
    check(spark, [*enumerate(texts), (5, "again"), (None, "no id")], library)


def test_blocks_share_words(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 40)
    check(spark, [(number, f"common words here number{number % 7}, {number}") for number in range(90)], library)


def test_empty_table_and_clashing_columns(spark, library):
    frame = spark.createDataFrame([(1, "a b", "x", 2)], SCHEMA + ", ids string, block int")
    assert both_ways(frame) == [(1, library.encode_ordinary("a b"), b"a b")]
    assert both_ways(frame.limit(0)) == []


def test_decoding_unknown_ids_is_an_error_and_null_ids_are_nothing(spark):
    frame = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert byte_bpe.decode(frame, RANKS).first()["decoded"] == b""
    with pytest.raises(Exception, match="out of bounds|token table"):
        byte_bpe.decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>"), RANKS).collect()


def test_the_shuffle_hardly_grows_with_its_width(monkeypatch):
    """All texts of sf0.1, split for 50 and for 5,000 shuffle partitions."""
    documents = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"])
    monkeypatch.setattr(byte_bpe, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))

    def bytes_out(parts):
        batches = iter(documents.to_batches(max_chunksize=1000))
        split = list(byte_bpe._split(batches, public_tokenizers.PATTERN, parts * byte_bpe.SHARDS_PER_PART))
        return sum(batch.nbytes for batch in split), sum(batch.num_rows for batch in split)

    (narrow, few), (wide, many) = bytes_out(50), bytes_out(5000)
    print(narrow, few, wide, many)
    assert many > 10 * few and wide <= 1.3 * narrow


def test_what_is_known_is_dropped_with_its_shard(monkeypatch):
    """Words are remembered for a shard only, so a task's memory does not grow with its shards."""
    rows = byte_bpe._rows(
        [-2, -2, -1], [0, 1, 0], [7, 7, 7],
        pa.array([np.array(each, "<u2").tobytes() for each in ([0, 1], [3], [2])], pa.binary()),
        pa.array([bytes(each) for each in ([1, 2], [1], [1])], pa.binary()),
        pa.array([b"abb", b"a", b"a"], pa.binary()),
    )
    encoded = []

    class Counting:
        def __init__(self, *_, **__):
            pass

        def encode_ordinary(self, word):
            encoded.append(word)
            return [ord(each) for each in word]

    monkeypatch.setattr(tiktoken, "Encoding", Counting)
    (out,) = byte_bpe._encode_words(iter([rows]), RANKS, public_tokenizers.PATTERN, "uint16")
    assert encoded == ["a", "bb", "a"]
    assert out["data"].to_pylist() == [np.array(each, "<u2").tobytes() for each in ([97, 98, 98], [97], [97])]
    assert out["key"].to_pylist() == [0, 1, 0] and out["slots"].to_pylist() == rows["slots"].to_pylist()


def test_wide_steps_lengths_and_counts(spark, library, monkeypatch):
    """Numbers that do not fit into narrow columns, beside blocks whose numbers do."""
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(byte_bpe, "NARROW_STEP", np.uint8)
    texts = ["x" * 300 + " y", " ".join(f"w{number}" for number in range(700)), "é" * 4000, "a b c", "漢" * 900 + " b"]
    check(spark, [(number, texts[number % 5]) for number in range(20)], library)
