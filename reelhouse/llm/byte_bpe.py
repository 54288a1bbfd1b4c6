"""Byte-level BPE: each distinct word is encoded once, and documents are put together by position.

Texts are split into words (matches of the tokenizer's pattern). Documents are taken in blocks; within a block,
a word is a slot number, and a document is the slots at its positions. The slots' words are dealt to shards by their hash,
so that equal words of all blocks meet and are encoded once; their ids go back to the blocks, where documents take them by
position. Words travel once per block and not once per occurrence, so no word is a hot key. A block's words for a shard are one
row of three plain columns (slots, lengths, bytes), some 70 bytes beside its content: with more shards than words in a
block it is a row for each word at most, so the shuffle is bounded by the texts and not by its own width. Positions and words
share one exchange, of which the word encoder reads the words and the blocks read the rest. Decoding joins ids with
the token-byte table by taking its rows.

Defined results: a null or empty text has no ids and decodes to no bytes. Rows, repeated ones too, are
encoded separately. An empty table gives no rows. Other columns are ignored. A block that a lost
executor's work is repeated for is the same if its partition has its rows in the same order, as scans and
checkpoints do; each packet bears a digest of its block's words, and another order is an error.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import blocks, id_and_text, parts_for

#: Bytes of text that share a dictionary.
BLOCK_BYTES = 12_000_000
#: Ids that are decoded at a time; a longer row is taken whole.
SLICE_IDS = 500_000
#: Word shards for each shuffle partition, so that hashing spreads them evenly.
SHARDS_PER_PART = 4
#: Blocks have keys from 0 up, shards of words negative ones. Of a block's own row, `lengths` are the words of each document
#: with its id and `data` their slots; of a shard's, the steps from slot to slot, byte lengths and bytes of words; on the way back, ids
#: in place of bytes. Steps and lengths are narrow numbers unless a flag above the digest's 32 bits says that they are wide.
WIDE_STEPS, WIDE_LENGTHS, WIDE_COUNTS = 1 << 32, 1 << 33, 1 << 34
NARROW_STEP, NARROW_LENGTH = np.uint16, np.uint8
PACKET = "key long, block long, digest long, slots binary, lengths binary, data binary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _packed(**columns) -> bytes:
    """Columns as a compressed Arrow stream."""
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all().combine_chunks()


def _rows(keys, blocks, digests, *columns) -> pa.RecordBatch:
    names = [part.split()[0] for part in PACKET.split(", ")]
    numbers = [pa.array(np.broadcast_to(values, len(keys)), pa.int64()) for values in (keys, blocks, digests)]
    return pa.RecordBatch.from_arrays([*numbers, *columns], names)


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Consecutive parts of an array as binary values, without a copy of each."""
    offsets = (edges * values.itemsize).astype(np.int64)
    cut = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])
    return cut.cast(pa.binary())


def _joined(column: pa.ChunkedArray | pa.Array, kind) -> np.ndarray:
    """All binary values of a column, one after the other, as numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _fits(values: np.ndarray, kind) -> bool:
    return not len(values) or int(values.max()) <= np.iinfo(kind).max


def _steps(slots: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The distance of each slot from the one before it, and of a shard's first one from 0."""
    steps = np.diff(slots, prepend=0)
    steps[begins] = slots[begins]
    return steps


class Slots(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = slot = len(self)
        return slot


def _split(batches: Iterator[pa.RecordBatch], pattern: str, shards: int) -> Iterator[pa.RecordBatch]:
    import regex

    words_of = regex.compile(pattern).findall
    first = TaskContext.get().partitionId() << 32
    for number, block in enumerate(blocks(batches, "text", BLOCK_BYTES)):
        slots = Slots()
        positions = [np.fromiter(map(slots.__getitem__, words_of(text.as_py())), np.int32) for text in block["text"]]
        words = [word.encode() for word in slots]
        del slots
        digest = zlib.crc32(b"\xff".join(words))
        # byte planes: the higher bytes of most slots are zero
        planes = np.concatenate(positions).view(np.uint8).reshape(-1, 4)
        documents = _packed(doc_id=block["doc_id"], count=pa.array([len(at) for at in positions], pa.int64()))
        del positions, block
        data = _packed(**{f"byte{place}": pa.array(planes[:, place].copy()) for place in range(4)})
        del planes
        if words:
            shard = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % shards
            order = np.argsort(shard, kind="stable")
            begins = np.flatnonzero(np.diff(shard[order], prepend=-1))
            edges = np.append(begins, len(words))
            steps, lengths = _steps(order, begins), np.fromiter(map(len, words), np.int64, len(words))[order]
            ends = np.concatenate(([0], np.cumsum(lengths)))
            narrow_steps, narrow_lengths = _fits(steps, NARROW_STEP), _fits(lengths, NARROW_LENGTH)
            digest += (not narrow_steps) * WIDE_STEPS + (not narrow_lengths) * WIDE_LENGTHS
            content = np.frombuffer(b"".join(map(words.__getitem__, order.tolist())), np.uint8)
            yield _rows(
                -1 - shard[order][begins], first + number, digest,
                _cut(steps.astype(NARROW_STEP if narrow_steps else np.uint32), edges),
                _cut(lengths.astype(NARROW_LENGTH if narrow_lengths else np.uint32), edges),
                _cut(content, ends[edges]),
            )
        yield _rows([first + number], first + number, digest, *(pa.array([each], pa.binary()) for each in (None, documents, data)))
        pa.default_memory_pool().release_unused()


def _encode_words(batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str, kind: str) -> Iterator[pa.RecordBatch]:
    """The ids of each distinct word of a shard are computed once; rows come shard by shard."""
    import tiktoken

    encoding, known, at = None, {}, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if encoding is None:
            encoding = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={}
            )
        found, counts, edges = [], [], [0]
        columns = (batch.column(name).to_pylist() for name in ("key", "digest", "lengths", "data"))
        for key, digest, lengths, data in zip(*columns):
            if key != at:
                known.clear()
                at = key
            begin = 0
            for length in np.frombuffer(lengths, np.uint32 if digest & WIDE_LENGTHS else NARROW_LENGTH).tolist():
                word = data[begin : begin + length]
                begin += length
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = np.array(encoding.encode_ordinary(word.decode()), kind).tobytes()
                found.append(ids)
                counts.append(len(ids))
            edges.append(len(found))
        ends = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        each = np.array(counts, np.int64) // np.dtype(kind).itemsize
        narrow = _fits(each, NARROW_LENGTH)
        each = each.astype(NARROW_LENGTH if narrow else np.uint32)
        content, edges = np.frombuffer(b"".join(found), np.uint8), np.array(edges)
        home = batch.column("block").to_numpy()
        yield _rows(
            home, home, batch.column("digest").to_numpy() + (not narrow) * WIDE_COUNTS, batch.column("slots"),
            _cut(each, edges), _cut(content, ends[edges]),
        )


def _reassemble(positions: pa.Table, words: pa.Table, kind: str) -> pa.Table:
    """A block's documents take their words' ids by position."""
    flags = words["digest"].to_numpy() if words.num_rows else np.empty(0, np.int64)
    if (flags % WIDE_COUNTS != positions["digest"][0].as_py()).any():
        raise RuntimeError("a block was repeated with its rows in another order")
    lookup = _by_slot(words, kind)
    documents, data = _unpacked(positions["lengths"][0]), _unpacked(positions["data"][0])
    planes = np.empty((data.num_rows, 4), np.uint8)
    for place in range(4):
        planes[:, place] = data[f"byte{place}"].to_numpy()
    del data
    taken = lookup.take(pa.array(planes.view(np.int32).ravel()))
    del planes, lookup
    # where each document's words begin, and so where its ids do
    edges = np.concatenate(([0], np.cumsum(documents["count"].to_numpy())))
    offsets = taken.offsets.to_numpy()
    ids = pa.LargeListArray.from_arrays(pa.array(offsets[edges].astype(np.int64)), taken.values)
    return pa.table({"doc_id": documents["doc_id"], "ids": ids.cast(pa.list_(pa.int32()))})


def _by_slot(words: pa.Table, kind: str) -> pa.LargeListArray:
    """The ids of a block's words, in the order of their slots."""
    slots, counts, ids = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    flags = words["digest"].to_numpy() if words.num_rows else np.empty(0, np.int64)
    for wide in np.unique(flags & (WIDE_STEPS | WIDE_COUNTS)).tolist():
        some = words.filter(pa.array((flags & (WIDE_STEPS | WIDE_COUNTS)) == wide))
        step_kind = np.dtype(np.uint32 if wide & WIDE_STEPS else NARROW_STEP)
        steps = _joined(some["slots"], step_kind).astype(np.int64)
        held = pc.binary_length(some["slots"]).to_numpy() // step_kind.itemsize
        begins = np.cumsum(held) - held
        # a running sum over all, less what it was where each shard begins
        sums = np.cumsum(steps)
        slots.append(sums - np.repeat(sums[begins] - steps[begins], held))
        counts.append(_joined(some["lengths"], np.uint32 if wide & WIDE_COUNTS else NARROW_LENGTH).astype(np.int64))
        ids.append(_joined(some["data"], kind).astype(np.int32))
    ends = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
    lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
    return lists.take(pa.array(np.argsort(np.concatenate(slots), kind="stable")))


def _only(condition: Column) -> Column:
    """A condition that stays above the exchange: below it, it would make two of one."""
    return F.when(F.spark_partition_id() >= 0, condition)


def encode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row. `ranks` is a rank file that the driver and each executor have under the same path."""
    parts = parts_for(df)
    shards = parts * SHARDS_PER_PART
    kind = "uint16" if max(load_ranks(ranks).values()) < 65536 else "uint32"
    packets = (
        id_and_text(df, id_col, text_col)
        .mapInArrow(lambda batches: _split(batches, pattern, shards), PACKET)
        .repartition(parts, "key")
    )
    of_shards = packets.where(_only(F.col("key") < 0)).sortWithinPartitions("key")
    words = of_shards.mapInArrow(lambda batches: _encode_words(batches, ranks, pattern, kind), PACKET)
    of_blocks = packets.where(_only(F.col("key") >= 0))
    return (
        of_blocks.groupBy("key")
        .cogroup(words.groupBy("key"))
        .applyInArrow(lambda positions, words: _reassemble(positions, words, kind), "doc_id long, ids array<int>")
    )


def _decoded(rows: pa.RecordBatch, lengths: np.ndarray, tokens: pa.Array) -> pa.RecordBatch:
    column = rows.column("ids")
    joined = tokens.take(column.flatten())
    if joined.null_count:
        raise ValueError("ids that the token table does not have")
    _, ends, data = joined.buffers()
    ends = np.frombuffer(ends, np.int64)[joined.offset : joined.offset + len(joined) + 1]
    places = ends[np.concatenate(([0], np.cumsum(lengths)))]
    texts = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(places), data])
    return pa.RecordBatch.from_arrays([rows.column("doc_id"), column, texts.cast(pa.binary())], ["doc_id", "ids", "decoded"])


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded): the bytes of each row's ids, joined from the token-byte table.

    The table is as large as the vocabulary, whatever the input. Null ids decode to no bytes; an unknown
    id is an error.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for batch in batches:
            if tokens is None:
                of_rank = {rank: token for token, rank in load_ranks(ranks).items()}
                tokens = pa.array([of_rank.get(rank) for rank in range(max(of_rank) + 1)], pa.large_binary())
            lengths = pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False)
            # runs of rows of about SLICE_IDS ids together
            runs = np.cumsum(lengths, dtype=np.int64) // SLICE_IDS
            edges = np.concatenate(([0], np.flatnonzero(np.diff(runs)) + 1, [batch.num_rows]))
            for begin, end in zip(edges, edges[1:]):
                if end > begin:
                    yield _decoded(batch.slice(begin, end - begin), lengths[begin:end], tokens)
            pa.default_memory_pool().release_unused()

    rows = encoded.select(
        encoded[id_col].cast("long").alias("doc_id"),
        F.coalesce(encoded[ids_col], F.array().cast("array<int>")).alias("ids"),
    )
    return rows.mapInArrow(decoded, "doc_id long, ids array<int>, decoded binary")
