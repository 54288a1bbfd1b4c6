"""Chat formatting by columnar byte assembly.

Turns of a conversation are laid out as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

In roles and texts a backslash becomes two and `<|` becomes `<\\|`, so no control string can occur
inside them; in roles a line feed gets a backslash too. Dropping the backslash before each escaped
character gives the original back.

The bytes are never joined string by string: lengths of all segments of a batch give cumulative
offsets, and headers and contents are scattered into one preallocated Arrow buffer.

Defined results: a null role or text counts as empty. Rows of a conversation are ordered by turn
(null first), role, text, so ties and repeated rows have one order and are all kept. A row without
conversation id is a conversation of its own, with a null id: nothing says that such rows belong together, and however many
there are, they are formatted where they lie. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BREAK, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"
TRAINED_ROLE = "assistant"
FORMATTED = "conv_id long, formatted string, loss_spans array<struct<start: long, length: long>>"


def format_chats(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """One row per conversation: conv_id, formatted text, and the spans (in code points) to train on.

    A span covers the escaped text of one turn of `trained_role`. Conversations are spread by id and
    streamed in turn order; a task holds one batch and the conversation it is in the middle of, whose
    formatted text has to fit into one value anyway.
    """
    rows = df.select(
        df[conv_col].cast("long").alias("conv_id"),
        df[turn_col].cast("long").alias("turn"),
        F.coalesce(df[role_col], F.lit("")).alias("role"),
        F.coalesce(df[text_col], F.lit("")).alias("text"),
    )
    ordered = rows.where("conv_id IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    alone = rows.where("conv_id IS NULL")
    return ordered.unionByName(alone).mapInArrow(lambda batches: _formatted(batches, trained_role), FORMATTED)


def _formatted(batches: Iterator[pa.RecordBatch], trained_role: str) -> Iterator[pa.RecordBatch]:
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        breaks = _breaks(batch.column("conv_id"))
        if pending and _same(pending[-1].column("conv_id")[-1], batch.column("conv_id")[0]):
            if not len(breaks):
                pending.append(batch)
                continue
            yield assemble(pa.Table.from_batches([*pending, batch.slice(0, breaks[0])]), trained_role)
            batch = batch.slice(breaks[0])
            breaks = breaks[1:] - breaks[0]
        elif pending:
            yield assemble(pa.Table.from_batches(pending), trained_role)
        if len(breaks):
            yield assemble(pa.Table.from_batches([batch.slice(0, breaks[-1])]), trained_role)
            batch = batch.slice(breaks[-1])
        pending = [batch]
    if pending:
        yield assemble(pa.Table.from_batches(pending), trained_role)


def _same(left: pa.Scalar, right: pa.Scalar) -> bool:
    return left.is_valid and left.as_py() == right.as_py()


def _breaks(ids: pa.Array) -> np.ndarray:
    """Row numbers, but for 0, at which another conversation begins; each row without id is one."""
    values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    empty = pc.is_null(ids).to_numpy(zero_copy_only=False)
    return np.flatnonzero((values[1:] != values[:-1]) | empty[1:] | empty[:-1]) + 1


def _escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(texts, "\\", "\\\\"), "<|", "<\\|")


def _content(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the length of each."""
    texts = texts.cast(pa.large_binary())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[ends[0] : ends[-1]], np.diff(ends)


def _scatter(out: np.ndarray, starts: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
    """Copy consecutive pieces of `data` to the given places of `out`."""
    shift = starts - (np.cumsum(lengths) - lengths)
    out[np.repeat(shift, lengths) + np.arange(len(data))] = data


def assemble(turns: pa.Table, trained_role: str) -> pa.RecordBatch:
    """Format whole conversations, given in order, into one buffer."""
    turns = turns.combine_chunks()
    ids = turns["conv_id"].combine_chunks()
    role_column, text_column = (turns[name].combine_chunks().cast(pa.large_string()) for name in ("role", "text"))
    trained = pc.equal(role_column, trained_role).to_numpy(zero_copy_only=False)
    roles, role_lengths = _content(pc.replace_substring(_escaped(role_column), "\n", "\\\n"))
    texts, text_lengths = _content(_escaped(text_column))

    lengths = np.empty((len(ids), 5), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2] = len(START), role_lengths, len(BREAK)
    lengths[:, 3], lengths[:, 4] = text_lengths, len(END)
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(lengths.shape)
    total = int(ends[-1])

    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    for column, header in ((0, START), (2, BREAK), (4, END)):
        out[starts[:, column, None] + np.arange(len(header))] = np.frombuffer(header, np.uint8)
    _scatter(out, starts[:, 1], roles, role_lengths)
    _scatter(out, starts[:, 3], texts, text_lengths)

    first = np.concatenate(([0], _breaks(ids)))
    offsets = np.append(starts[first, 0], total)
    # code points before each byte: bytes that do not continue one
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    conversation = np.searchsorted(first, np.arange(len(ids)), side="right") - 1
    text_starts, text_ends = starts[:, 3], starts[:, 4]
    span_start = (points[text_starts] - points[offsets[conversation]])[trained]
    span_length = (points[text_ends] - points[text_starts])[trained]
    per_conversation = np.bincount(conversation[trained], minlength=len(first))
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(per_conversation))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(span_start), pa.array(span_length)], ["start", "length"]),
    )
    formatted = pa.Array.from_buffers(
        pa.large_string(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), buffer]
    )
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(first)), formatted.cast(pa.string()), spans], ["conv_id", "formatted", "loss_spans"]
    )


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation."""
    parts = F.split(formatted, r"<\|im_start\|>")
    turns = F.slice(parts, F.lit(2), F.size(parts))
    role = r"(?s)^((?:[^\\\n]++|\\.)*+)\n"
    return F.transform(
        turns,
        lambda turn: F.struct(
            unescape(F.regexp_extract(turn, role, 1)).alias("role"),
            unescape(F.regexp_extract(turn, role + r"(.*)<\|im_end\|>\n$", 2)).alias("text"),
        ),
    )


def read_trained(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(
        spans,
        lambda span: unescape(
            F.substring(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int"))
        ),
    )
