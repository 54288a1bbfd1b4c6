"""Packing of tokenized documents into training sequences by cutting-stock column generation.

A document's ids (with an end id) are cut into pieces: whole sequences first, then the largest
multiple of UNIT of what remains, then a tail shorter than UNIT. Only the middle kind is hard to pack. Its
lengths are a histogram of at most SEQUENCE / UNIT classes at any input size, for which a linear
program over patterns (which classes share a sequence) is solved by column generation: a
knapsack dynamic program prices new patterns. Patterns are used as often as the rounded-down
solution says, the few pieces left are packed first-fit, and the j-th piece of a class takes the j-th
place its class has in the patterns. Tails are laid end to end along the places the patterns left empty,
then along new sequences, and cut where a sequence ends. The last of these sequences are powers of
two long, so that they need no padding.

Defined results: a null or empty text is the end id alone. Strings that the tokenizer has as special tokens are such where they
stand in a text, as the library has it by default. Repeated rows and ties are separate
documents, each with its own pieces. An empty table gives no rows. Other columns are ignored. Numbering
is fixed by a checkpoint of the pieces, so a lost executor cannot change it.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import blocks, checkpointed, id_and_text

SEQUENCE = 2048
UNIT = 16
END_ID = 1
#: Bytes of text whose distinct pieces are encoded together, pieces to a call of the tokenizer, and pieces
#: that a task keeps known (about 50 bytes each).
BLOCK_BYTES, PIECES_A_CALL, KNOWN = 6_000_000, 512, 600_000
#: Pieces without combining or special signs, and those of them that are a word and a stop.
LATIN = "^[!-~¡-ÿ]+$"
STOPPED = "^[A-Za-zªµºÀ-ÖØ-öø-ÿ]+[.,]$"
# Fixed value: what the tokenizer splits a piece into.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
IDS = pa.large_list(pa.uint32())
WHOLE, TAIL = SEQUENCE // UNIT, 0

PIECES = "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, units int, ids binary"
PACKED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class WordBpe:
    """Ids of texts under a tokenizer that works on each piece between white space separately.

    A block of texts is split into pieces by Arrow, each distinct piece is encoded once, and texts take
    its ids by position. Up to KNOWN pieces stay known for later blocks, as Arrow arrays, which take a
    tenth of the memory of a dictionary. A full stop or comma after a word is encoded apart.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the library takes for single ids wherever they stand, so that pieces do not tell.
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[number for word, number in vocabulary.items() if word.endswith("</w>")]] = True
        self.known, self.known_ids = pa.array([], pa.large_string()), pa.array([], IDS)

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        Pieces lie between ASCII white space; any other is left inside a piece, to the tokenizer. The few texts that may
        hold a special string are encoded as a whole, and so are those whose pieces, in small letters, would hold one.
        """
        texts = texts.cast(pa.large_string())
        whole, lower = np.zeros(len(texts), bool), pc.ascii_lower(texts)
        for string in self.special:
            written = pc.ascii_lower(pa.scalar(string)).as_py()
            whole |= pc.match_substring(lower, written).fill_null(False).to_numpy(zero_copy_only=False)
        pieced = self._by_pieces(texts.filter(pa.array(~whole)))
        for text, as_whole in zip(texts, whole):
            if as_whole:
                yield np.array(self.tokenizer.encode(text.as_py(), add_special_tokens=False).ids, "<u4").tobytes()
            else:
                yield next(pieced)

    def _by_pieces(self, texts: pa.Array) -> Iterator[bytes]:
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        places = pieces.flatten().dictionary_encode()
        taken = self._distinct(places.dictionary).take(places.indices)
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        edges = taken.offsets.to_numpy()[np.concatenate(([0], np.cumsum(counts)))]
        ids = taken.values.to_numpy()
        for begin, end in zip(edges, edges[1:]):
            yield ids[begin:end].tobytes()

    def _distinct(self, pieces: pa.Array) -> pa.LargeListArray:
        """The ids of each piece."""
        stopped = pc.match_substring_regex(pieces, STOPPED)
        stems = pc.if_else(stopped, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        stops = pc.utf8_slice_codeunits(pieces.filter(stopped), -1)
        ids = self._ids(pa.concat_arrays([stems.dictionary, pa.array([".", ","], pa.large_string())]))
        of_stops = ids.take(pc.add(pc.index_in(stops, value_set=pa.array([".", ","], pa.large_string())), len(ids) - 2))
        return _joined(ids.take(stems.indices), of_stops, stopped.to_numpy(zero_copy_only=False))

    def _ids(self, pieces: pa.Array) -> pa.LargeListArray:
        """The ids of different pieces, from those known or anew."""
        at = pc.index_in(pieces, value_set=self.known)
        missing = pieces.filter(pc.is_null(at))
        new = self._encoded(missing)
        place = at.to_numpy(zero_copy_only=False)
        place = np.where(np.isnan(place), len(self.known) - 1 + np.cumsum(np.isnan(place)), place).astype(np.int64)
        whole = pa.concat_arrays([self.known_ids, new])
        if len(whole) <= KNOWN:
            self.known, self.known_ids = pa.concat_arrays([self.known, missing]), whole
        else:
            self.known, self.known_ids = missing, new
        return whole.take(pa.array(place))

    def _encoded(self, pieces: pa.Array) -> pa.LargeListArray:
        """The ids of each piece: pieces of Latin signs many to a call, told apart by counting word ends."""
        latin = pc.match_substring_regex(pieces, LATIN)
        words = pc.count_substring_regex(pieces.filter(latin), WORD).to_numpy()
        names, parts = pieces.filter(latin).to_pylist(), [np.empty(0, np.uint32)]
        for begin in range(0, len(names), PIECES_A_CALL):
            some = " ".join(names[begin : begin + PIECES_A_CALL])
            parts.append(np.array(self.tokenizer.encode(some, add_special_tokens=False).ids, np.uint32))
        ids = np.concatenate(parts)
        ends = np.concatenate(([0], np.flatnonzero(self.is_end[ids]) + 1))[np.concatenate(([0], np.cumsum(words)))]
        together = pa.LargeListArray.from_arrays(pa.array(ends.astype(np.int64)), pa.array(ids))

        others, found = pieces.filter(pc.invert(latin)).to_pylist(), []
        for begin in range(0, len(others), PIECES_A_CALL):
            batch = self.tokenizer.encode_batch(others[begin : begin + PIECES_A_CALL], add_special_tokens=False)
            found += [each.ids for each in batch]
        is_latin = latin.to_numpy(zero_copy_only=False)
        order = np.where(is_latin, np.cumsum(is_latin) - 1, len(names) + np.cumsum(~is_latin) - 1)
        return pa.concat_arrays([together, pa.array(found, IDS)]).take(pa.array(order))


def _joined(stems: pa.LargeListArray, stops: pa.LargeListArray, stopped: np.ndarray) -> pa.LargeListArray:
    """Each stem with its stop, if it has one."""
    after = pa.array(np.where(stopped, np.cumsum(stopped) - 1, len(stops)), pa.int64())
    stops = pa.concat_arrays([stops, pa.array([[]], IDS)]).take(after)
    lengths = np.stack([np.diff(each.offsets.to_numpy()) for each in (stems, stops)], axis=1)
    edges = np.concatenate(([0], np.cumsum(lengths.ravel())))
    out = np.empty(edges[-1], np.uint32)
    for column, each in enumerate((stems, stops)):
        values, sizes = each.flatten().to_numpy(), lengths[:, column]
        shift = edges[:-1].reshape(-1, 2)[:, column] - (np.cumsum(sizes) - sizes)
        out[np.repeat(shift, sizes) + np.arange(len(values))] = values
    return pa.LargeListArray.from_arrays(pa.array(edges[::2].astype(np.int64)), pa.array(out))


def cut(doc_id, ids: bytes) -> Iterator[tuple]:
    """The pieces of one document; only tails, which may be cut again, carry their ids."""
    count = len(ids) // 4
    rest = count % SEQUENCE
    edges = [*range(0, count, SEQUENCE), count - rest % UNIT]
    edges = sorted({edge for edge in edges if edge < count} | {count})
    for start, end in zip(edges, edges[1:]):
        piece, length = ids[4 * start : 4 * end], end - start
        units = length // UNIT if length % UNIT == 0 else TAIL
        yield doc_id, count, start, length, zlib.crc32(piece), units, None if units else piece


def cut_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: a narrow pass."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordBpe(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        names = [part.split()[0] for part in PIECES.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
        for block in blocks(batches, "text", BLOCK_BYTES):
            texts, numbers = block["text"].combine_chunks(), block["doc_id"].to_pylist()
            rows = [piece for doc_id, ids in zip(numbers, encode(texts)) for piece in cut(doc_id, ids + end)]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)
            del block, texts, rows, columns
            pa.default_memory_pool().release_unused()

    return id_and_text(df, id_col, text_col).mapInArrow(pieces, PIECES)


@dataclass
class Pattern:
    """How many pieces of which class share a sequence, and how many sequences do so."""

    counts: dict[int, int]
    times: int

    @property
    def used(self) -> int:
        return sum(units * count for units, count in self.counts.items())


def price(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable set of sizes that fits, by dynamic programming."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for size in range(1, room + 1):
        fits = np.flatnonzero(sizes <= size)
        best[size] = best[size - 1]
        if len(fits):
            totals = best[size - sizes[fits]] + values[fits]
            top = int(totals.argmax())
            if totals[top] > best[size] + 1e-12:
                best[size], choice[size] = totals[top], fits[top]
    counts, left = np.zeros(len(sizes)), room
    while left > 0:
        if choice[left] < 0:
            left -= 1
        else:
            counts[choice[left]] += 1
            left -= sizes[choice[left]]
    return float(best[room]), counts


def solve(demand: dict[int, int], room: int = WHOLE, rounds: int = 3000) -> list[Pattern]:
    """Patterns that hold exactly the demanded number of pieces of each class.

    Linear program: fewest sequences. Revised simplex over columns made on demand, until a lower
    bound shows that no half sequence can be saved; a round limit could only cost padding, never a piece.
    """
    sizes = np.array(sorted(units for units, count in demand.items() if count), int)
    if not len(sizes):
        return []
    wanted = np.array([demand[units] for units in sizes], float)
    columns = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    amounts = _times(inverse, wanted)
    for number in range(rounds):
        value, entering = price(inverse.sum(axis=0), sizes, room)
        bound = max((wanted * sizes).sum() / room, amounts.sum() / max(value, 1.0))
        if amounts.sum() - bound < 0.5:
            break
        direction = _times(inverse, entering)
        rising = direction > 1e-9
        ratios = np.full(len(sizes), np.inf)
        ratios[rising] = np.maximum(amounts[rising], 0) / direction[rising]
        leaving = int(ratios.argmin())
        columns[:, leaving] = entering
        # the inverse after one column has changed
        row = inverse[leaving] / direction[leaving]
        inverse = inverse - direction[:, None] * row
        inverse[leaving] = row
        if number % 50 == 49:  # a Newton step removes what rounding has added up
            change = np.einsum("ij,jk->ik", columns, inverse, optimize=False)
            inverse = 2 * inverse - np.einsum("ij,jk->ik", inverse, change, optimize=False)
        amounts = _times(inverse, wanted)
    amounts = np.maximum(amounts, 0)
    left, patterns = dict(zip(sizes.tolist(), wanted.astype(int).tolist())), []
    for column, amount in zip(columns.T.astype(int), np.floor(amounts + 1e-6).astype(int).tolist()):
        counts = {int(units): int(count) for units, count in zip(sizes, column) if count}
        times = min([amount, *(left[units] // count for units, count in counts.items())])
        if times > 0:
            patterns.append(Pattern(counts, times))
            for units, count in counts.items():
                left[units] -= times * count
    return patterns + first_fit(left, room)


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """A product without BLAS, whose threads can hang in a process that has forked."""
    return (matrix * vector).sum(axis=1)


def first_fit(left: dict[int, int], room: int) -> list[Pattern]:
    """Decreasing first fit, each filled sequence repeated while its pieces last."""
    left, patterns = {units: count for units, count in left.items() if count > 0}, []
    while left:
        counts, free = {}, room
        for units in sorted(left, reverse=True):
            count = min(left[units], free // units)
            if count:
                counts[units] = count
                free -= units * count
        times = min(left[units] // count for units, count in counts.items())
        patterns.append(Pattern(counts, times))
        left = {units: count - times * counts.get(units, 0) for units, count in left.items()}
        left = {units: count for units, count in left.items() if count}
    return patterns


def places(patterns: list[Pattern], first_sequence: int) -> list[tuple]:
    """(units, rank_from, rank_to, count, sequence, offset): which ranks of a class go where."""
    rows, ranks, sequence = [], {}, first_sequence
    for pattern in patterns:
        offset = 0
        for units, count in sorted(pattern.counts.items(), reverse=True):
            begin = ranks.get(units, 0)
            ranks[units] = begin + count * pattern.times
            rows.append((units, begin, ranks[units], count, sequence, offset))
            offset += units * UNIT * count
        sequence += pattern.times
    return rows


def gaps(patterns: list[Pattern], first_sequence: int, total: int) -> list[tuple]:
    """(begin, end, width, sequence, offset): where the tails go, laid end to end from 0 to `total`."""
    rows, at, sequence = [], 0, first_sequence

    def add(times: int, width: int, first: int, offset: int) -> None:
        nonlocal at
        end = min(at + times * width, total)
        if end > at:
            rows.append((at, end, width, first, offset))
            at = end

    for pattern in patterns:
        width = SEQUENCE - pattern.used * UNIT
        if width:
            add(pattern.times, width, sequence, SEQUENCE - width)
        sequence += pattern.times
    whole = (total - at) // SEQUENCE
    add(whole, SEQUENCE, sequence, 0)
    sequence += whole
    width = SEQUENCE
    while at < total:
        width //= 2
        if total - at >= width:
            add(1, width, sequence, 0)
            sequence += 1
    return rows


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    To the driver come the class totals only, SEQUENCE / UNIT + 1 rows. Ranks within a class are counted
    per partition of the stored pieces and shifted by what the partitions before hold, so no class
    is gathered in one task.
    """
    spark = df.sparkSession
    pieces = checkpointed(cut_documents(df, tokenizer, id_col, text_col)).withColumn("part", F.spark_partition_id())
    held = pieces.groupBy("part", "units").agg(F.count("*").alias("pieces"), F.sum("length").alias("tokens"))
    before = Window.partitionBy("units").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = checkpointed(
        held.select(
            "part",
            "units",
            "pieces",
            "tokens",
            F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("pieces_before"),
            F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        )
    )
    totals = {row["units"]: row for row in shifts.groupBy("units").agg(F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens")).collect()}
    patterns = solve({units: row["pieces"] for units, row in totals.items() if units not in (TAIL, WHOLE)})
    whole = totals[WHOLE]["pieces"] if WHOLE in totals else 0
    tail_tokens = totals[TAIL]["tokens"] if TAIL in totals else 0

    in_part = Window.partitionBy("part", "units").orderBy("doc_id", "start")
    ranked = (
        pieces.withColumn("rank", F.row_number().over(in_part) - 1)
        .withColumn("laid", F.sum("length").over(in_part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
        .join(shifts.select("part", "units", "pieces_before", "tokens_before"), ["part", "units"])
        .withColumn("rank", F.col("rank") + F.col("pieces_before"))
        .withColumn("laid", F.col("laid") + F.col("tokens_before"))
    )
    full = ranked.where(F.col("units") == WHOLE).select(
        *PACKED[:5], F.col("rank").cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return (
        full.unionByName(_place(spark, ranked.where((F.col("units") > 0) & (F.col("units") < WHOLE)), places(patterns, whole)))
        .unionByName(_lay(spark, ranked.where(F.col("units") == TAIL), gaps(patterns, whole, tail_tokens)))
    )


def _place(spark: SparkSession, ranked: DataFrame, rows: list[tuple]) -> DataFrame:
    """Each ranked piece in its pattern's sequence; the places are a row per class and pattern."""
    slots = spark.createDataFrame(
        rows, "in_units int, rank_from long, rank_to long, copies long, first long, base long"
    )
    nth = F.col("rank") - F.col("rank_from")
    return ranked.join(
        F.broadcast(slots),
        (F.col("units") == F.col("in_units")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    ).select(
        *PACKED[:5],
        (F.col("first") + F.floor(nth / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("base") + (nth % F.col("copies")) * F.col("length")).cast("long").alias("offset"),
    )


def _lay(spark: SparkSession, tails: DataFrame, rows: list[tuple]) -> DataFrame:
    """Tails along the gaps, cut where a gap ends; there are a few gap rows per pattern."""
    regions = spark.createDataFrame(rows, "begin long, end long, width long, first long, base long")
    stop = F.col("laid") + F.col("length")
    first_gap = F.floor((F.greatest("laid", "begin") - F.col("begin")) / F.col("width"))
    last_gap = F.floor((F.least(stop, F.col("end")) - 1 - F.col("begin")) / F.col("width"))
    parts = (
        tails.join(F.broadcast(regions), (F.col("laid") < F.col("end")) & (stop > F.col("begin")))
        .withColumn("gap", F.explode(F.sequence(first_gap, last_gap)))
        .withColumn("gap_begin", F.col("begin") + F.col("gap") * F.col("width"))
        .withColumn("from", F.greatest("laid", "gap_begin"))
        .withColumn("to", F.least(stop, F.col("end"), F.col("gap_begin") + F.col("width")))
    )
    inside, size = F.col("from") - F.col("laid"), F.col("to") - F.col("from")
    return parts.select(
        "doc_id",
        (F.col("start") + inside).cast("long").alias("start"),
        size.cast("long").alias("length"),
        F.crc32(F.substring("ids", (4 * inside + 1).cast("int"), (4 * size).cast("int"))).alias("ids_crc32"),
        "doc_tokens",
        (F.col("first") + F.col("gap")).cast("long").alias("sequence_id"),
        (F.col("base") + F.col("from") - F.col("gap_begin")).cast("long").alias("offset"),
    )
