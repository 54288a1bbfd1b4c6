"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, with DataFrame functions only.

A paragraph is a line, or a piece of PARAGRAPH_WORDS words of a longer one. A sketch has three
sub-tables; a digest goes into one cell of each, and a cell keeps a count, the xor of its digests
and the xor of their checks. Sketches of two versions subtract cell by cell: what both hold
cancels. Peeling takes a cell with a single digest, removes that digest everywhere, and goes on; if all
cells empty, exactly the differing digests have been recovered. If not, the versions are sketched
GROWTH times larger. How large to begin is estimated from a sample of the digests. The likeness of two versions is the
share of common digests among all, from the recovered differences and the digest counts.

All of it happens within a row, on arrays that are sorted and run through once, so cost is a
text's length times its logarithm, and nothing is shuffled.

Defined results: a null or empty text has no digests and the fingerprint of nothing; two such
are alike (1.0). Repeated paragraphs of a text count once. Rows, repeated ones too, are independent; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import id_and_text

PARAGRAPH_WORDS = 32
PARAGRAPH = rf"\S++(?:[^\S\n]++\S++){{0,{PARAGRAPH_WORDS - 1}}}+"
#: Cells of a sub-table in a stored fingerprint, growth of a retry, and retries; the last of them
#: has sub-tables of 8 * 4 ** 10 cells, more than a text that fits into a value has paragraphs.
CELLS, GROWTH, RETRIES = 8, 4, 10
#: Rounds of peeling; a sketch that is large enough empties in far fewer.
ROUNDS = 60
#: Digests are sampled by their highest bits, and a sub-table first has ROOM cells for each digest expected to differ:
#: only cells that are not empty are held, and in a roomy sketch most digests are alone in one from the start.
SAMPLE_BITS, ROOM = 2, 2
MOST_CELLS = CELLS * GROWTH**RETRIES
CELL = "struct<cell:int,count:int,key:bigint,proof:bigint>"
DIGEST = "struct<digest:bigint,sign:int,proof:bigint>"


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    paragraphs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(paragraphs, lambda paragraph: F.xxhash64(paragraph)))


def _entries(found: Column, size: Column) -> Column:
    """The three one-digest cells of each signed digest."""

    def cells(each: Column) -> Column:
        digest = each["digest"]
        return F.array(
            *(
                F.struct(
                    (F.pmod(F.shiftrightunsigned(digest, 21 * table), size) + size * table).cast("int").alias("cell"),
                    each["sign"].alias("count"),
                    digest.alias("key"),
                    each["proof"].alias("proof"),
                )
                for table in range(3)
            )
        )

    return F.flatten(F.transform(found, cells))


def _merged(cells: Column) -> Column:
    """Cells with the same number added up; those that come to nothing are left out."""

    def add(total: Column, cell: Column) -> Column:
        return F.struct(
            cell["cell"].alias("cell"),
            (total["count"] + cell["count"]).alias("count"),
            total["key"].bitwiseXOR(cell["key"]).alias("key"),
            total["proof"].bitwiseXOR(cell["proof"]).alias("proof"),
        )

    def by_run(order: Column) -> Column:
        heads = F.filter(
            F.sequence(F.lit(0), F.size(order) - 1),
            lambda at: (at == 0) | (_cell(F.get(order, at)) != _cell(F.get(order, at - 1))),
        )

        def run(starts: Column, at: Column, number: Column) -> Column:
            first = F.get(cells, _place(F.get(order, at)))
            count = F.coalesce(F.get(starts, number + 1), F.size(order)) - at
            rest = F.aggregate(
                F.slice(order, at + 2, count - 1), first, lambda total, each: add(total, F.get(cells, _place(each)))
            )
            return F.when(count == 1, first).otherwise(rest)

        return let(
            heads,
            lambda starts: F.filter(
                F.transform(starts, lambda at, number: run(starts, at, number)),
                lambda cell: (cell["count"] != 0) | (cell["key"] != 0) | (cell["proof"] != 0),
            ),
        )

    # numbers sort faster than structs: the cell, then the place in the array
    order = F.sort_array(
        F.transform(cells, lambda cell, place: F.shiftleft(cell["cell"].cast("bigint"), 31).bitwiseOR(place.cast("bigint")))
    )
    return F.when(F.size(cells) > 0, let(order, by_run)).otherwise(cells)


def _cell(numbered: Column) -> Column:
    return F.shiftright(numbered, 31)


def _place(numbered: Column) -> Column:
    return numbered.bitwiseAND(F.lit(2**31 - 1).cast("bigint")).cast("int")


def _signed(found: Column, sign: int) -> Column:
    return F.transform(
        found, lambda digest: F.struct(digest.alias("digest"), F.lit(sign).alias("sign"), F.xxhash64(digest).alias("proof"))
    )


def _alone(cells: Column, sign: int) -> Column:
    """The digests of one sign that are alone in a cell, once for each such cell."""
    return F.transform(
        F.filter(cells, lambda cell: (cell["count"] == sign) & (cell["proof"] == F.xxhash64(cell["key"]))), lambda cell: cell["key"]
    )


def sketch(found: Column, size: Column | None = None) -> Column:
    """The cells of a set of digests, by number, without empty ones; `size` cells in each sub-table."""
    size = F.lit(CELLS) if size is None else size
    return let(_entries(_signed(found, 1), size), _merged)


def subtract(left: Column, right: Column) -> Column:
    """Cells of the difference of two sketches of the same size."""
    negative = F.transform(
        right,
        lambda cell: F.struct(
            cell["cell"].alias("cell"), (-cell["count"]).alias("count"), cell["key"].alias("key"), cell["proof"].alias("proof")
        ),
    )
    return let(F.concat(left, negative), _merged)


def _difference(left: Column, right: Column, size: Column) -> Column:
    """What subtracting the sketches of two sets gives, made in one go."""
    return let(_entries(F.concat(_signed(left, 1), _signed(right, -1)), size), _merged)


def peel(difference: Column, size: Column) -> Column:
    """(cells, found, stuck): the digests recovered, +1 of the left and -1 of the right sketch, and the cells left over.

    Without cells left over, the recovery is complete.
    """
    start = F.struct(
        difference.alias("cells"), F.array().cast(f"array<{DIGEST}>").alias("found"), (F.size(difference) == 0).alias("stuck")
    )

    def remove(so_far: Column, single: Column) -> Column:
        opposite = F.transform(
            single, lambda each: F.struct(each["digest"].alias("digest"), (-each["sign"]).alias("sign"), each["proof"].alias("proof"))
        )
        return let(
            let(F.concat(so_far["cells"], _entries(opposite, size)), _merged),
            lambda left: F.struct(
                left.alias("cells"), F.concat(so_far["found"], single).alias("found"), (F.size(left) == 0).alias("stuck")
            ),
        )

    def one_round(so_far: Column, _: Column) -> Column:
        # as plain numbers: those are told apart by hashing, structs by comparing all
        single = F.concat(*(_signed(F.array_distinct(_alone(so_far["cells"], sign)), sign) for sign in (1, -1)))
        stuck = F.struct(so_far["cells"].alias("cells"), so_far["found"].alias("found"), F.lit(True).alias("stuck"))
        return F.when(so_far["stuck"], so_far).otherwise(
            let(single, lambda peeled: F.when(F.size(peeled) == 0, stuck).otherwise(remove(so_far, peeled)))
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one_round)


def estimated(left: Column, right: Column) -> Column:
    """About how many digests two sets differ in, from those whose SAMPLE_BITS highest bits are zero."""

    def sample(found: Column) -> Column:
        return F.filter(found, lambda digest: F.shiftrightunsigned(digest, 64 - SAMPLE_BITS) == 0)

    def apart(some: Column, others: Column) -> Column:
        return F.size(F.array_except(some, others)) + F.size(F.array_except(others, some))

    sampled = let(sample(left), lambda some: let(sample(right), lambda others: apart(some, others)))
    return F.greatest(F.abs(F.size(left) - F.size(right)), sampled * 2**SAMPLE_BITS)


def differing(left: Column, right: Column, left_sketch: Column, right_sketch: Column) -> Column:
    """The signed digests in which two sets differ, recovered from their sketches.

    The given sketches are of the stored size, and are used if they have room for the estimated difference. If not, or if they
    turn out too small, larger ones are made from the sets. The last resort after all retries is the sets themselves.
    """

    def tried(size: Column) -> Column:
        return F.when(size == CELLS, peel(subtract(left_sketch, right_sketch), F.lit(CELLS))).otherwise(
            peel(_difference(left, right, size), size)
        )

    def climb(first: Column) -> Column:
        def larger(so_far: Column, retry: Column) -> Column:
            size = F.least(first * F.pow(F.lit(GROWTH), retry), F.lit(MOST_CELLS)).cast("int")
            return F.when(F.size(so_far["cells"]) == 0, so_far).otherwise(
                let(size, lambda cells: peel(_difference(left, right, cells), cells))
            )

        return F.aggregate(
            F.sequence(F.lit(1), F.lit(RETRIES)),
            tried(first),
            larger,
            lambda last: F.when(F.size(last["cells"]) == 0, last["found"]).otherwise(exact),
        )

    exact = F.concat(_signed(F.array_except(left, right), 1), _signed(F.array_except(right, left), -1))
    return let(F.least(F.greatest(F.lit(CELLS), ROOM * estimated(left, right)), F.lit(MOST_CELLS)).cast("int"), climb)


def likeness(left: Column, right: Column, difference: Column) -> Column:
    """Common digests among all digests, from 0 to 1. The difference is named twice: give a column that holds it."""
    both, apart = F.size(left) + F.size(right), F.size(difference)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - apart).cast("double") / (both + apart))


def written(cells: Column) -> Column:
    """A sketch as text: cell, count, digests and proofs of each cell that is not empty."""
    return F.array_join(
        F.transform(
            cells,
            lambda cell: F.concat_ws(".", cell["cell"].cast("string"), cell["count"].cast("string"), F.hex(cell["key"]), F.hex(cell["proof"])),
        ),
        "-",
    )


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digests, sketch, fingerprint) of every row."""
    rows = id_and_text(df, id_col, text_col).select("doc_id", digests(F.col("text")).alias("digests"))
    return rows.withColumn("sketch", sketch(F.col("digests"))).withColumn("fingerprint", written(F.col("sketch")))


def compare(df: DataFrame, left: str, right: str, into: str) -> DataFrame:
    """Adds `into`: (near, removed, added) between two columns of digests, removed and added being digests."""
    found = F.col("_difference")
    described = F.struct(
        likeness(F.col(left), F.col(right), found).alias("near"),
        F.transform(F.filter(found, lambda each: each["sign"] == 1), lambda each: each["digest"]).alias("removed"),
        F.transform(F.filter(found, lambda each: each["sign"] == -1), lambda each: each["digest"]).alias("added"),
    )
    difference = differing(F.col(left), F.col(right), sketch(F.col(left)), sketch(F.col(right)))
    return df.withColumn("_difference", difference).withColumn(into, described).drop("_difference")
