"""Secret scanning with DataFrame functions only.

Base rules find assignments to secret-like names, access key ids and long hex strings. Beside them, every
long string of key-like characters is a candidate: a window slides over it, the Shannon entropy of
the window follows from counts that change by the one character that enters and the one that leaves,
and a candidate is reported from its first to its last window above the threshold of its character class,
unless the allow-list knows it or a base span holds it. Words of the allow-list end a candidate, so that no window
overlaps them; what stands beside them is still looked at. A class asks for several kinds of characters, which paths, slugs,
words and numbers do not have.

Positions are code points, ends exclusive. Java's regular expressions give the matches of a text and
the pieces between them, whose lengths add up to positions.

Defined results: a null or empty text has no spans. Spans are ordered by start, then kind as in KINDS.
Rows, repeated ones too, are scanned separately; an empty table gives no rows; other columns are ignored. The
scan is narrow, and its cost linear in a text's length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import id_and_text

# The base rules.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: What is asked of all texts first; most have no match, and are not taken apart.
HAS_ACCESS = rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}"
HAS_HEX = rf"[0-9a-f]{{{LEAST_HEX},}}"

#: Characters of an entropy window, and candidate strings, which hold at least one window.
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: (kind, what all of a candidate is made of, what it has to hold, least bits per character), the first that fits
CLASSES = (
    ("entropy_hex", r"^[0-9a-fA-F]+$", ("[0-9]", "[a-fA-F]"), 2.9),
    ("entropy_letters", r"^[A-Za-z]+$", ("[a-z]", "[A-Z]"), 3.9),
    ("entropy_alnum", r"^[A-Za-z0-9]+$", ("[0-9]", "[A-Za-z]"), 3.5),
    ("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", ("[0-9]", "[a-z]", "[A-Z]"), 3.7),
)
KINDS = ("assign", "access", "hex", *(kind for kind, *_ in CLASSES))
#: Candidates that are no secrets: ids in UUID form, rows of one sign.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(.)\1+$",
)
#: Words in either case that are no part of a secret: alphabets, placeholders.
ALLOWED_WORDS = ("0123456789abcdef", "abcdefghijklmnop", "placeholder", "changeme", "example", "dummy", "your_", "your-")
#: Characters that counts are kept of: ASCII from the space on.
FIRST_SIGN, SIGNS = 32, 96
SPAN = "struct<start:long,rank:int,kind:string,end:long>"
CHUNK = 256


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, combine) -> Column:
    """What `combine` makes of 0 and the elements before each element, in chunks: growing one array would be quadratic."""
    pair = "struct<sums:array<long>,total:long>"
    zero = F.lit(0).cast("long")

    def from_first(values: Column, first: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(F.array().cast("array<long>").alias("sums"), first.alias("total")).cast(pair),
            lambda so_far, value: F.struct(
                F.concat(so_far["sums"], F.array(so_far["total"])).alias("sums"), combine(so_far["total"], value).alias("total")
            ),
        )["sums"]

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
        lambda number: F.slice(values, number * CHUNK + 1, F.lit(CHUNK)),
    )
    return let(
        chunks,
        lambda parts: let(
            from_first(F.transform(parts, lambda part: F.aggregate(part, zero, combine)), zero),
            lambda firsts: F.flatten(F.transform(parts, lambda part, number: from_first(part, F.get(firsts, number)))),
        ),
    )


def running_sums(lengths: Column) -> Column:
    """Sums before each element."""
    return running(lengths, lambda a, b: a + b)


def located(text: Column, regex: str, group: int = 0) -> Column:
    """Every match, leftmost and not overlapping: array of (match, group, start, end).

    Only for texts that have a match.
    """
    taken = F.struct(
        F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(regex), F.lit(group)).alias("groups"),
        F.split(text, regex, -1).alias("gaps"),
    )

    def place(parts: Column) -> Column:
        def gap(number: Column) -> Column:
            return F.char_length(F.get(parts["gaps"], number)).cast("long")

        lengths = F.transform(parts["found"], lambda match, number: gap(number) + F.char_length(match))
        return let(
            let(lengths, running_sums),
            lambda before: F.transform(
                parts["found"],
                lambda match, number: F.struct(
                    match.alias("match"),
                    F.get(parts["groups"], number).alias("group"),
                    (F.get(before, number) + gap(number)).alias("start"),
                    (F.get(before, number) + gap(number) + F.char_length(match)).alias("end"),
                ),
            ),
        )

    return let(taken, place)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(
        start.cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.cast("long").alias("end")
    )


def base_spans(text: Column, kind: str, has: str, regex: str, least: int, group: int = 0) -> Column:
    hits = F.filter(located(text, regex, group), lambda hit: F.char_length(hit["group"]) >= least)
    return F.when(text.rlike(has), F.transform(hits, lambda hit: _span(kind, hit["start"], hit["end"]))).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )


def entropy_windows(candidate: Column, threshold: Column, window: int = WINDOW) -> Column:
    """(first, last, peak): where the first and last window of at least `threshold` bits begin, or -1.

    The entropy of a window is log2(w) - sum(c * log2(c)) / w over its character counts c. When a character
    comes in that the window holds c times, the sum grows by gain(c) = (c+1)log2(c+1) - c log2(c);
    when one leaves that it held c+1 times, it shrinks by the same.
    """
    gain = F.array(*(F.lit(_weight(count + 1) - _weight(count)) for count in range(window + 1)))
    state = "struct<sum:double,counts:array<int>,first:int,last:int,peak:double>"

    def changed(counts: Column, sign: Column, by: int) -> Column:
        return F.concat(F.slice(counts, 1, sign), F.array(F.get(counts, sign) + by), F.slice(counts, sign + 2, F.lit(SIGNS)))

    def after(so_far: Column, at: Column, total: Column, counts: Column) -> Column:
        """A new state, with the window that begins at `at` judged by the old one if it is a whole one."""
        bits = F.lit(math.log2(window)) - so_far["sum"] / window
        high = (at >= 0) & (bits >= threshold - 1e-9)
        return F.struct(
            total.alias("sum"),
            counts.alias("counts"),
            F.when(high & (so_far["first"] < 0), at).otherwise(so_far["first"]).alias("first"),
            F.when(high, at).otherwise(so_far["last"]).alias("last"),
            F.when(at >= 0, F.greatest(so_far["peak"], bits)).otherwise(so_far["peak"]).alias("peak"),
        ).cast(state)

    def slide(signs: Column) -> Column:
        def step(so_far: Column, at: Column) -> Column:
            leaving, coming = F.get(signs, at - window), F.get(signs, at)
            lost = F.when(at >= window, F.get(gain, F.get(so_far["counts"], leaving) - 1)).otherwise(F.lit(0.0))
            left = F.when(at >= window, changed(so_far["counts"], leaving, -1)).otherwise(so_far["counts"])
            return let(
                left,
                lambda counts: after(
                    so_far, at - window, so_far["sum"] - lost + F.get(gain, F.get(counts, coming)), changed(counts, coming, 1)
                ),
            )

        start = F.struct(
            F.lit(0.0).alias("sum"), F.array_repeat(F.lit(0), SIGNS).alias("counts"), F.lit(-1).alias("first"), F.lit(-1).alias("last"),
            F.lit(0.0).alias("peak"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(signs) - 1),
            start.cast(state),
            step,
            lambda so_far: after(so_far, F.size(signs) - window, so_far["sum"], so_far["counts"]),
        )

    return let(F.transform(F.split(candidate, ""), lambda sign: F.ascii(sign) - FIRST_SIGN), slide)


def _weight(count: int) -> float:
    return count * math.log2(count) if count else 0.0


def without_words(text: Column, words: tuple[str, ...] = ALLOWED_WORDS) -> Column:
    """The text with words, in either case, replaced by as many signs that no candidate holds."""
    for word in words:
        text = F.regexp_replace(text, f"(?i){word}", "." * len(word))
    return text


def entropy_spans(text: Column, base: Column, allowed: tuple[str, ...] = ALLOWED, words: tuple[str, ...] = ALLOWED_WORDS) -> Column:
    """Spans of high entropy, but those that the allow-list or a base span covers."""
    none = F.array().cast(f"array<{SPAN}>")

    def of_candidate(hit: Column) -> Column:
        match = hit["match"]
        allow = F.lit(False)
        for pattern in allowed:
            allow = allow | match.rlike(pattern)
        kind, bits, rank = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("int")
        for name, regex, holds, least in reversed(CLASSES):
            fits = match.rlike(regex)
            for held in holds:
                fits = fits & match.rlike(held)
            kind = F.when(fits, F.lit(name)).otherwise(kind)
            bits = F.when(fits, F.lit(least)).otherwise(bits)
            rank = F.when(fits, F.lit(KINDS.index(name))).otherwise(rank)
        return F.when(
            ~allow & bits.isNotNull(),
            let(
                entropy_windows(match, bits),
                lambda found: F.when(
                    found["first"] >= 0,
                    F.struct(
                        (hit["start"] + found["first"]).cast("long").alias("start"),
                        rank.alias("rank"),
                        kind.alias("kind"),
                        (hit["start"] + found["last"] + WINDOW).cast("long").alias("end"),
                    ),
                ),
            ),
        )

    spans = F.transform(located(without_words(text, words), CANDIDATE), of_candidate)
    new = F.filter(
        spans,
        lambda span: span.isNotNull()
        & ~F.exists(base, lambda held: (held["start"] <= span["start"]) & (span["end"] <= held["end"])),
    )
    return F.when(text.rlike(CANDIDATE), F.when(without_words(text, words).rlike(CANDIDATE), new).otherwise(none)).otherwise(none)


def add_spans(
    df: DataFrame, text_col: str = "text", allowed: tuple[str, ...] = ALLOWED, words: tuple[str, ...] = ALLOWED_WORDS
) -> DataFrame:
    """The frame with two more columns: `base` with the base spans and `spans` with all, as arrays of (start, rank, kind, end)."""
    text = F.coalesce(df[text_col], F.lit(""))
    found = df.withColumn(
        "base",
        F.array_sort(
            F.concat(
                base_spans(text, "assign", ASSIGN, ASSIGN, LEAST_ASSIGNED, 2),
                base_spans(text, "access", HAS_ACCESS, ACCESS, LEAST_ACCESS),
                base_spans(text, "hex", HAS_HEX, HEX, LEAST_HEX),
            )
        ),
    )
    return found.withColumn("spans", F.array_sort(F.concat("base", entropy_spans(text, F.col("base"), allowed, words))))


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    allowed: tuple[str, ...] = ALLOWED,
    words: tuple[str, ...] = ALLOWED_WORDS,
) -> DataFrame:
    """(doc_id, text, base, spans) of every row."""
    return add_spans(id_and_text(df, id_col, text_col), "text", allowed, words)


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span replaced by `mark`; spans that overlap or touch become one.

    The spans are ordered by start. What lies between them is cut from blocks of the text, so that a place far
    into a long text is not counted out from its beginning for each span.
    """
    size = F.char_length(text).cast("long")
    given = F.struct(
        text.alias("text"),
        spans.alias("spans"),
        size.alias("size"),
        F.greatest(F.lit(4096), 8 * F.floor(F.sqrt(size))).cast("int").alias("block"),
        F.transform(spans, lambda span: span["end"]).alias("ends"),
    )

    def prepared(row: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0).cast("long"), F.floor(row["size"] / row["block"])),
            lambda number: F.substring(row["text"], (number * row["block"] + 1).cast("int"), row["block"]),
        )
        covered = running(row["ends"], lambda a, b: F.greatest(a, b))
        parts = F.struct(blocks.alias("blocks"), covered.alias("covered"))
        return let(parts, lambda taken: pieces(row, taken))

    def pieces(row: Column, taken: Column) -> Column:
        block = row["block"]

        def cut(begin: Column, end: Column) -> Column:
            """Code points from begin to end, of one block or of several."""
            first, last = F.floor(begin / block).cast("int"), F.floor(end / block).cast("int")
            skipped = (begin - first * block).cast("int")
            opening = F.get(taken["blocks"], first)
            return F.when(first == last, F.substring(opening, skipped + 1, (end - begin).cast("int"))).otherwise(
                F.concat(
                    F.substring(opening, skipped + 1, block),
                    F.array_join(F.slice(taken["blocks"], first + 2, last - first - 1), ""),
                    F.substring(F.get(taken["blocks"], last), F.lit(1), (end - last * block).cast("int")),
                )
            )

        def start(number: Column) -> Column:
            return F.get(row["spans"], number)["start"]

        def before(number: Column) -> Column:
            return F.get(taken["covered"], number)

        heads = F.filter(
            F.sequence(F.lit(0), F.size(row["spans"]) - 1), lambda number: (number == 0) | (start(number) > before(number))
        )
        between = F.transform(heads, lambda number: cut(before(number), start(number)))
        return F.concat(between, F.array(cut(F.array_max(row["ends"]), row["size"])))

    return F.when(F.size(spans) > 0, F.array_join(let(given, prepared), mark)).otherwise(text)
