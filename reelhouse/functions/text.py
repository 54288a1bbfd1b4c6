"""Column rules of the clean step. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marks removed from list columns. Single quotes stay.
LIST_MARKS = r'[\[\]"]'


def trimmed(name: str) -> Column:
    """Strip ASCII spaces only; tabs, newlines and no-break spaces stay."""
    return F.trim(F.col(name))


def upper_trimmed(name: str) -> Column:
    return F.upper(trimmed(name))


def list_text(name: str) -> Column:
    """Bracketed list text without its brackets and double quotes.

    The trim runs first, so padding inside the brackets stays.
    """
    return F.regexp_replace(trimmed(name), LIST_MARKS, "")


def integer(name: str) -> Column:
    """A no-op on decoded data; null, not a failed job, on text that is no integer."""
    return F.col(name).try_cast("int")


def double(name: str) -> Column:
    return F.col(name).try_cast("double")


def date_of(name: str) -> Column:
    """The date of a timestamp text; null on bad text, so one row cannot fail a batch."""
    return F.try_to_date(F.col(name))
