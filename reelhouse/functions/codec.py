"""JSON events: rows to message values and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.schemas import ddl

RAW_TEXT = "_raw_text"


def encode(df: DataFrame) -> DataFrame:
    """One UTF-8 JSON object per row in a binary `value` column; nulls are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).cast("binary").alias("value"))


def _parsed(columns: dict[str, str], options: dict[str, str] | None = None) -> Column:
    return F.from_json(F.col("value").cast("string"), ddl(columns), options)


def decode(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Typed columns from a `value` column of JSON bytes.

    Field names are case-sensitive, unknown fields are ignored, a bad field is null and
    a message that is no JSON object gives an all-null row.
    """
    return df.select(_parsed(columns).alias("event")).select("event.*")


def decode_with_raw(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Like `decode`, keeping the other input columns and adding the raw text.

    The raw text is null unless the message, or one of its fields, did not decode.
    """
    kept = [name for name in df.columns if name != "value"]
    event = _parsed(columns | {RAW_TEXT: "string"}, {"columnNameOfCorruptRecord": RAW_TEXT})
    return df.select(*kept, event.alias("event")).select(*kept, "event.*")


def rejects(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Raw text of the messages that did not decode completely."""
    return decode_with_raw(df, columns).where(F.col(RAW_TEXT).isNotNull()).select(RAW_TEXT)
