"""Clean step: one rule per column, one projection per entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.text import date_of, double, integer, list_text, trimmed, upper_trimmed
from reelhouse.schemas import CREDITS, TITLES

# Columns without a rule pass through.
TITLE_RULES = {
    "id": trimmed,
    "title": trimmed,
    "show_type": upper_trimmed,
    "description": trimmed,
    "release_year": integer,
    "age_certification": upper_trimmed,
    "runtime": integer,
    "genres": list_text,
    "production_countries": list_text,
    "seasons": integer,
    "imdb_score": double,
    "imdb_votes": integer,
    "tmdb_popularity": double,
    "tmdb_score": double,
    "platform": trimmed,
}
CREDIT_RULES = {
    "person_ID": trimmed,
    "id": trimmed,
    "name": trimmed,
    "character_name": trimmed,
    "role": upper_trimmed,
    "platform": trimmed,
}


def _cleaned(columns, rules):
    return [rules.get(name, F.col)(name).alias(name) for name in columns]


def clean_titles(bronze: DataFrame) -> DataFrame:
    return bronze.select(*_cleaned(TITLES, TITLE_RULES), date_of("ingestion_timestamp").alias("ingestion_date"))


def clean_credits(bronze: DataFrame) -> DataFrame:
    return bronze.select(*_cleaned(CREDITS, CREDIT_RULES))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose (text) keys are all present; blank text counts as present.

    Trimming neither makes nor removes nulls, so the rule gives the same rows before and
    after the clean step. The jobs apply it before, where the null checks are pushed
    into the Parquet scan; on a trimmed column they would not be.
    """
    return df.where(reduce(lambda left, right: left & right, (F.col(key).isNotNull() for key in keys)))
