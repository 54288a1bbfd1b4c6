"""Star schema over the transformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse import schemas


def dim_title(titles: DataFrame) -> DataFrame:
    return titles.select(*schemas.DIM_TITLE)


def dim_person(credits: DataFrame) -> DataFrame:
    """Distinct (person, name) pairs: a person known under two names has two rows."""
    return credits.select(*schemas.DIM_PERSON).distinct()


def fact_credits(credits: DataFrame) -> DataFrame:
    return credits.select(*(F.col(name).alias(alias) for name, alias in schemas.FACT_CREDITS.items()))
