"""Columns that the ingest adds to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.schemas import INGESTION_TIME_FORMAT


def tag(df: DataFrame, platform: str, ingested_at: str | None = None) -> DataFrame:
    """Add the platform and the ingestion time, one value for all rows of a run."""
    time = F.lit(ingested_at) if ingested_at else F.date_format(F.current_timestamp(), INGESTION_TIME_FORMAT)
    return df.withColumns({"platform": F.lit(platform), "ingestion_timestamp": time})
