"""Batch scan of a bronze folder."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.schemas import BRONZE_DAY, UNDATED
from reelhouse.sources.errors import MissingInput

NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_bronze(spark: SparkSession, path: str, columns: dict[str, str], since: datetime.date | None = None) -> DataFrame:
    """Scan the committed files of a bronze folder; nothing is created if it is missing.

    `since` reads only the folders of that and later ingestion days, of bronze written by day, and always the folder
    of rows without a usable timestamp: when they came is not known.
    """
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in NO_DATA:
            raise MissingInput(f"no bronze data at {path}; run the bronze job first") from error
        raise
    absent = [name for name in columns if name not in found.columns]
    if absent:
        raise MissingInput(f"bronze data at {path} lacks the columns {absent}")
    if since is not None:
        if BRONZE_DAY not in found.columns:
            raise MissingInput(f"bronze data at {path} is not written by day; it can only be read whole")
        day = F.col(BRONZE_DAY).cast("string")
        found = found.where((day >= since.isoformat()) | (day == UNDATED) | day.isNull())
    return found.select(*columns)
