"""Catalog database, managed tables and the persistent view."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reelhouse.schemas import POPULARITY_VIEW
from reelhouse.sinks.folders import remove_folder, subfolders


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")


def write_table(df: DataFrame, database: str, table: str) -> DataFrame:
    """Replace the rows of a managed table and return a scan of what was written.

    All files are written to a new folder first. Only then is the table pointed to it, by one
    metadata step, so a failed write leaves the old rows, and a reader sees old or new ones. The
    folder before the last is removed: readers that began before the switch can finish.

    If the columns changed, a table with the new ones is prepared. The old one is renamed aside, the new one takes
    its name, and only then the old one is dropped; if the name cannot be taken, the old one gets it back. A catalog
    renames one table at a time, so a reader may find no table between the two steps.

    A table that is missing is created before any file is written, so a run that dies half-way never
    leaves files without a table, which would block the next one.
    """
    spark = df.sparkSession
    name = f"`{database}`.`{table}`"
    if not spark.catalog.tableExists(name):
        _create(spark, name, df)
    own = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"
    versions = f"{own}__versions"
    folder = f"{versions}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    before = _location(spark, name)
    if spark.table(name).dtypes == df.dtypes:
        _point(spark, name, folder)
    else:
        prepared = f"`{database}`.`{table}__{uuid.uuid4().hex}`"
        _create(spark, prepared, df)
        _point(spark, prepared, folder)
        _take_name(spark, prepared, name, f"`{database}`.`{table}__{uuid.uuid4().hex}`", own)
    spark.catalog.refreshTable(name)
    kept = {_last(before), _last(_location(spark, name))}
    for place in subfolders(spark, versions):
        if _last(place) not in kept:
            remove_folder(spark, place)
    return spark.table(name)


def _take_name(spark: SparkSession, prepared: str, name: str, aside: str, own: str) -> None:
    """Give a prepared table the name of another, which is dropped last and keeps its name on failure."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        remove_folder(spark, own)  # made with the table, and in the way of the new one's name
        spark.sql(f"ALTER TABLE {prepared} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        spark.sql(f"DROP TABLE {prepared}")
        raise
    spark.sql(f"DROP TABLE {aside}")


def _create(spark: SparkSession, name: str, df: DataFrame) -> None:
    listed = ", ".join(f"`{column}` {kind}" for column, kind in df.dtypes)
    spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet")


def _point(spark: SparkSession, name: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(folder)}")


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def _last(place: str) -> str:
    return place.rstrip("/").rpartition("/")[2]


def create_popularity_view(spark: SparkSession, database: str) -> DataFrame:
    """View of the average popularity and score per platform and release year."""
    name = f"`{database}`.`{POPULARITY_VIEW}`"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        SELECT
          platform,
          release_year,
          avg(tmdb_popularity) AS avg_tmdb_popularity,
          avg(imdb_score) AS avg_imdb_score
        FROM `{database}`.dim_title
        GROUP BY platform, release_year
    """)
    return spark.table(name)
