"""Names, types and constants of the catalogue data model.

Everything in this module is a fixed value: other systems read and write the same
topics, files and tables, so names, order and types have to stay as they are.
"""

from __future__ import annotations

# --- fixed values: bronze columns in order, with their Spark types ---------------
TITLES = {
    "id": "string",
    "title": "string",
    "show_type": "string",
    "description": "string",
    "release_year": "int",
    "age_certification": "string",
    "runtime": "int",
    "genres": "string",
    "production_countries": "string",
    "seasons": "int",
    "imdb_id": "string",
    "imdb_score": "float",
    "imdb_votes": "int",
    "tmdb_popularity": "float",
    "tmdb_score": "float",
    "platform": "string",
    "ingestion_timestamp": "string",
}
CREDITS = {
    "person_ID": "string",
    "id": "string",
    "name": "string",
    "character_name": "string",
    "role": "string",
    "platform": "string",
    "ingestion_timestamp": "string",
}

# --- fixed values: columns the ingest adds to what a platform's CSV file holds ----
TAG_COLUMNS = ("platform", "ingestion_timestamp")
INGESTION_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- fixed values: keys -----------------------------------------------------------
# The order within a key is free and decides how the transformed files are sorted:
# titles by platform, which marts and view filter on; credits by title, as they are joined by it.
TITLE_REQUIRED = ("id", "title", "platform")
TITLE_KEY = ("platform", "id")
CREDIT_REQUIRED = ("person_ID", "id", "platform")
CREDIT_KEY = ("id", "person_ID", "role", "platform")

# --- fixed values: star schema projections ----------------------------------------
DIM_TITLE = (
    "id",
    "title",
    "show_type",
    "release_year",
    "age_certification",
    "runtime",
    "imdb_id",
    "imdb_score",
    "imdb_votes",
    "tmdb_popularity",
    "tmdb_score",
    "platform",
    "genres",
    "production_countries",
)
DIM_PERSON = ("person_ID", "name")
# source column -> column in the fact table
FACT_CREDITS = {
    "person_ID": "person_id",
    "id": "id",
    "role": "role",
    "platform": "platform",
    "character_name": "character_name",
}

# --- fixed values: platforms, topics, database, tables ----------------------------
PLATFORMS = ("Netflix", "Disney", "Hulu", "Amazon")
TITLES_TOPIC = "ott_titles"
CREDITS_TOPIC = "ott_credits"
DATABASE = "ott"
TRANSFORMED_TITLES = "transformed_titles"
TRANSFORMED_CREDITS = "transformed_credits"
POPULARITY_VIEW = "v_popularity_by_year"
# table -> (platform, metric) of each top-N mart
MARTS = {
    "curated_netflix_popularity": ("Netflix", "tmdb_popularity"),
    "curated_disney_trending": ("Disney", "imdb_votes"),
}
MART_ROWS = 100

# --- fixed values: column types of the published tables ---------------------------
# Long text (description, genres, production_countries) is not listed: Spark cannot parse
# TEXT, and without a type the JDBC dialect picks the database's own unbounded text type.
PUBLISHED_TITLE_TYPES = {
    "id": "VARCHAR(64)",
    "title": "VARCHAR(512)",
    "show_type": "VARCHAR(16)",
    "release_year": "INT",
    "age_certification": "VARCHAR(16)",
    "runtime": "INT",
    "seasons": "INT",
    "imdb_id": "VARCHAR(32)",
    "imdb_score": "DOUBLE",
    "imdb_votes": "INT",
    "tmdb_popularity": "DOUBLE",
    "tmdb_score": "DOUBLE",
    "platform": "VARCHAR(32)",
    "ingestion_date": "DATE",
}
PUBLISHED_CREDIT_TYPES = {
    "person_ID": "VARCHAR(64)",
    "id": "VARCHAR(64)",
    "name": "VARCHAR(256)",
    "character_name": "VARCHAR(256)",
    "role": "VARCHAR(16)",
    "platform": "VARCHAR(32)",
}
JDBC_BATCH_ROWS = 5000
JDBC_WRITERS = 4

# --- fixed values: time limit of one streaming drain, in seconds ------------------
STREAM_WINDOW_SECS = 180

# Partition column of bronze folders that are written by day: the day of the ingestion timestamp. Rows whose timestamp is
# missing, in another form, or outside these years share one folder, so a foreign producer cannot make folders at will.
BRONZE_DAY = "ingestion_day"
UNDATED = "undated"
BRONZE_YEARS = (2000, 2099)

# Largest batch of a drain unless the caller sets another: Kafka records, or bytes of files. A batch is
# what a run commits at least, so it has to be small against a run and large against its overhead.
BATCH_OFFSETS = 50_000_000
BATCH_BYTES = 16 * 1024**3


def ddl(columns: dict[str, str]) -> str:
    """Spark DDL text of a name -> type mapping."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def csv_columns(columns: dict[str, str]) -> dict[str, str]:
    """The part of a bronze schema that comes from the platform's CSV file."""
    return {name: kind for name, kind in columns.items() if name not in TAG_COLUMNS}
