"""SQL counterpart of each registered query, for the given tables as views."""

from __future__ import annotations

from reelhouse import schemas
from reelhouse.registry import analysis_oracles
from reelhouse.registry.inputs import ODD_TIMES, oracle_ctes

CREDIT_COLUMNS = ", ".join(schemas.CREDITS)

# The transformed tables, still with NaN and dates as they are.
CLEAN_CTES = """
titles_cleaned AS (
  SELECT
    trim(id, ' ') AS id, trim(title, ' ') AS title, upper(trim(show_type, ' ')) AS show_type,
    trim(description, ' ') AS description, release_year,
    upper(trim(age_certification, ' ')) AS age_certification, runtime,
    regexp_replace(trim(genres, ' '), '[\\[\\]"]', '', 'g') AS genres,
    regexp_replace(trim(production_countries, ' '), '[\\[\\]"]', '', 'g') AS production_countries,
    seasons, imdb_id, CAST(imdb_score AS DOUBLE) AS imdb_score, imdb_votes,
    CAST(tmdb_popularity AS DOUBLE) AS tmdb_popularity, CAST(tmdb_score AS DOUBLE) AS tmdb_score,
    trim(platform, ' ') AS platform, ingestion_timestamp,
    CAST(TRY_CAST(ingestion_timestamp AS TIMESTAMP) AS DATE) AS ingestion_date
  FROM bronze_titles
),
titles_required AS (
  SELECT * FROM titles_cleaned WHERE id IS NOT NULL AND title IS NOT NULL AND platform IS NOT NULL
),
titles AS (
  SELECT * FROM titles_required
  QUALIFY row_number() OVER (PARTITION BY id, platform ORDER BY ingestion_timestamp DESC NULLS LAST,
    title NULLS LAST, show_type NULLS LAST, description NULLS LAST, release_year NULLS LAST,
    age_certification NULLS LAST, runtime NULLS LAST, genres NULLS LAST, production_countries NULLS LAST,
    seasons NULLS LAST, imdb_id NULLS LAST, imdb_score NULLS LAST, imdb_votes NULLS LAST,
    tmdb_popularity NULLS LAST, tmdb_score NULLS LAST, ingestion_date NULLS LAST) = 1
),
credits_cleaned AS (
  SELECT trim(person_ID, ' ') AS person_ID, trim(id, ' ') AS id, trim(name, ' ') AS name,
    trim(character_name, ' ') AS character_name, upper(trim(role, ' ')) AS role,
    trim(platform, ' ') AS platform, ingestion_timestamp
  FROM bronze_credits
),
credits_required AS (
  SELECT * FROM credits_cleaned WHERE person_ID IS NOT NULL AND id IS NOT NULL AND platform IS NOT NULL
),
credits AS (
  SELECT * FROM credits_required
  QUALIFY row_number() OVER (PARTITION BY person_ID, id, role, platform
    ORDER BY ingestion_timestamp DESC NULLS LAST, name NULLS LAST, character_name NULLS LAST) = 1
)
"""

NAN_FLAGGED = """
  CASE WHEN NOT isnan(tmdb_popularity) THEN CAST(tmdb_popularity AS DOUBLE) END AS tmdb_popularity,
  CAST(coalesce(isnan(tmdb_popularity), FALSE) AS INT) AS tmdb_popularity_is_nan
"""


def _columns(names, **replaced: str) -> str:
    """A select list in which some columns are given as an expression."""
    shown = {
        "imdb_score": "CAST(imdb_score AS DOUBLE) AS imdb_score",
        "tmdb_score": "CAST(tmdb_score AS DOUBLE) AS tmdb_score",
        "tmdb_popularity": NAN_FLAGGED,
        "ingestion_date": "strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date",
    } | replaced
    return ", ".join(shown.get(name, name) for name in names)


BRONZE_TITLE_COLUMNS = _columns(schemas.TITLES)
TITLE_COLUMNS = _columns([*schemas.TITLES, "ingestion_date"])
TAGGED_COLUMNS = _columns(
    schemas.TITLES,
    platform="trim(platform, ' ') AS platform",
    ingestion_timestamp="'2024-03-01 05:00:00' AS ingestion_timestamp",
)
TAGGED_CREDIT_COLUMNS = _columns(
    schemas.CREDITS,
    platform="trim(platform, ' ') AS platform",
    ingestion_timestamp="'2024-03-01 05:00:00' AS ingestion_timestamp",
)
CSV_CREDIT_COLUMNS = ", ".join(schemas.csv_columns(schemas.CREDITS))


def _sampled(columns: str, table: str, order: list[str]) -> str:
    ranked = ", ".join(f"{name} ASC NULLS LAST" for name in order)
    return f"""
        SELECT {columns} FROM (
          SELECT * FROM {table}
          QUALIFY row_number() OVER (PARTITION BY trim(platform, ' ') ORDER BY {ranked}) <= 10
        ) AS sampled"""


def _on_days(columns: str, table: str) -> str:
    return f"""
        SELECT {columns}, day AS snapshot_date
        FROM {table}, (VALUES ('2024-03-01'), ('2024-03-02')) AS d(day)"""


def _drained(columns: str, table: str, second: str) -> str:
    return f"""
        SELECT {columns}, CAST(drain AS INT) AS drain
        FROM {table}, (VALUES (1, '{second}'), (2, '9'), (3, '9')) AS d(drain, before)
        WHERE ingestion_timestamp < before"""


# The text, integer and date columns of every output, by name.
_EXACT_TITLES = [
    "age_certification", "description", "genres", "id", "imdb_id", "imdb_votes", "ingestion_date", "ingestion_timestamp",
    "platform", "production_countries", "release_year", "runtime", "seasons", "show_type", "title",
]
_EXACT_CREDITS = ["character_name", "id", "ingestion_timestamp", "name", "person_ID", "platform", "role"]
_NO_FLOATS = ("imdb_score", "tmdb_popularity", "tmdb_score")


def _digest(output: str, table: str, columns: list[str]) -> str:
    written = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '~')" for name in columns)
    return f"""
        SELECT '{output}' AS output, count(*) AS row_count,
          CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {written})), 1, 8) AS BIGINT)) AS BIGINT) AS digest
        FROM {table}"""


def _best_rows(condition: str, metric: str) -> str:
    return f"(SELECT * FROM titles WHERE {condition} ORDER BY {metric} DESC NULLS LAST, titles.id LIMIT 100) AS best"


def _all_outputs() -> str:
    of_day = "(SELECT *, DATE '2024-03-01' AS snapshot_date FROM {}) AS dated"
    with_day = lambda names: sorted([*names, "snapshot_date"])
    return " UNION ALL ".join(
        [
            _digest("transformed_titles", "titles", _EXACT_TITLES),
            _digest("transformed_credits", "credits", _EXACT_CREDITS),
            _digest("dim_title", "titles", sorted(set(schemas.DIM_TITLE) - set(_NO_FLOATS))),
            _digest("dim_person", "(SELECT DISTINCT person_ID, name FROM credits) AS people", ["name", "person_ID"]),
            _digest("fact_credits", "credits", ["character_name", "id", "person_ID", "platform", "role"]),
            _digest("curated_netflix_popularity", _best_rows("platform = 'Netflix'", "titles.tmdb_popularity"), _EXACT_TITLES),
            _digest("curated_disney_trending", _best_rows("platform = 'Disney'", "titles.imdb_votes"), _EXACT_TITLES),
            _digest(
                "v_popularity_by_year",
                "(SELECT DISTINCT platform, release_year FROM titles) AS years",
                ["platform", "release_year"],
            ),
            _digest("snapshots/titles", of_day.format("titles"), with_day(_EXACT_TITLES)),
            _digest("snapshots/credits", of_day.format("credits"), with_day(_EXACT_CREDITS)),
        ]
    )


def _best(condition: str, metric: str) -> str:
    return f"""
        SELECT {TITLE_COLUMNS} FROM (
          SELECT * FROM titles WHERE {condition} ORDER BY {metric} DESC NULLS LAST, titles.id LIMIT 100
        ) AS best"""


BRONZE_TITLES = f"SELECT {BRONZE_TITLE_COLUMNS} FROM bronze_titles"
BRONZE_CREDITS = f"SELECT {CREDIT_COLUMNS} FROM bronze_credits"

# Relational databases hold no NaN: published as null.
PUBLISHED_TITLE_COLUMNS = _columns(
    [*schemas.TITLES, "ingestion_date"],
    tmdb_popularity="CASE WHEN NOT isnan(tmdb_popularity) THEN tmdb_popularity END AS tmdb_popularity",
)

BODIES = {
    "bronze_titles": BRONZE_TITLES,
    "bronze_credits": BRONZE_CREDITS,
    "csv_scan_titles": f"SELECT {_columns(schemas.csv_columns(schemas.TITLES))} FROM bronze_titles",
    "csv_scan_credits": f"SELECT {CSV_CREDIT_COLUMNS} FROM bronze_credits",
    "tag_union_titles": f"SELECT {TAGGED_COLUMNS} FROM bronze_titles",
    "tag_union_credits": f"SELECT {TAGGED_CREDIT_COLUMNS} FROM bronze_credits",
    "sample_titles": _sampled(TAGGED_COLUMNS, "bronze_titles", list(schemas.csv_columns(schemas.TITLES))),
    "sample_credits": _sampled(
        TAGGED_CREDIT_COLUMNS, "bronze_credits", list(schemas.csv_columns(schemas.CREDITS))
    ),
    "encode_titles": BRONZE_TITLES,
    "encode_credits": BRONZE_CREDITS,
    "decode_titles": BRONZE_TITLES,
    "decode_credits": BRONZE_CREDITS,
    "decode_event_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""",
    "quarantine": """
        SELECT
          imdb_id || ' ' || ingestion_timestamp AS event_key,
          CAST(release_year IS NULL AS INT) AS is_bad,
          CASE WHEN release_year IS NOT NULL THEN imdb_id END AS imdb_id
        FROM bronze_titles""",
    "quarantine_credits": """
        SELECT
          concat_ws(' ', character_name, person_ID, id, ingestion_timestamp) AS event_key,
          CAST(role IS NULL AS INT) AS is_bad,
          CASE WHEN role IS NOT NULL THEN character_name END AS character_name
        FROM bronze_credits""",
    "stream_bronze_titles": BRONZE_TITLES,
    "stream_bronze_credits": BRONZE_CREDITS,
    "stream_resume": _drained(BRONZE_TITLE_COLUMNS, "bronze_titles", "2024-01-02"),
    "stream_resume_credits": _drained(CREDIT_COLUMNS, "bronze_credits", "2024-01-05"),
    "stream_window_titles": BRONZE_TITLES,
    "stream_window_credits": BRONZE_CREDITS,
    "stream_quarantine": """
        SELECT 'lacking: ' || imdb_id || ' ' || ingestion_timestamp AS raw_text
        FROM bronze_titles WHERE release_year IS NULL""",
    "stream_quarantine_credits": """
        SELECT concat_ws(' ', 'lacking:', character_name, person_ID, id, ingestion_timestamp) AS raw_text
        FROM bronze_credits WHERE role IS NULL""",
    "csv_rejects": """
        SELECT imdb_id, imdb_id || ',' || CAST(seasons AS VARCHAR) || '.0' AS raw_text
        FROM bronze_titles WHERE seasons % 2 = 0""",
    "missing_input_titles": f"SELECT {BRONZE_TITLE_COLUMNS}, 1 AS refused_before FROM bronze_titles",
    "missing_input_credits": f"SELECT {CREDIT_COLUMNS}, 1 AS refused_before FROM bronze_credits",
    "csv_to_bronze_titles": f"SELECT {TAGGED_COLUMNS} FROM bronze_titles",
    "csv_to_bronze_credits": f"SELECT {TAGGED_CREDIT_COLUMNS} FROM bronze_credits",
    "strip_list_text": """
        SELECT id, regexp_replace(trim(genres, ' '), '[\\[\\]"]', '', 'g') AS genres,
          regexp_replace(trim(production_countries, ' '), '[\\[\\]"]', '', 'g') AS production_countries
        FROM bronze_titles""",
    "require_keys_titles": f"SELECT {TITLE_COLUMNS} FROM titles_required",
    "require_keys_credits": f"SELECT {CREDIT_COLUMNS} FROM credits_required",
    "titles_clean": f"SELECT {TITLE_COLUMNS} FROM titles",
    "credits_clean": f"SELECT {CREDIT_COLUMNS} FROM credits",
    "snapshot_titles": _on_days(TITLE_COLUMNS, "titles"),
    "snapshot_credits": _on_days(CREDIT_COLUMNS, "credits"),
    "snapshot_replaced_titles": _on_days(TITLE_COLUMNS, "titles"),
    "snapshot_replaced_credits": _on_days(CREDIT_COLUMNS, "credits"),
    "dim_title": f"SELECT {_columns(schemas.DIM_TITLE)} FROM titles",
    "dim_person": "SELECT DISTINCT person_ID, name FROM credits",
    "fact_credits": "SELECT person_ID AS person_id, id, role, platform, character_name FROM credits",
    "netflix_popularity": _best("platform = 'Netflix'", "titles.tmdb_popularity"),
    "netflix_popularity_nan_last": _best(
        "platform = 'Netflix'", "CASE WHEN NOT isnan(titles.tmdb_popularity) THEN titles.tmdb_popularity END"
    ),
    "disney_trending": _best("platform = 'Disney'", "titles.imdb_votes"),
    "popularity_by_year": """
        SELECT platform, release_year,
          CASE WHEN NOT isnan(popularity) THEN round(popularity, 6) END AS avg_tmdb_popularity,
          CAST(isnan(popularity) AS INT) AS avg_tmdb_popularity_is_nan,
          round(score, 6) AS avg_imdb_score
        FROM (
          SELECT platform, release_year, avg(tmdb_popularity) AS popularity, avg(imdb_score) AS score
          FROM titles GROUP BY platform, release_year
        ) AS grouped""",
    "transform_tables": _all_outputs(),
    "transform_incremental": _all_outputs(),
    "daily_run": _all_outputs(),
    "publish_job": _digest("transformed_titles", "titles", _EXACT_TITLES)
    + " UNION ALL "
    + _digest("transformed_credits", "credits", _EXACT_CREDITS),
    "publish_titles": f"SELECT {PUBLISHED_TITLE_COLUMNS} FROM titles",
    "publish_credits": f"SELECT {CREDIT_COLUMNS} FROM credits",
}


def oracle_sql() -> dict[str, str]:
    inputs = f"WITH {oracle_ctes()}, {CLEAN_CTES}"
    # the same rows after CSV exports of each platform were ingested at one time
    delivered = inputs.replace("bronze_titles AS (", "given_titles AS (").replace("bronze_credits AS (", "given_credits AS (")
    for entity in ("titles", "credits"):
        again = f"""bronze_{entity} AS (
            SELECT * REPLACE (trim(platform, ' ') AS platform, '2024-03-01 05:00:00' AS ingestion_timestamp)
            FROM given_{entity}), {entity}_cleaned AS ("""
        delivered = delivered.replace(f"{entity}_cleaned AS (", again, 1)
    odd = inputs.replace("bronze_titles AS (", "given_titles AS (").replace("bronze_credits AS (", "given_credits AS (")
    for entity, oddly in ODD_TIMES.items():
        odd = odd.replace(
            f"{entity}_cleaned AS (",
            f"bronze_{entity} AS (SELECT * REPLACE ({oddly} AS ingestion_timestamp) FROM given_{entity}), {entity}_cleaned AS (",
            1,
        )
    given = {"decode_event_props": "", "daily_run": delivered, "transform_incremental": odd}
    in_full = {name: f"{given.get(name, inputs)} SELECT * FROM ({body}) AS result" for name, body in analysis_oracles.BODIES.items()}
    return {name: f"{given.get(name, inputs)} {body}" for name, body in BODIES.items()} | in_full
