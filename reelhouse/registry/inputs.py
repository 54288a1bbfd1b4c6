"""Bronze-shaped inputs derived from the given tables; see FIXTURES.md.

The SQL is the same for Spark and for the SQL check. Every row of `part`, `lineitem` and
`supplier` is used. The modulo conditions only choose which rows carry dirt, and the
second branch of `deliveries` adds redelivered rows; neither leaves rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TITLES_SQL = """
SELECT
  CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE ' tm' || CAST(p_partkey AS STRING) || ' ' END AS id,
  CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN '   ' ELSE '  ' || p_name END AS title,
  CASE WHEN p_partkey % 3 = 0 THEN ' show' ELSE 'movie ' END AS show_type,
  ' ' || p_type || ' item ' AS description,
  CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(1990 + p_size % 30 AS INT) END AS release_year,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE ' tv-' || CAST(p_size % 18 AS STRING) END AS age_certification,
  CAST(60 + p_size AS INT) AS runtime,
  ' ["' || lower(p_type) || '", "' || lower(p_brand) || '"] ' AS genres,
  CASE WHEN p_partkey % 2 = 0 THEN '["US"]' ELSE '[''GB'', ''US'']' END AS production_countries,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(1 + p_size % 9 AS INT) ELSE NULL END AS seasons,
  'tt' || lpad(CAST(p_partkey AS STRING), 7, '0') AS imdb_id,
  CAST(CAST(p_size AS DOUBLE) / 5 AS FLOAT) AS imdb_score,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST((p_partkey * 7919) % 100003 AS INT) END AS imdb_votes,
  CASE WHEN p_partkey % 53 = 0 THEN CAST('NaN' AS FLOAT)
       ELSE CAST(p_retailprice / 7 + redelivery AS FLOAT) END AS tmdb_popularity,
  CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE CAST(CAST(p_size AS DOUBLE) / 6 AS FLOAT) END AS tmdb_score,
  CASE p_partkey % 4 WHEN 0 THEN 'Netflix' WHEN 1 THEN ' Disney ' WHEN 2 THEN 'Hulu' ELSE 'Amazon' END AS platform,
  '2024-01-0' || CAST(1 + redelivery AS STRING) || ' 06:30:00' AS ingestion_timestamp
FROM (
  SELECT p.*, 0 AS redelivery FROM {part} AS p
  UNION ALL
  SELECT p.*, 1 AS redelivery FROM {part} AS p WHERE p_partkey % 10 = 0
) AS deliveries
"""

CREDITS_SQL = """
SELECT
  CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE ' ' || CAST(l_suppkey AS STRING) END AS person_ID,
  'tm' || CAST(l_partkey AS STRING) || ' ' AS id,
  CASE WHEN l_suppkey % 17 = 0 AND l_linenumber = 1 THEN NULL ELSE ' ' || s_name END AS name,
  ' char ' || CAST(l_linenumber AS STRING) AS character_name,
  CASE l_returnflag WHEN 'A' THEN 'actor ' WHEN 'N' THEN ' director' ELSE NULL END AS role,
  CASE l_partkey % 4 WHEN 0 THEN 'Netflix' WHEN 1 THEN ' Disney ' WHEN 2 THEN 'Hulu' ELSE 'Amazon' END AS platform,
  '2024-01-0' || CAST(1 + l_linenumber % 7 AS STRING) || ' 06:30:00' AS ingestion_timestamp
FROM {lineitem} AS l JOIN {supplier} AS s ON l_suppkey = s_suppkey
"""

# The same rows with timestamps that are missing, in another form, or far in the future.
ODD_TIMES = {
    "titles": """CASE WHEN release_year = 1994 THEN NULL WHEN release_year = 1997 THEN '01/03/2024 06:30:00'
      WHEN release_year = 2001 THEN '2150-01-01 00:00:00' ELSE ingestion_timestamp END""",
    "credits": """CASE WHEN role IS NULL AND character_name = ' char 2' THEN NULL
      WHEN role IS NULL AND character_name = ' char 3' THEN '01/03/2024 06:30:00' ELSE ingestion_timestamp END""",
}


def _files(sf_dir: str) -> dict[str, str]:
    return {name: f"parquet.`{sf_dir}/{name}.parquet`" for name in ("part", "lineitem", "supplier")}


def bronze_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TITLES_SQL.format(**_files(sf_dir)))


def bronze_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CREDITS_SQL.format(**_files(sf_dir)))


def oracle_ctes() -> str:
    """The same inputs as common table expressions over the registered views."""
    names = {name: name for name in ("part", "lineitem", "supplier")}
    return (
        f"bronze_titles AS ({TITLES_SQL.format(**names)}), "
        f"bronze_credits AS ({CREDITS_SQL.format(**names)})"
    )
