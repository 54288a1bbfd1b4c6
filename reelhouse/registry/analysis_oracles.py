"""SQL counterparts of the queries in `analysis_queries`, over the transformed tables `titles` and `credits`."""

from __future__ import annotations

_FACTS = "c.person_ID AS person_id, c.id, c.role, c.platform, c.character_name"


def _star(join: str) -> str:
    return f"""
        SELECT {_FACTS}, t.title, t.show_type, t.release_year, p.name
        FROM credits c {join} titles t ON c.id = t.id AND c.platform = t.platform
        {join} (SELECT person_ID, min(name) AS name FROM credits GROUP BY person_ID) p ON p.person_ID = c.person_ID"""


_NO_TITLE = "NOT EXISTS (SELECT 1 FROM titles t WHERE t.id = c.id AND t.platform = c.platform)"
_NO_CREDIT = "NOT EXISTS (SELECT 1 FROM credits c WHERE t.id = c.id AND t.platform = c.platform)"


def _counts(reference: str, side: str, table: str, orphan: str, key: str) -> str:
    return f"""
        SELECT '{reference}' AS reference, '{side}' AS side, (SELECT count(*) FROM {table}) AS row_count,
          count(*) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys
        FROM {table} WHERE {orphan}"""


_REFERENCES = " UNION ALL ".join(
    [
        _counts("credits to titles", "smaller", "titles t", _NO_CREDIT, "(t.id, t.platform)"),
        _counts("credits to titles", "larger", "credits c", _NO_TITLE, "(c.id, c.platform)"),
        _counts("orders to customers", "smaller", "customer", "c_custkey NOT IN (SELECT o_custkey FROM orders)", "c_custkey"),
        _counts("orders to customers", "larger", "orders", "o_custkey NOT IN (SELECT c_custkey FROM customer)", "o_custkey"),
    ]
)


def _values(column: str) -> str:
    return f"""list_filter(list_transform(string_split({column}, ','),
        lambda x: regexp_replace(trim(x, ' '), '^''(.*)''$', '\\1')), lambda x: trim(x, ' ') <> '')"""


def _list(column: str) -> str:
    return f"""
        SELECT t.platform, t.id, CAST(i AS INTEGER) AS position, v[i] AS value
        FROM (SELECT platform, id, {_values(column)} AS v FROM titles) AS t, unnest(range(1, len(v) + 1)) AS places(i)
        UNION ALL
        SELECT platform, id, NULL, NULL FROM titles WHERE {column} IS NULL OR len({_values(column)}) = 0"""


_GENRES = f"""
    SELECT platform, value, count(*) AS titles, count(score) AS rated, round(avg(score), 6) AS avg_imdb_score,
      round(sum(1.0 / among), 6) AS share
    FROM (
      SELECT platform, CASE WHEN NOT isnan(imdb_score) THEN imdb_score END AS score, len(v) AS among, unnest(v) AS value
      FROM (SELECT *, list_distinct({_values("genres")}) AS v FROM titles) AS listed
    ) AS valued GROUP BY platform, value"""

_DIMENSIONS = ("platform", "release_year", "age_certification")


def _subtotals(sets: str) -> str:
    flags = ", ".join(f"CAST(grouping({name}) AS INTEGER) AS is_total_{name}" for name in _DIMENSIONS)
    return f"""
        SELECT {", ".join(_DIMENSIONS)}, {flags}, count(*) AS titles, count(imdb_votes) AS rated,
          round(avg(imdb_score), 6) AS avg_imdb_score
        FROM titles GROUP BY {sets}"""


_CREDITED = """
    FROM credits_required c LEFT JOIN titles t ON c.id = t.id AND c.platform = t.platform
    GROUP BY c.platform, t.release_year"""

_HISTORY = """
    WITH days AS (
      SELECT * FROM (VALUES (DATE '2024-03-01', 0), (DATE '2024-03-02', 1), (DATE '2024-03-04', 2), (DATE '2024-03-10', 3)) AS d(day, n)
    ), daily AS (
      SELECT platform, id, day, max(CASE WHEN NOT isnan(moved) THEN moved END) AS value
      FROM (
        SELECT platform, id, day, tmdb_popularity + runtime % (n + 2) AS moved FROM titles, days WHERE coalesce(seasons, 0) <> n
      ) AS held GROUP BY platform, id, day
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY platform, day ORDER BY value DESC NULLS LAST, id) AS day_rank FROM daily
    )
    SELECT platform, id, strftime(day, '%Y-%m-%d') AS snapshot_date, round(value, 6) AS value, day_rank,
      strftime(lag(day) OVER by_day, '%Y-%m-%d') AS previous_day, lag(day_rank) OVER by_day - day_rank AS rank_change,
      round(avg(value) OVER lately, 6) AS rolling_avg, count(value) OVER lately AS rolling_days,
      round(first_value(value IGNORE NULLS) OVER whole, 6) AS first_value,
      round(last_value(value IGNORE NULLS) OVER whole, 6) AS last_value
    FROM ranked
    WINDOW by_day AS (PARTITION BY platform, id ORDER BY day),
      lately AS (PARTITION BY platform, id ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
      whole AS (PARTITION BY platform, id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""

_STATE = "SELECT person_ID, id, name, role, platform FROM credits_required WHERE ingestion_timestamp"
_SAME_KEY = " AND ".join(f"w.{name} IS NOT DISTINCT FROM l.{name}" for name in ("id", "person_ID", "role", "platform"))
_CHANGES = f"""
    WITH before AS ({_STATE} < '2024-01-05'), after AS ({_STATE} >= '2024-01-03'),
    won AS (SELECT *, count(*) AS copies FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before) AS e GROUP BY ALL),
    lost AS (SELECT *, count(*) AS copies FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after) AS e GROUP BY ALL)
    SELECT CASE WHEN EXISTS (SELECT 1 FROM lost l WHERE {_SAME_KEY}) THEN 'changed_to' ELSE 'added' END AS change, w.* FROM won w
    UNION ALL
    SELECT CASE WHEN EXISTS (SELECT 1 FROM won w WHERE {_SAME_KEY}) THEN 'changed_from' ELSE 'removed' END AS change, l.* FROM lost l"""

_NETWORK = """
    SELECT person_id, CAST(min(step) AS INTEGER) AS step FROM (
      WITH RECURSIVE links AS (
        SELECT DISTINCT person_ID AS person_id, platform, id FROM credits WHERE role = 'DIRECTOR' AND character_name = 'char 7'
      ),
      found AS (
        SELECT CAST(n_nationkey AS VARCHAR) AS person_id, 0 AS step FROM nation WHERE n_nationkey = 3
        UNION
        SELECT b.person_id, step + 1 FROM found f JOIN links a ON a.person_id = f.person_id
          JOIN links b ON b.id = a.id AND b.platform = a.platform WHERE step < 3
      ) SELECT * FROM found
    ) AS reached GROUP BY person_id"""

_HOURLY = """date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total
      FROM dealt WHERE is_late = {late} GROUP BY date_trunc('hour', ts), event_type"""
EVENT_WINDOWS = f"""
    WITH delivered AS (
      SELECT *, CASE WHEN event_id % 25 = 0 THEN 3
        ELSE least(CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END
                   + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, 3) END AS delivery FROM events
    ), highest AS (
      SELECT d, (SELECT max(ts) FROM delivered WHERE delivery < d) AS seen FROM (VALUES (1), (2), (3)) AS n(d)
    ), dealt AS (
      SELECT delivered.*, coalesce(ts < seen - INTERVAL 2 DAYS, FALSE) AS is_late FROM delivered JOIN highest ON delivery = d
    )
    SELECT 'window' AS kind, strftime(start, '%Y-%m-%d %H:%M') AS hour, event_type, n, total
    FROM (SELECT {_HOURLY.format(late="FALSE")}) AS on_time
    WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM dealt) - INTERVAL 2 DAYS
    UNION ALL
    SELECT 'late' AS kind, strftime(start, '%Y-%m-%d %H:%M') AS hour, event_type, n, total
    FROM (SELECT {_HOURLY.format(late="TRUE")}) AS too_late"""

_NUMBER = "CAST(substr({}id, 3) AS INTEGER) % 600"
_TIMED = f"""
    WITH t AS (
      SELECT id, platform, title, TIMESTAMP '2024-01-01' + to_hours({_NUMBER.format("")}) AS title_time FROM titles
    ), c AS (
      SELECT id, platform, person_ID, role,
        TIMESTAMP '2024-01-01' + to_hours({_NUMBER.format("")} + 8 * CAST(substr(ingestion_timestamp, 10, 1) AS INTEGER) - 24) AS credit_time
      FROM credits
    ), pairs AS (
      SELECT t.id, t.platform, t.title, c.person_ID, c.role FROM t JOIN c ON t.id = c.id AND t.platform = c.platform
        AND c.credit_time BETWEEN t.title_time AND t.title_time + INTERVAL 270 MINUTES
    )
    SELECT * FROM pairs"""
_UNMATCHED = """
    UNION ALL
    SELECT id, platform, title, NULL, NULL FROM t
    WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = t.id AND p.platform = t.platform)
      AND title_time + INTERVAL 270 MINUTES
        < least((SELECT max(title_time) FROM t), (SELECT max(credit_time) FROM c)) - INTERVAL 1 DAY"""

BODIES = {
    "star_join": _star("LEFT JOIN"),
    "star_join_matched": _star("JOIN"),
    "orphan_credits": f"SELECT {_FACTS} FROM credits c WHERE {_NO_TITLE}",
    "uncredited_titles": """
        SELECT id, platform, title FROM titles t WHERE NOT EXISTS (
          SELECT 1 FROM credits c
          WHERE c.id = t.id AND c.platform = t.platform AND c.role = 'DIRECTOR' AND c.ingestion_timestamp >= '2024-01-05')""",
    "reference_counts": _REFERENCES,
    "title_genres": _list("genres"),
    "title_countries": _list("production_countries"),
    "genre_summary": _GENRES,
    "title_cube": _subtotals("CUBE (platform, release_year, age_certification)"),
    "title_rollup": _subtotals("ROLLUP (platform, release_year, age_certification)"),
    "title_grouping_sets": _subtotals("GROUPING SETS ((platform, release_year), (age_certification), ())"),
    "distinct_persons": f"""
        SELECT c.platform, t.release_year, count(DISTINCT c.person_ID) AS "distinct_person_ID", count(DISTINCT c.id) AS distinct_id,
          count(DISTINCT c.role) AS distinct_role {_CREDITED}""",
    "distinct_persons_sketched": f"""
        SELECT c.platform, t.release_year, 1 AS "person_ID_in_bounds", 1 AS id_in_bounds {_CREDITED}""",
    "title_history": _HISTORY,
    "credit_changes": _CHANGES,
    "credit_changes_applied": f"{_STATE} >= '2024-01-03'",
    "persons_within_steps": _NETWORK,
    "stream_event_windows": EVENT_WINDOWS,
    "stream_unique_titles": """
        SELECT imdb_id, id, title, platform, ingestion_timestamp FROM (SELECT DISTINCT * FROM bronze_titles) AS events""",
    "stream_unique_credits": "SELECT DISTINCT * FROM bronze_credits",
    "stream_join_inner": _TIMED,
    "stream_join_left": _TIMED + _UNMATCHED,
}
