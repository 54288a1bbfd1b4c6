"""Reelhouse: a PySpark pipeline for streaming-video catalogues.

CSV or JSON events -> append-only bronze Parquet -> clean, deduplicated tables,
dated snapshots, a star schema, top-N marts and an aggregate view -> JDBC.
"""

from reelhouse.plans.bronze import land_topics, start_bronze, start_rejects
from reelhouse.plans.daily import DailyRun, run_daily
from reelhouse.plans.ingest import Feed, ingest
from reelhouse.plans.lake import Lake
from reelhouse.plans.publish import publish_tables
from reelhouse.plans.transform import transform
from reelhouse.sinks.jdbc import JdbcTarget

__all__ = [
    "DailyRun",
    "Feed",
    "JdbcTarget",
    "Lake",
    "ingest",
    "land_topics",
    "publish_tables",
    "run_daily",
    "start_bronze",
    "start_rejects",
    "transform",
]
