"""Transform job: bronze to transformed tables, snapshots, star schema, marts and view."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators.dedupe import transformed_credits, transformed_titles
from reelhouse.operators.marts import top_n
from reelhouse.operators.star import dim_person, dim_title, fact_credits
from reelhouse.sinks.snapshots import write_snapshot
from reelhouse.sinks.tables import create_database, create_popularity_view, write_table
from reelhouse.sources.bronze import read_bronze


def _run(pool: ThreadPoolExecutor, *writes: Callable[[], DataFrame | None]) -> list[DataFrame | None]:
    """Results of all writes in order; the first failure is raised."""
    return [write.result() for write in [pool.submit(write) for write in writes]]


def transform(
    spark: SparkSession,
    bronze_titles: str,
    bronze_credits: str,
    snapshots: str,
    database: str = schemas.DATABASE,
    location: str | None = None,
    snapshot_date: datetime.date | None = None,
    replace_day: bool = False,
    files_per_day: int | None = None,
    nan_as_null: bool = False,
    side_by_side: int = 3,
    since: datetime.date | None = None,
) -> dict[str, DataFrame]:
    """Build every table from the two bronze folders and return scans of them by name.

    Clean and dedupe run once: the two transformed tables are written first, and all other
    outputs are derived from their files, so all tables of one run agree on the surviving
    rows. Writes that do not depend on each other run `side_by_side` at a time, which fills
    the cluster while the last tasks of one are still running.

    `since` makes the run incremental: it reads the bronze folders of that and later ingestion days only,
    and merges them with the transformed tables of the run before. The tables are the same as after a
    full run if all rows of earlier days had landed by then; rows read twice change nothing. Rows without a usable
    timestamp have no day and are read every time.
    """
    titles_in = read_bronze(spark, bronze_titles, schemas.TITLES, since)
    credits_in = read_bronze(spark, bronze_credits, schemas.CREDITS, since)

    def before(table: str) -> DataFrame | None:
        return None if since is None else spark.table(f"`{database}`.`{table}`")

    create_database(spark, database, location)
    day = snapshot_date or spark.range(1).select(F.current_date()).first()[0]
    table = partial(write_table, database=database)

    snapshot = partial(
        write_snapshot, snapshot_date=day, replace_day=replace_day, files_per_day=files_per_day
    )
    with ThreadPoolExecutor(side_by_side) as pool:
        titles, credits = _run(
            pool,
            partial(
                table,
                transformed_titles(titles_in, before(schemas.TRANSFORMED_TITLES)),
                table=schemas.TRANSFORMED_TITLES,
            ),
            partial(
                table,
                transformed_credits(credits_in, before(schemas.TRANSFORMED_CREDITS)),
                table=schemas.TRANSFORMED_CREDITS,
            ),
        )
        _run(
            pool,
            partial(snapshot, credits, f"{snapshots}/credits"),
            partial(table, fact_credits(credits), table="fact_credits"),
            partial(table, dim_person(credits), table="dim_person"),
            partial(snapshot, titles, f"{snapshots}/titles"),
            partial(table, dim_title(titles), table="dim_title"),
            *(
                partial(table, top_n(titles, platform, metric, nan_as_null=nan_as_null), table=mart)
                for mart, (platform, metric) in schemas.MARTS.items()
            ),
        )

    create_popularity_view(spark, database)
    names = [
        schemas.TRANSFORMED_TITLES,
        schemas.TRANSFORMED_CREDITS,
        "dim_title",
        "dim_person",
        "fact_credits",
        *schemas.MARTS,
        schemas.POPULARITY_VIEW,
    ]
    return {name: spark.table(f"`{database}`.`{name}`") for name in names}
