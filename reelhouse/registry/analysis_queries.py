"""Joins, checks, summaries and comparisons over the catalogue's tables, and streams with state, as queries."""

from __future__ import annotations

import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions import codec
from reelhouse.operators import clean, dedupe, diff, history, integrity, joins, lists, network, star, summaries
from reelhouse.operators.combine import union_all
from reelhouse.plans.bronze import start_bronze
from reelhouse.registry import inputs
from reelhouse.session import scratch_path, settings
from reelhouse.sinks.events import to_folder
from reelhouse.sinks.snapshots import write_snapshot
from reelhouse.sources.bronze import read_bronze
from reelhouse.sources.events import from_folder
from reelhouse.streaming import late, stateful
from reelhouse.streaming.drain import finish, start_drain

TITLE_REFERENCE = ["id", "platform"]
MEASURES = ("titles", "rated", "avg_imdb_score")
#: Days of the history, with gaps; on day n, titles of n seasons are withdrawn and popularity moves by runtime.
HISTORY_DAYS = tuple(datetime.date(2024, 3, day) for day in (1, 2, 4, 10))
#: Two overlapping states of the credits: up to a time, and from a time on.
BEFORE, AFTER = "2024-01-05", "2024-01-03"
MULTISET = ["person_ID", "id", "name", "role", "platform"]
STEPS = 3


def _kept(df: DataFrame) -> DataFrame:
    """Written and read back, so that what uses it more than once makes it once."""
    path = scratch_path(df.sparkSession, "analysis")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(dedupe.transformed_titles(inputs.bronze_titles(spark, sf_dir)))


def _credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(dedupe.transformed_credits(inputs.bronze_credits(spark, sf_dir)))


# --- joins and references ----------------------------------------------------------


def star_join(spark: SparkSession, sf_dir: str, keep_unmatched: bool = True) -> DataFrame:
    credits = _credits(spark, sf_dir)
    titles, persons = star.dim_title(_titles(spark, sf_dir)), star.dim_person(credits)
    return joins.star_join(star.fact_credits(credits), titles, persons, keep_unmatched=keep_unmatched)


def orphan_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits without a title."""
    titles, facts = star.dim_title(_titles(spark, sf_dir)), star.fact_credits(_credits(spark, sf_dir))
    return integrity.unreferenced(titles, facts, TITLE_REFERENCE, TITLE_REFERENCE)[1]


def uncredited_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without a director's credit in the delivery of the last days."""
    titles, credits = _titles(spark, sf_dir), _credits(spark, sf_dir)
    recent = credits.where((F.col("ingestion_timestamp") >= BEFORE) & (F.col("role") == "DIRECTOR"))
    unmet, _ = integrity.unreferenced(titles.select(*TITLE_REFERENCE, "title"), recent, TITLE_REFERENCE, TITLE_REFERENCE)
    return unmet


def reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions of the references of credits to titles, and of orders to customers."""
    customers, orders = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("customer", "orders"))
    catalogue = integrity.reference_counts(_titles(spark, sf_dir), _credits(spark, sf_dir), TITLE_REFERENCE, TITLE_REFERENCE)
    sales = integrity.reference_counts(customers, orders, ["c_custkey"], ["o_custkey"])
    return union_all(
        counts.withColumn("reference", F.lit(name)) for name, counts in (("credits to titles", catalogue), ("orders to customers", sales))
    )


# --- lists, subtotals, distinct counts ---------------------------------------------


def title_list(column: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.list_rows(_titles(spark, sf_dir), column, keep_empty=True)


def list_summary(column: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = lists.summary_by_value(_titles(spark, sf_dir), column, ["platform"])
    return summary.withColumns({name: F.round(name, 6) for name in ("avg_imdb_score", "share")})


def title_subtotals(sets, spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [F.count("*").alias("titles"), F.count("imdb_votes").alias("rated"), F.round(F.avg("imdb_score"), 6).alias("avg_imdb_score")]
    return summaries.subtotals(_titles(spark, sf_dir), measures, sets=sets)


def _credited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits with the year of their title; every day's delivery, so persons come again."""
    credits = clean.clean_credits(clean.require_keys(inputs.bronze_credits(spark, sf_dir), schemas.CREDIT_REQUIRED))
    titles = star.dim_title(_titles(spark, sf_dir))
    return joins.lookup_join(credits, titles, {"id": "id", "platform": "platform"}, ["release_year"])


def distinct_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.distinct_counts(_credited(spark, sf_dir), ["platform", "release_year"], ["person_ID", "id", "role"])


def distinct_persons_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored by day and merged over the days, held against the exact counts."""
    columns, groups = ["person_ID", "id"], ["platform", "release_year"]
    rows = _kept(_credited(spark, sf_dir).withColumn("day", F.substring("ingestion_timestamp", 1, 10)))
    path = scratch_path(spark, "sketches")
    summaries.distinct_sketches(rows, [*groups, "day"], columns).write.partitionBy("day").parquet(path)
    merged = summaries.merged_sketches(spark.read.parquet(path), groups, columns)
    exact = summaries.distinct_counts(rows, groups, columns)
    found = {
        f"{name}_in_bounds": summaries.within_error(F.col(f"left.distinct_{name}"), F.col(f"right.distinct_{name}")) for name in columns
    }
    return summaries.differing_keys(exact, summaries.sketched_counts(merged, groups, columns), groups, found)


# --- snapshots, networks -----------------------------------------------------------


def title_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles, path = _titles(spark, sf_dir), scratch_path(spark, "snapshots")
    for number, day in enumerate(HISTORY_DAYS):
        moved = titles.withColumn("tmdb_popularity", F.col("tmdb_popularity") + F.col("runtime") % (number + 2))
        write_snapshot(moved.where(F.coalesce("seasons", F.lit(0)) != number), path, day)
    rows = history.title_history(spark.read.parquet(path))
    rounded = {name: F.round(name, 6) for name in ("value", "rolling_avg", "first_value", "last_value")}
    days = {name: F.col(name).cast("string") for name in ("snapshot_date", "previous_day")}
    return rows.withColumns(rounded | days)


def _two_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _kept(clean.clean_credits(clean.require_keys(inputs.bronze_credits(spark, sf_dir), schemas.CREDIT_REQUIRED)))
    time = F.col("ingestion_timestamp")
    return rows.where(time < BEFORE).select(*MULTISET), rows.where(time >= AFTER).select(*MULTISET)


def credit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.snapshot_diff(*_two_states(spark, sf_dir), schemas.CREDIT_KEY)


def credit_changes_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later state, made from the earlier one and the difference."""
    before, after = _two_states(spark, sf_dir)
    return diff.apply_diff(before, diff.snapshot_diff(before, after, schemas.CREDIT_KEY))


def persons_within_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is connected with one person over titles that they directed, by credits of the seventh line."""
    credits = _credits(spark, sf_dir).where("role = 'DIRECTOR' AND character_name = 'char 7'")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    start = nations.where("n_nationkey = 3").select(F.col("n_nationkey").cast("string").alias("person_id"))
    return network.persons_within(credits, start, STEPS)


# --- streams with state ------------------------------------------------------------

EVENTS = "event_id long, ts timestamp, event_type string, value double"
#: The delivery that an event comes with: by its time, but some come later.
DELIVERY = """CASE WHEN event_id % 25 = 0 THEN 3
  ELSE least(CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END
             + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, 3) END"""
DELAY = "2 days"


def stream_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of closed windows, and the late events by hour, after three deliveries drained one by one."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("delivery", F.expr(DELIVERY))
    events = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value", "delivery")
    landing, folder, windows = (scratch_path(spark, label) for label in ("landing", "dealt", "windows"))
    split_state, window_state = scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint")
    measures = [F.count("*").alias("n"), F.sum("value").alias("total")]
    for delivery in (1, 2, 3):
        events.where(F.col("delivery") == delivery).drop("delivery").write.mode("append").parquet(landing)
        # both streams start anew each time and go on from their checkpoints
        finish(late.start_split(spark.readStream.schema(EVENTS).parquet(landing), "ts", DELAY, folder, split_state))
        closed = stateful.event_windows(late.on_time(spark, folder, EVENTS), "ts", "1 hour", DELAY, ["event_type"], measures)
        finish(stateful.start_windows(closed, windows, window_state))
    apart = late.late_rows(spark, folder, EVENTS).groupBy(F.date_trunc("hour", "ts").alias("window_start"), "event_type").agg(*measures)
    found = {"window": spark.read.parquet(windows), "late": apart}
    return union_all(
        rows.select(
            F.lit(kind).alias("kind"), F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", F.round("total", 4).alias("total")
        )
        for kind, rows in found.items()
    )


# Bytes of files that make a batch: dealing its messages takes about four times as much disk, until it ends.
UNIQUE_BATCH_BYTES = 2 * 1024**3


def stream_unique(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after everything was delivered twice, and the first time with repeats among it."""
    rows, columns = (
        (inputs.bronze_titles(spark, sf_dir), schemas.TITLES) if entity == "titles" else (inputs.bronze_credits(spark, sf_dir), schemas.CREDITS)
    )
    landing, lake, checkpoint = (scratch_path(spark, label) for label in ("landing", "bronze", "checkpoint"))
    for delivered in (rows.unionByName(rows), rows):
        to_folder(codec.encode(delivered), landing)
        arrived = from_folder(spark, landing, max_bytes_per_trigger=UNIQUE_BATCH_BYTES)
        with settings(spark, stateful.UNIQUE_SETTINGS):
            finish(start_bronze(stateful.unique_events(arrived, "1 day"), columns, lake, checkpoint))
    landed = read_bronze(spark, lake, columns)
    if entity == "credits":
        return landed
    return landed.select("imdb_id", "id", "title", "platform", "ingestion_timestamp")


#: Times of title and credit events, from the number in a title's id; a credit comes up to 32 hours after its title, or before it.
TITLE_TIME = "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(substr(id, 3) AS INT) % 600)"
CREDIT_TIME = (
    "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, "
    "CAST(substr(id, 3) AS INT) % 600 + 8 * CAST(substr(ingestion_timestamp, 10, 1) AS INT) - 24)"
)
TITLE_EVENTS = "id string, platform string, title string, title_time timestamp"
CREDIT_EVENTS = "id string, platform string, person_ID string, role string, credit_time timestamp"
#: Times that begin the second and the third delivery.
DELIVERED = ("2024-01-08 12:15:00", "2024-01-17 12:15:00")


def stream_join(keep_unmatched: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with the credits that follow within 4.5 hours, delivered and drained in three parts."""
    titles, credits = dedupe.transformed_titles(inputs.bronze_titles(spark, sf_dir)), dedupe.transformed_credits(inputs.bronze_credits(spark, sf_dir))
    titles = _kept(titles.select("id", "platform", "title", F.expr(TITLE_TIME).alias("title_time")))
    credits = _kept(credits.select("id", "platform", "person_ID", "role", F.expr(CREDIT_TIME).alias("credit_time")))
    sides = {"titles": (titles, "title_time", TITLE_EVENTS), "credits": (credits, "credit_time", CREDIT_EVENTS)}
    base, out, checkpoint = (scratch_path(spark, label) for label in ("join", "joined", "checkpoint"))
    edges = ["0000-01-01 00:00:00", *DELIVERED, "9999-01-01 00:00:00"]
    for begin, end in zip(edges, edges[1:]):
        streams = []
        for name, (rows, time, schema) in sides.items():
            rows.where((F.col(time) >= begin) & (F.col(time) < end)).write.mode("append").parquet(f"{base}/{name}/landing")
            landed = spark.readStream.schema(schema).parquet(f"{base}/{name}/landing")
            finish(late.start_split(landed, time, "1 day", f"{base}/{name}", f"{base}/{name}/state"))
            streams.append(late.on_time(spark, f"{base}/{name}", schema))
        near = stateful.join_in_time(
            *streams, ["id", "platform"], "title_time", "credit_time", "0 hours", "4 hours 30 minutes", "1 day", keep_unmatched
        )
        finish(start_drain(near, out, checkpoint))
    return spark.read.parquet(out).select("id", "platform", "title", "person_ID", "role")


QUERIES = {
    "star_join": star_join,
    "star_join_matched": partial(star_join, keep_unmatched=False),
    "orphan_credits": orphan_credits,
    "uncredited_titles": uncredited_titles,
    "reference_counts": reference_counts,
    "title_genres": partial(title_list, "genres"),
    "title_countries": partial(title_list, "production_countries"),
    "genre_summary": partial(list_summary, "genres"),
    "title_cube": partial(title_subtotals, "cube"),
    "title_rollup": partial(title_subtotals, "rollup"),
    "title_grouping_sets": partial(title_subtotals, [["platform", "release_year"], ["age_certification"], []]),
    "distinct_persons": distinct_persons,
    "distinct_persons_sketched": distinct_persons_sketched,
    "title_history": title_history,
    "credit_changes": credit_changes,
    "credit_changes_applied": credit_changes_applied,
    "persons_within_steps": persons_within_steps,
    "stream_event_windows": stream_event_windows,
    "stream_unique_titles": partial(stream_unique, "titles"),
    "stream_unique_credits": partial(stream_unique, "credits"),
    "stream_join_inner": partial(stream_join, False),
    "stream_join_left": partial(stream_join, True),
}
