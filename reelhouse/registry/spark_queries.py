"""Every operator as a query over the given tables: (spark, sf_dir) -> DataFrame.

Queries that test a sink or a stream write to the shared scratch folder, each run to a new
folder of its own, and return a scan of what was written.
"""

from __future__ import annotations

import datetime
import os
import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions import codec
from reelhouse.functions.tagging import tag
from reelhouse.functions.text import list_text, trimmed
from reelhouse.operators import clean, dedupe, marts, star
from reelhouse.operators.combine import union_all
from reelhouse.plans.bronze import land_topics, start_bronze, start_rejects
from reelhouse.plans.daily import DailyRun, run_daily
from reelhouse.plans.ingest import Feed, ingest
from reelhouse.plans.lake import Lake
from reelhouse.plans.publish import publish_tables
from reelhouse.plans.transform import transform
from reelhouse.registry import inputs
from reelhouse.session import is_local, scratch_path
from reelhouse.sinks import jdbc, tables
from reelhouse.sinks.events import to_folder
from reelhouse.sinks.folders import subfolders
from reelhouse.sinks.snapshots import write_snapshot
from reelhouse.sources.bronze import read_bronze
from reelhouse.sources.csv import RAW_RECORD, read_csv, unparsed
from reelhouse.sources.errors import MissingInput
from reelhouse.sources.events import from_folder
from reelhouse.streaming.drain import finish

INGESTED_AT = "2024-03-01 05:00:00"
SNAPSHOT_DAYS = (datetime.date(2024, 3, 1), datetime.date(2024, 3, 2))
REMOVED_DAY = datetime.date(2024, 3, 3)
# What events may lack, what names an event, and when a second delivery begins.
LACKING = {"titles": "release_year IS NULL", "credits": "role IS NULL"}
EVENT_KEY = {
    "titles": ["imdb_id", "ingestion_timestamp"],
    "credits": ["character_name", "person_ID", "id", "ingestion_timestamp"],
}
SECOND_DELIVERY = {"titles": "2024-01-02", "credits": "2024-01-05"}
# Messages in a landed file, so that no task holds more, however many there are.
ROWS_PER_FILE = 1_000_000
# Types that every engine writes the same way.
EXACT = ("string", "int", "date")


# --- output form -------------------------------------------------------------------


def _nan_flagged(name: str, value: Column | None = None) -> list[Column]:
    """A number that may be NaN as number-or-null and a 0/1 flag."""
    value = F.col(name) if value is None else value
    return [
        F.when(~F.isnan(value), value).alias(name),
        F.isnan(value).cast("int").alias(f"{name}_is_nan"),
    ]


def _comparable(df: DataFrame) -> DataFrame:
    """Floats as doubles, dates as text and NaN made visible, so that any engine agrees."""
    columns = []
    for name, kind in df.dtypes:
        if name == "tmdb_popularity":
            columns += _nan_flagged(name, F.col(name).cast("double"))
        elif kind in ("float", "date"):
            columns.append(F.col(name).cast("double" if kind == "float" else "string").alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


# --- inputs and stored tables ------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return inputs.bronze_titles(spark, sf_dir) if entity == "titles" else inputs.bronze_credits(spark, sf_dir)


def _columns(entity: str) -> dict[str, str]:
    return schemas.TITLES if entity == "titles" else schemas.CREDITS


def _new_database(spark: SparkSession) -> str:
    name = f"reelhouse_{uuid.uuid4().hex}"
    tables.create_database(spark, name, scratch_path(spark, "tables"))
    return name


def _stored(spark: SparkSession, sf_dir: str, entity: str, database: str | None = None) -> DataFrame:
    """The transformed table, written to the catalog and read back."""
    if entity == "titles":
        df, table = dedupe.transformed_titles(_bronze(spark, sf_dir, entity)), schemas.TRANSFORMED_TITLES
    else:
        df, table = dedupe.transformed_credits(_bronze(spark, sf_dir, entity)), schemas.TRANSFORMED_CREDITS
    return tables.write_table(df, database or _new_database(spark), table)


# --- sources, codec, ingest --------------------------------------------------------


def bronze(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze folder written and scanned."""
    path = scratch_path(spark, "bronze")
    _bronze(spark, sf_dir, entity).write.parquet(path)
    return _comparable(read_bronze(spark, path, _columns(entity)))


def _export(rows: DataFrame, path: str) -> None:
    """Write CSV without losing padding."""
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def csv_scan(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = schemas.csv_columns(_columns(entity))
    path = scratch_path(spark, "csv")
    _export(_bronze(spark, sf_dir, entity).select(*columns), path)
    return _comparable(read_csv(spark, path, columns))


def _export_by_platform(spark: SparkSession, sf_dir: str, entity: str, path: str) -> dict[str, str]:
    """The rows of each platform written as its export, in one pass; the folder of each."""
    rows = _bronze(spark, sf_dir, entity)
    columns = schemas.csv_columns(_columns(entity))
    dealt = rows.select(*columns, trimmed("platform").alias("export"))
    writer = dealt.write.partitionBy("export")
    writer.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    written = {each.rpartition("export=")[2] for each in subfolders(spark, path)}
    if not written <= set(schemas.PLATFORMS):
        raise ValueError(f"rows of platforms other than {schemas.PLATFORMS}: {written}")
    return {platform: f"{path}/export={platform}" for platform in schemas.PLATFORMS}


def _by_platform(spark: SparkSession, sf_dir: str, entity: str) -> dict[str, DataFrame]:
    """The rows of each platform as that platform would export them."""
    rows = _bronze(spark, sf_dir, entity)
    columns = schemas.csv_columns(_columns(entity))
    return {
        platform: rows.where(trimmed("platform") == platform).select(*columns) for platform in schemas.PLATFORMS
    }


def tag_union(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    exports = _by_platform(spark, sf_dir, entity)
    return _comparable(union_all(tag(df, platform, INGESTED_AT) for platform, df in exports.items()))


def sample(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten rows of each platform."""
    first = ["id"] if entity == "titles" else ["person_ID", "id"]
    exports = _by_platform(spark, sf_dir, entity)
    sampled = {platform: marts.sample_rows(df, 10, first) for platform, df in exports.items()}
    return _comparable(union_all(tag(df, platform, INGESTED_AT) for platform, df in sampled.items()))


def encode(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    events = codec.encode(_bronze(spark, sf_dir, entity))
    return _comparable(codec.decode(events, _columns(entity)))


def decode(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a foreign producer: other field order, unknown and wrongly cased fields."""
    rows = _bronze(spark, sf_dir, entity)
    fields = [*reversed(rows.columns), F.lit(1).alias("extra"), F.lit("x").alias("Platform")]
    events = rows.select(F.to_json(F.struct(*fields)).cast("binary").alias("value"))
    return _comparable(codec.decode(events, _columns(entity)))


def decode_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    wire = events.select("event_id", F.col("props").cast("binary").alias("value"))
    return codec.decode_with_raw(wire, {"k": "int"}).select("event_id", "k")


def quarantine(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that lack a field (release year, role) are cut off half-way; the rest arrive intact."""
    rows = _bronze(spark, sf_dir, entity)
    wire = F.to_json(F.struct(*rows.columns))
    half = F.substring(wire, F.lit(1), (F.length(wire) / 2).cast("int"))
    events = rows.select(
        F.concat_ws(" ", *EVENT_KEY[entity]).alias("event_key"),
        F.when(F.expr(LACKING[entity]), half).otherwise(wire).cast("binary").alias("value"),
    )
    return codec.decode_with_raw(events, _columns(entity)).select(
        "event_key", F.col(codec.RAW_TEXT).isNotNull().cast("int").alias("is_bad"), EVENT_KEY[entity][0]
    )


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the CSV records whose number of seasons is no integer: every second one has a fraction."""
    seasons = F.concat("seasons", F.when(F.col("seasons") % 2 == 0, ".0").otherwise(""))
    path = scratch_path(spark, "csv")
    _export(_bronze(spark, sf_dir, "titles").select("imdb_id", seasons.alias("seasons")), path)
    rows = read_csv(spark, path, {"imdb_id": "string", "seasons": "int"}, keep_raw=True)
    return unparsed(rows).select("imdb_id", F.col(RAW_RECORD).alias("raw_text"))


def missing_input(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows, and whether a scan before they were written was refused."""
    path = scratch_path(spark, "bronze")
    try:
        read_bronze(spark, path, _columns(entity))
        refused = 0
    except MissingInput:
        refused = 1
    _bronze(spark, sf_dir, entity).write.parquet(path)
    return _comparable(read_bronze(spark, path, _columns(entity))).withColumn("refused_before", F.lit(refused))


# --- streams -----------------------------------------------------------------------


def stream_bronze(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, lake, checkpoint = (scratch_path(spark, label) for label in ("landing", "bronze", "checkpoint"))
    to_folder(codec.encode(_bronze(spark, sf_dir, entity)), landing)
    finish(start_bronze(from_folder(spark, landing), _columns(entity), lake, checkpoint))
    return _comparable(read_bronze(spark, lake, _columns(entity)))


def stream_resume(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a first drain, after a second delivery, and after a rerun with no new input."""
    rows = _bronze(spark, sf_dir, entity)
    landing, lake, checkpoint = (scratch_path(spark, label) for label in ("landing", "bronze", "checkpoint"))
    first = F.col("ingestion_timestamp") < SECOND_DELIVERY[entity]
    states = []
    for drain, arrivals in enumerate((rows.where(first), rows.where(~first), None), start=1):
        if arrivals is not None:
            to_folder(codec.encode(arrivals), landing)
        finish(start_bronze(from_folder(spark, landing), _columns(entity), lake, checkpoint))
        landed = _comparable(read_bronze(spark, lake, _columns(entity)))
        states.append(landed.withColumn("drain", F.lit(drain)))
    return union_all(states)


def stream_window(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after as many runs as it takes with a time limit far below what the backlog needs."""
    landing, lake, checkpoint = (scratch_path(spark, label) for label in ("landing", "bronze", "checkpoint"))
    rows, batches = _bronze(spark, sf_dir, entity), 3
    files = max(batches, -(-rows.count() // ROWS_PER_FILE))
    to_folder(codec.encode(rows).repartition(files), landing)
    for _ in range(batches + 1):
        try:
            events = from_folder(spark, landing, max_files_per_trigger=-(-files // batches))
            finish(start_bronze(events, _columns(entity), lake, checkpoint), 0.001)
            break
        except TimeoutError:
            continue  # each run has committed a batch at least
    return _comparable(read_bronze(spark, lake, _columns(entity)))


def stream_quarantine(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that lack a field (release year, role) arrive as plain text; they land in a folder of their own."""
    rows = _bronze(spark, sf_dir, entity)
    note = F.concat_ws(" ", F.lit("lacking:"), *EVENT_KEY[entity])
    wire = F.when(F.expr(LACKING[entity]), note).otherwise(F.to_json(F.struct(*rows.columns)))
    landing, folder, checkpoint = (scratch_path(spark, label) for label in ("landing", "rejects", "checkpoint"))
    to_folder(rows.select(wire.cast("binary").alias("value")), landing)
    finish(start_rejects(from_folder(spark, landing), _columns(entity), folder, checkpoint))
    return spark.read.parquet(folder).select(F.col(codec.RAW_TEXT).alias("raw_text"))


def _feeds(spark: SparkSession, sf_dir: str) -> list[Feed]:
    exports = {
        entity: _export_by_platform(spark, sf_dir, entity, scratch_path(spark, "csv")) for entity in ("titles", "credits")
    }
    return [Feed(name, exports["titles"][name], exports["credits"][name]) for name in schemas.PLATFORMS]


def csv_to_bronze(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV exports of all platforms ingested to topics and drained into the lake."""
    topics, base = (scratch_path(spark, label) for label in ("topics", "lake"))
    feeds = _feeds(spark, sf_dir)
    ingest(spark, feeds, lambda events, topic: to_folder(events, f"{topics}/{topic}"), INGESTED_AT)
    lake = Lake(base)
    land_topics(spark, lambda session, topic: from_folder(session, f"{topics}/{topic}"), lake)
    path = lake.titles if entity == "titles" else lake.credits
    return _comparable(read_bronze(spark, path, _columns(entity)))


# --- projections, key rule, dedupe -------------------------------------------------


def strip_list_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _bronze(spark, sf_dir, "titles")
    lists = (list_text(name).alias(name) for name in ("genres", "production_countries"))
    return titles.select("id", *lists)


def require_keys_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.require_keys(_bronze(spark, sf_dir, "titles"), schemas.TITLE_REQUIRED)
    return _comparable(clean.clean_titles(rows))


def require_keys_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.require_keys(_bronze(spark, sf_dir, "credits"), schemas.CREDIT_REQUIRED)
    return clean.clean_credits(rows)


def transformed(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_stored(spark, sf_dir, entity))


# --- snapshots, star schema, marts, view -------------------------------------------


def snapshot_replaced(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, the second written twice in replacing mode, and a third replaced by nothing."""
    rows = _stored(spark, sf_dir, entity)
    path = scratch_path(spark, "snapshots")
    for day in (*SNAPSHOT_DAYS, SNAPSHOT_DAYS[-1]):
        write_snapshot(rows, path, day, replace_day=True)
    write_snapshot(rows, path, REMOVED_DAY)
    write_snapshot(rows.limit(0), path, REMOVED_DAY, replace_day=True)
    return _comparable(spark.read.parquet(path))


def snapshot(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days appended."""
    rows = _stored(spark, sf_dir, entity)
    path = scratch_path(spark, "snapshots")
    for day in SNAPSHOT_DAYS:
        write_snapshot(rows, path, day)
    return _comparable(spark.read.parquet(path))


def _stored_again(df: DataFrame, table: str) -> DataFrame:
    return tables.write_table(df, _new_database(df.sparkSession), table)


def dim_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_stored_again(star.dim_title(_stored(spark, sf_dir, "titles")), "dim_title"))


def dim_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_again(star.dim_person(_stored(spark, sf_dir, "credits")), "dim_person")


def fact_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_again(star.fact_credits(_stored(spark, sf_dir, "credits")), "fact_credits")


def mart(table: str, spark: SparkSession, sf_dir: str, nan_as_null: bool = False) -> DataFrame:
    platform, metric = schemas.MARTS[table]
    best = marts.top_n(_stored(spark, sf_dir, "titles"), platform, metric, nan_as_null=nan_as_null)
    return _comparable(_stored_again(best, table))


def popularity_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _new_database(spark)
    tables.write_table(star.dim_title(_stored(spark, sf_dir, "titles", database)), database, "dim_title")
    view = tables.create_popularity_view(spark, database)
    return view.select(
        "platform",
        "release_year",
        *_nan_flagged("avg_tmdb_popularity", F.round("avg_tmdb_popularity", 6)),
        F.round("avg_imdb_score", 6).alias("avg_imdb_score"),
    )


def _digests(outputs: dict[str, DataFrame]) -> DataFrame:
    """Per output: rows, and an order-free digest of its text, integer and date columns.

    The digest is the sum of the leading 32 bits of each row's md5, which any engine can compute.
    """
    parts = []
    for name, df in outputs.items():
        written = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c, kind in sorted(df.dtypes) if kind in EXACT]
        lead = F.conv(F.substring(F.md5(F.concat_ws("|", *written)), 1, 8), 16, 10).cast("long")
        parts.append(df.agg(F.lit(name).alias("output"), F.count("*").alias("row_count"), F.sum(lead).alias("digest")))
    return union_all(parts)


def _outputs(spark: SparkSession, tables: dict[str, DataFrame], lake: Lake) -> dict[str, DataFrame]:
    snapshots = {f"snapshots/{entity}": spark.read.parquet(f"{lake.snapshots}/{entity}") for entity in ("titles", "credits")}
    return tables | snapshots


def transform_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole transform job from stored bronze: every output, snapshots included."""
    lake = Lake(scratch_path(spark, "lake"))
    _bronze(spark, sf_dir, "titles").write.parquet(lake.titles)
    _bronze(spark, sf_dir, "credits").write.parquet(lake.credits)
    outputs = transform(
        spark,
        lake.titles,
        lake.credits,
        lake.snapshots,
        database=f"reelhouse_{uuid.uuid4().hex}",
        location=scratch_path(spark, "tables"),
        snapshot_date=SNAPSHOT_DAYS[0],
    )
    return _digests(_outputs(spark, outputs, lake))


def transform_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform job after each of two deliveries, the second time over the new days only.

    Some rows lack a usable timestamp, in both deliveries.
    """
    lake, topics = Lake(scratch_path(spark, "lake")), scratch_path(spark, "topics")
    settings = {"database": f"reelhouse_{uuid.uuid4().hex}", "location": scratch_path(spark, "tables"), "replace_day": True}
    receive = lambda session, topic: from_folder(session, f"{topics}/{topic}")
    for late, since in ((False, None), (True, datetime.date(2024, 1, 2))):
        for entity, topic in (("titles", schemas.TITLES_TOPIC), ("credits", schemas.CREDITS_TOPIC)):
            rows = _bronze(spark, sf_dir, entity).withColumn("ingestion_timestamp", F.expr(inputs.ODD_TIMES[entity]))
            arrived_late = F.coalesce(F.col("ingestion_timestamp") >= SECOND_DELIVERY[entity], F.lit(True))
            to_folder(codec.encode(rows.where(arrived_late if late else ~arrived_late)), f"{topics}/{topic}")
        land_topics(spark, receive, lake, by_day=True)
        outputs = transform(
            spark, lake.titles, lake.credits, lake.snapshots, snapshot_date=SNAPSHOT_DAYS[0], since=since, **settings
        )
    return _digests(_outputs(spark, outputs, lake))


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, from CSV exports to every table and snapshot."""
    topics, lake = scratch_path(spark, "topics"), Lake(scratch_path(spark, "lake"))
    outputs = run_daily(
        spark,
        DailyRun(
            feeds=tuple(_feeds(spark, sf_dir)),
            deliver=lambda events, topic: to_folder(events, f"{topics}/{topic}"),
            receive=lambda session, topic: from_folder(session, f"{topics}/{topic}"),
            lake=lake,
            database=f"reelhouse_{uuid.uuid4().hex}",
            location=scratch_path(spark, "tables"),
            ingested_at=INGESTED_AT,
            snapshot_date=SNAPSHOT_DAYS[0],
        ),
    )
    return _digests(_outputs(spark, outputs, lake))


# --- publish -----------------------------------------------------------------------


def _database_target(spark: SparkSession) -> jdbc.JdbcTarget:
    """The database of `spark.reelhouse.jdbc.*`; on a local session a new in-memory Derby.

    In-memory Derby lives in one process, so it can stand in only where all tasks run in
    the driver's process.
    """
    setting = {key: spark.conf.get(f"spark.reelhouse.jdbc.{key}", None) for key in ("url", "driver", "user", "password")}
    if setting["url"]:
        return jdbc.JdbcTarget(**setting)
    if not is_local(spark):
        raise RuntimeError("spark.reelhouse.jdbc.url must name a database that every executor can reach")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
    return jdbc.JdbcTarget(
        url=f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver"
    )


def _column_types(types: dict[str, str], required: tuple[str, ...], target: jdbc.JdbcTarget) -> str:
    """Column types for the target. Spark cannot write null to a Derby VARCHAR, only to its long text."""
    if target.url.startswith("jdbc:derby:"):
        types = {name: kind for name, kind in types.items() if name in required or "VARCHAR" not in kind}
    return schemas.ddl(types)


def _published(spark: SparkSession, target: jdbc.JdbcTarget, table: str) -> DataFrame:
    """A published table read back, in a task for each platform and one for any other."""
    named = [f"\"platform\" = '{platform}'" for platform in schemas.PLATFORMS]
    rest = f"\"platform\" IS NULL OR NOT ({' OR '.join(named)})"
    options = {key: value for key, value in target.options().items() if key != "url"}
    return spark.read.jdbc(target.url, table, predicates=[*named, rest], properties=options)


def publish_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stored tables published by the job, which swaps them in together, and read back."""
    database, target = _new_database(spark), _database_target(spark)
    types = {}
    for entity, table, declared, required in (
        ("titles", schemas.TRANSFORMED_TITLES, schemas.PUBLISHED_TITLE_TYPES, schemas.TITLE_REQUIRED),
        ("credits", schemas.TRANSFORMED_CREDITS, schemas.PUBLISHED_CREDIT_TYPES, schemas.CREDIT_REQUIRED),
    ):
        _stored(spark, sf_dir, entity, database)
        types[table] = _column_types(declared, required, target)
    publish_tables(spark, target, database, types)
    return _digests({table: _published(spark, target, table) for table in types})


def publish(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table published and read back from the database."""
    if entity == "titles":
        table, types, required = schemas.TRANSFORMED_TITLES, schemas.PUBLISHED_TITLE_TYPES, schemas.TITLE_REQUIRED
    else:
        table, types, required = schemas.TRANSFORMED_CREDITS, schemas.PUBLISHED_CREDIT_TYPES, schemas.CREDIT_REQUIRED
    target = _database_target(spark)
    jdbc.publish(_stored(spark, sf_dir, entity), table, target, _column_types(types, required, target))
    published = _published(spark, target, table)
    columns = (F.col(name).cast("string") if kind == "date" else F.col(name) for name, kind in published.dtypes)
    return published.select(*columns)


QUERIES = {
    "bronze_titles": partial(bronze, "titles"),
    "bronze_credits": partial(bronze, "credits"),
    "csv_scan_titles": partial(csv_scan, "titles"),
    "csv_scan_credits": partial(csv_scan, "credits"),
    "tag_union_titles": partial(tag_union, "titles"),
    "tag_union_credits": partial(tag_union, "credits"),
    "sample_titles": partial(sample, "titles"),
    "sample_credits": partial(sample, "credits"),
    "encode_titles": partial(encode, "titles"),
    "encode_credits": partial(encode, "credits"),
    "decode_titles": partial(decode, "titles"),
    "decode_credits": partial(decode, "credits"),
    "decode_event_props": decode_event_props,
    "quarantine": partial(quarantine, "titles"),
    "quarantine_credits": partial(quarantine, "credits"),
    "csv_rejects": csv_rejects,
    "missing_input_titles": partial(missing_input, "titles"),
    "missing_input_credits": partial(missing_input, "credits"),
    "stream_bronze_titles": partial(stream_bronze, "titles"),
    "stream_bronze_credits": partial(stream_bronze, "credits"),
    "stream_resume": partial(stream_resume, "titles"),
    "stream_resume_credits": partial(stream_resume, "credits"),
    "stream_window_titles": partial(stream_window, "titles"),
    "stream_window_credits": partial(stream_window, "credits"),
    "stream_quarantine": partial(stream_quarantine, "titles"),
    "stream_quarantine_credits": partial(stream_quarantine, "credits"),
    "csv_to_bronze_titles": partial(csv_to_bronze, "titles"),
    "csv_to_bronze_credits": partial(csv_to_bronze, "credits"),
    "strip_list_text": strip_list_text,
    "require_keys_titles": require_keys_titles,
    "require_keys_credits": require_keys_credits,
    "titles_clean": partial(transformed, "titles"),
    "credits_clean": partial(transformed, "credits"),
    "snapshot_titles": partial(snapshot, "titles"),
    "snapshot_credits": partial(snapshot, "credits"),
    "snapshot_replaced_titles": partial(snapshot_replaced, "titles"),
    "snapshot_replaced_credits": partial(snapshot_replaced, "credits"),
    "dim_title": dim_title,
    "dim_person": dim_person,
    "fact_credits": fact_credits,
    "netflix_popularity": partial(mart, "curated_netflix_popularity"),
    "netflix_popularity_nan_last": partial(mart, "curated_netflix_popularity", nan_as_null=True),
    "disney_trending": partial(mart, "curated_disney_trending"),
    "popularity_by_year": popularity_by_year,
    "transform_tables": transform_tables,
    "transform_incremental": transform_incremental,
    "daily_run": daily_run,
    "publish_job": publish_job,
    "publish_titles": partial(publish, "titles"),
    "publish_credits": partial(publish, "credits"),
}
