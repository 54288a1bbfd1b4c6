"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Used where neither the caller nor spark-submit sets them. Adaptive execution, which merges
# small shuffle partitions and splits skewed joins, is on in Spark by default.
DEFAULTS = {
    # "today" and ingestion times do not depend on the machine
    "spark.sql.session.timeZone": "UTC",
    # about a quarter smaller than snappy on catalogue tables
    "spark.sql.parquet.compression.codec": "zstd",
    # target size of a merged shuffle partition, and so of a written file; small data still
    # gets a partition per core
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def build_session(
    app_name: str = "reelhouse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    hive: bool = False,
    **settings: str,
) -> SparkSession:
    """A session with the settings the jobs are planned for.

    On a cluster leave `master` to spark-submit and give `shuffle_partitions` as the
    upper bound (about one per 200 MB shuffled): adaptive execution merges small ones.
    """
    if master:
        settings["spark.master"] = master
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in settings and not given.contains(key):
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with these settings, and afterwards with what it had. A stream that starts takes a copy of them."""
    given = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in given.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in the driver's own process; on a local-cluster they do not."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")) is not None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the cluster's shared checkpoint folder.

    The folder is named by `spark.checkpoint.dir`. Only a local session may go without
    that setting, because only there every task sees the machine's own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/reelhouse/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Store a frame in the shared checkpoint folder, so that a lost executor repeats nothing before it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()
