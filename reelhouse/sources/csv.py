"""Scan of a platform's CSV export."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.schemas import ddl
from reelhouse.sources.errors import MissingInput

# Holds the text of a record of which some field does not parse.
RAW_RECORD = "_raw_record"


def _unfinished_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines that are not a whole record by themselves, each as the path of its file.

    Once doubled quotes and complete quoted fields are taken out, a whole record has no quote
    left. Lines without any quote, mostly all, are not searched further. One scan over the lines, in as many tasks
    as the files have splits.
    """
    line = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    rest = F.regexp_replace(line, r'(^|,)"[^"]*"(?=,|$)', "$1")
    unfinished = F.when(F.contains("value", F.lit('"')), F.contains(rest, F.lit('"')))
    return spark.read.text(path).where(unfinished).select("_metadata.file_path")


def has_split_records(spark: SparkSession, path: str) -> bool:
    """Whether some line of the files is not a whole record by itself."""
    return not _unfinished_lines(spark, path).isEmpty()


def _scans(spark: SparkSession, path: str, multi_line: bool | None) -> list[tuple[str | list[str], bool]]:
    """What to read line by line and what as whole files: (paths, multi_line).

    To the driver come names of files, all of which it lists for a scan anyway.
    """
    if multi_line is not None:
        return [(path, multi_line)]
    whole = {unquote(row["file_path"]) for row in _unfinished_lines(spark, path).distinct().collect()}
    if not whole:
        return [(path, False)]
    split = [file for file in map(unquote, spark.read.text(path).inputFiles()) if _plain(file) not in map(_plain, whole)]
    return [(split, False), (sorted(whole), True)] if split else [(path, True)]


def _plain(file: str) -> str:
    """One spelling of a local file's name: with a single slash after the scheme."""
    return file.replace("file:///", "file:/", 1)


def read_csv(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
    multi_line: bool | None = None,
    required: Iterable[str] = (),
    keep_raw: bool = False,
) -> DataFrame:
    """Read CSV files with a header row into the given columns, matched by name.

    Types come from `columns`, so there is no inference pass. Columns the files lack are
    null, unless they are `required`, which is an error; others are not read, and a file whose header
    differs from the first one's fails the scan. An empty field is null, quoted or not; other text, such
    as NA, stays text. A field that does not parse is null; `keep_raw` adds a column RAW_RECORD with the text of
    such records.

    Quoted fields may hold line breaks (CR LF becomes LF where it also ends the lines). Files
    that have such fields cannot be split, so each is read by one task; all others are
    split. Which of the two a file is, is looked up in it unless `multi_line` says so for all.
    """
    scans = _scans(spark, path, multi_line)
    layout = {"header": True, "escape": '"', "enforceSchema": False}
    header = spark.read.csv(scans[0][0], multiLine=scans[0][1], **layout).columns
    if not header:
        raise MissingInput(f"no header row in {path}")
    absent = [name for name in required if name not in header]
    if absent:
        raise MissingInput(f"{path} lacks the columns {absent}; its header has {header}")
    typed = {name: columns.get(name, "string") for name in header}
    if keep_raw:
        typed[RAW_RECORD] = "string"
        layout["columnNameOfCorruptRecord"] = RAW_RECORD
    wanted = [
        *(
            F.col(f"`{name}`") if name in header else F.lit(None).cast(kind).alias(name)
            for name, kind in columns.items()
        ),
        *([F.col(RAW_RECORD)] if keep_raw else []),
    ]
    parts = [spark.read.schema(ddl(typed)).csv(files, multiLine=whole, **layout).select(*wanted) for files, whole in scans]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def unparsed(rows: DataFrame) -> DataFrame:
    """Of rows read with `keep_raw`, those that have a field which does not parse.

    Spark parses only the fields a query uses, so the condition has to use them all.
    """
    every_field = F.xxhash64(*(name for name in rows.columns if name != RAW_RECORD)) >= F.lit(-(2**63))
    return rows.where(F.col(RAW_RECORD).isNotNull() & every_field)
