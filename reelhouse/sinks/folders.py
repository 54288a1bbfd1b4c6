"""Folders of any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it does not exist."""
    files, place = _open(spark, path)
    files.delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    files, place = _open(spark, path)
    if not files.exists(place):
        return []
    return [each.getPath().toString() for each in files.listStatus(place) if each.isDirectory()]
