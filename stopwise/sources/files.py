"""Folders of the lake, through the file system Spark itself uses for their path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the paths that exist."""
    return [path for path in paths if _at(spark, path)[0].exists(_at(spark, path)[1])]


def children(spark: SparkSession, path: str) -> list[str]:
    """Folders in a folder, hidden ones left out; none if it does not exist."""
    system, folder = _at(spark, path)
    if not system.exists(folder):
        return []
    found = [x.getPath() for x in system.listStatus(folder) if x.isDirectory()]
    return sorted(str(x) for x in found if not x.getName().startswith(("_", ".")))


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder; the place it goes to must be free."""
    system, folder = _at(spark, path)
    _, place = _at(spark, to)
    system.mkdirs(place.getParent())
    if system.exists(place) or not system.rename(folder, place):
        raise OSError(f"cannot move {path} to {to}")


def delete(spark: SparkSession, path: str) -> None:
    system, folder = _at(spark, path)
    system.delete(folder, True)
