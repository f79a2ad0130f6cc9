"""Stored tables and parameterised reads of them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

STAGED = (
    "vehicle_positions",
    "trip_stop_updates",
    "service_alert_entities",
    "routes",
    "stops",
    "trips",
    "stop_times",
    "calendar",
    "calendar_dates",
)


def read_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = STAGED
) -> dict[str, DataFrame]:
    """Parquet tables of a folder, by name."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def read_query(
    spark: SparkSession,
    query: str,
    parameters: Mapping[str, object] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """SQL over the given tables (``{name}`` in the text).

    Values travel as bound parameters (``:name``), never as text.
    """
    return spark.sql(query, args=dict(parameters or {}), **tables)


def replace_table(rows: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Write a table in place of the previous one, whole.

    The rows go to a new snapshot folder, and one small file then names it as the one in
    force. Readers (``read_table``) see the old table or the new one; a failed write
    changes nothing, and the session's overwrite mode does not matter. Rows are
    rebalanced by the partition columns, so a partition is written by few tasks, and by
    several when it is large.
    """
    spark = rows.sparkSession
    columns = tuple(partition_by)
    known = _versions(spark, path)
    version = 1 + max((row["version"] for row in known), default=0)
    snapshot = f"snapshot-{version:08d}-{uuid.uuid4().hex[:8]}"
    if columns:
        balanced = rows.hint("rebalance", *columns)
        balanced.write.partitionBy(*columns).parquet(f"{path}/{snapshot}")
    else:
        rows.write.parquet(f"{path}/{snapshot}")
    spark.createDataFrame([(version, snapshot)], _VERSION).coalesce(1).write.mode(
        "append"
    ).json(f"{path}/{_POINTER}")


_POINTER = "_current"
_VERSION = "version bigint, snapshot string"


def _versions(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.schema(_VERSION).json(f"{path}/{_POINTER}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot in force of a table written by ``replace_table``."""
    known = _versions(spark, path)
    if not known:
        raise ValueError(f"no table has been written to {path}")
    newest = max(known, key=lambda row: (row["version"], row["snapshot"]))
    return spark.read.parquet(f"{path}/{newest['snapshot']}")
