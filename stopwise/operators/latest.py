"""Newest row, or newest rows, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(rows: DataFrame, keys: list[str], order: list[Column], keep: int = 1) -> DataFrame:
    """The first ``keep`` rows of each key in the given order.

    The rank limit is applied before the shuffle as well as after it, so a hot
    key costs at most ``keep`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") <= keep).drop("_rank")


def newest_positions(positions: DataFrame) -> DataFrame:
    """Latest stored position of each vehicle."""
    order = [
        F.col(name).desc_nulls_first() for name in ("event_timestamp", "ingested_at", "event_id")
    ]
    return newest_per_key(positions, ["vehicle_id"], order)


def last_values(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Newest row per key as an aggregate; also runs on a stream in complete mode."""
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct("*"), order).alias("_row"))
    return newest.select("_row.*")
