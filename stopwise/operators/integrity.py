"""References between static schedule tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions.text import empty_to_null


def active_services(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """Services that run on some day: in the calendar, or added by a date."""
    added = calendar_dates.where(F.col("exception_type") == 1)
    return calendar.select("service_id").union(added.select("service_id")).distinct()


def orphans(children: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Values that have no parent (an absent value included) and how many rows hold them.

    Values are counted before the join, so a value held by very many rows
    reaches the join as a single row.
    """
    values = children.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
    known = parents.select(F.col(parent_column).alias("value"))
    return values.join(known, "value", "left_anti")


def broken_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All broken references of a static schedule."""
    services = active_services(tables["calendar"], tables["calendar_dates"])
    nested = tables["stops"].where(empty_to_null(F.col("parent_station")).isNotNull())
    checks = {
        "trips.route_id": orphans(tables["trips"], "route_id", tables["routes"], "route_id"),
        "stop_times.trip_id": orphans(tables["stop_times"], "trip_id", tables["trips"], "trip_id"),
        "stop_times.stop_id": orphans(tables["stop_times"], "stop_id", tables["stops"], "stop_id"),
        "trips.service_id": orphans(tables["trips"], "service_id", services, "service_id"),
        "stops.parent_station": orphans(nested, "parent_station", tables["stops"], "stop_id"),
    }
    result = None
    for label, found in checks.items():
        labelled = found.select(F.lit(label).alias("reference"), "value", "row_count")
        result = labelled if result is None else result.unionByName(labelled)
    return result


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    result = None
    for name, table in tables.items():
        counted = table.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        result = counted if result is None else result.unionByName(counted)
    return result
