"""Validity of parsed events, and the split it drives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise import settings
from stopwise.functions.text import has_text

FLAG = "_is_valid"
CORRUPT = "_corrupt_record"


def _optional(value: Column, check: Column) -> Column:
    return value.isNull() | check


def _direction_ok(value: Column) -> Column:
    return _optional(value, value.isin(0, 1))


def _all(*checks: Column) -> Column:
    """Conjunction in which unknown counts as failed."""
    return F.coalesce(reduce(lambda left, right: left & right, checks), F.lit(False))


def _header_ok(event_type: str) -> Column:
    times = ("source_timestamp", "feed_timestamp", "ingested_at", "published_at")
    return _all(
        has_text(F.col("event_id")),
        F.col("event_type") == event_type,
        F.col("schema_version") == settings.SCHEMA_VERSION,
        F.col("source") == settings.EVENT_SOURCE,
        *[F.col(name).isNotNull() for name in times],
        F.col("payload").isNotNull(),
    )


def vehicle_is_valid() -> Column:
    payload = F.col("payload")
    return _all(
        _header_ok(settings.VEHICLE_EVENT),
        has_text(F.col("vehicle_id")),
        payload["latitude"].between(-90.0, 90.0),
        payload["longitude"].between(-180.0, 180.0),
        _optional(payload["bearing"], payload["bearing"].between(0.0, 360.0)),
        _optional(payload["odometer"], payload["odometer"] >= 0),
        _optional(payload["speed_mps"], payload["speed_mps"] >= 0),
    )


def trip_update_is_valid() -> Column:
    payload = F.col("payload")

    def stop_ok(stop: Column) -> Column:
        order = stop["stop_sequence"]
        return (has_text(stop["stop_id"]) | order.isNotNull()) & _optional(order, order >= 0)

    return _all(
        _header_ok(settings.TRIP_EVENT),
        has_text(F.col("trip_id")),
        F.forall(payload["stop_time_updates"], stop_ok),
        _direction_ok(payload["direction_id"]),
    )


def alert_is_valid() -> Column:
    payload = F.col("payload")

    def entity_ok(entity: Column) -> Column:
        return (
            entity.isNotNull()
            & _direction_ok(entity["direction_id"])
            & _optional(entity["route_type"], entity["route_type"] >= 0)
        )

    def period_ok(period: Column) -> Column:
        return period.isNotNull() & F.coalesce(period["start"] <= period["end"], F.lit(True))

    return _all(
        _header_ok(settings.ALERT_EVENT),
        F.col(CORRUPT).isNull(),
        has_text(F.col("alert_id")),
        F.forall(payload["active_periods"], period_ok),
        F.size(payload["informed_entities"]) > 0,
        F.forall(payload["informed_entities"], entity_ok),
    )


def with_flag(events: DataFrame, condition: Column) -> DataFrame:
    return events.withColumn(FLAG, condition)


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid events, without the flag."""
    return (
        flagged.where(F.col(FLAG)).drop(FLAG),
        flagged.where(~F.col(FLAG)).drop(FLAG),
    )
