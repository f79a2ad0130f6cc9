"""Events to table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise import schemas

LINEAGE = (
    "source",
    "schema_version",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
)


def _inner(struct: str, *names: str) -> list[Column]:
    return [F.col(f"{struct}.{name}").alias(name) for name in names]


def vehicle_rows(events: DataFrame) -> DataFrame:
    """One row per vehicle event."""
    return events.select(
        "event_id",
        "vehicle_id",
        F.col("source_timestamp").alias("event_timestamp"),
        "feed_timestamp",
        "published_at",
        "ingested_at",
        "route_id",
        "trip_id",
        *_inner(
            "payload",
            "latitude",
            "longitude",
            "bearing",
            "odometer",
            "speed_mps",
            "occupancy_status",
        ),
        *LINEAGE,
    )


def stop_update_rows(events: DataFrame) -> DataFrame:
    """One row per stop of a trip update, numbered from 0.

    A start date that is no calendar date becomes null instead of failing the
    stream: eight digits satisfy the contract, a thirteenth month included.
    """
    stops = events.select("*", F.posexplode("payload.stop_time_updates").alias("position", "stop"))
    return stops.select(
        "event_id",
        F.col("position").alias("stop_update_index"),
        F.col("source_timestamp").alias("event_timestamp"),
        "feed_timestamp",
        "ingested_at",
        "published_at",
        "trip_id",
        F.to_date(F.try_to_timestamp("start_date", F.lit("yyyyMMdd"))).alias("start_date"),
        "start_time",
        "route_id",
        "vehicle_id",
        *_inner("payload", "direction_id"),
        F.col("payload.schedule_relationship").alias("trip_schedule_relationship"),
        *_inner("payload", "trip_delay_seconds"),
        *_inner(
            "stop",
            "stop_id",
            "stop_sequence",
            "predicted_arrival",
            "predicted_departure",
            "delay_seconds",
        ),
        F.col("stop.schedule_relationship").alias("stop_schedule_relationship"),
        *LINEAGE,
    )


def alert_entity_rows(events: DataFrame) -> DataFrame:
    """One row per entity an alert informs, numbered from 0; periods as JSON text."""
    entities = events.select(
        "*", F.posexplode("payload.informed_entities").alias("position", "entity")
    )
    return entities.select(
        "event_id",
        F.col("position").alias("informed_entity_index"),
        "alert_id",
        F.col("source_timestamp").alias("event_timestamp"),
        "feed_timestamp",
        "ingested_at",
        "published_at",
        *_inner(
            "payload",
            "cause",
            "effect",
            "severity",
            "header_text",
            "description_text",
            "url",
        ),
        F.to_json("payload.active_periods").alias("active_periods"),
        *_inner(
            "entity",
            "agency_id",
            "route_id",
            "route_type",
            "trip_id",
            "stop_id",
            "direction_id",
        ),
        *LINEAGE,
    )


def periods_of(column: str = "active_periods") -> Column:
    """Active periods read back from their JSON text."""
    return F.from_json(F.col(column), schemas.ACTIVE_PERIODS)


# Columns of an alert entity that its period rows leave out.
_NOT_ON_PERIODS = (
    "active_periods",
    "ingested_at",
    "published_at",
    "created_at",
    "source",
    "schema_version",
    "service_id",
    "parent_station",
    "platform_code",
)


def alert_period_rows(alerts: DataFrame) -> DataFrame:
    """One row per active period, numbered from 1.

    An entity without periods keeps one row with null period columns.
    """
    expanded = alerts.select(
        "*", F.posexplode_outer(periods_of()).alias("period_position", "period")
    )
    own = ("event_id", "informed_entity_index", "alert_id")
    return expanded.select(
        *own,
        (F.col("period_position") + 1).alias("active_period_index"),
        F.col("period.start").alias("active_period_start"),
        F.col("period.end").alias("active_period_end"),
        *[name for name in alerts.columns if name not in (*own, *_NOT_ON_PERIODS)],
    )
