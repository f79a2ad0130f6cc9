"""Feed entities to events.

Input: one row per feed entity with the columns of ``schemas.FEED_ENTITY``,
``feed_timestamp`` (epoch seconds) and ``ingested_at``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise import settings
from stopwise.functions.text import empty_to_null, first_text, translated
from stopwise.functions.times import moment


def usable_feed(entities: DataFrame) -> DataFrame:
    """Entities whose feed header carries a time."""
    return entities.where(F.col("feed_timestamp").isNotNull())


def unusable_feed(entities: DataFrame) -> DataFrame:
    """Entities to quarantine: the feed header lacks its time."""
    return entities.where(F.col("feed_timestamp").isNull())


def _live(entities: DataFrame, kind: str) -> DataFrame:
    return usable_feed(entities).where(
        ~F.coalesce(F.col("is_deleted"), F.lit(False)) & F.col(kind).isNotNull()
    )


def _header(event_type: str, epoch: Column, published_at) -> list[Column]:
    return [
        F.concat_ws(":", F.col("id"), epoch.cast("string")).alias("event_id"),
        F.lit(event_type).alias("event_type"),
        F.lit(settings.SCHEMA_VERSION).alias("schema_version"),
        F.lit(settings.EVENT_SOURCE).alias("source"),
        F.timestamp_seconds(epoch).alias("source_timestamp"),
        F.timestamp_seconds(F.col("feed_timestamp")).alias("feed_timestamp"),
        F.col("ingested_at"),
        moment(published_at).alias("published_at"),
    ]


def vehicle_events(entities: DataFrame, published_at=None) -> DataFrame:
    """Vehicle entities with a position."""
    vehicle = F.col("vehicle")
    trip, position, descriptor = vehicle["trip"], vehicle["position"], vehicle["vehicle"]
    epoch = F.coalesce(vehicle["timestamp"], F.col("feed_timestamp"))
    return (
        _live(entities, "vehicle")
        .where(position.isNotNull())
        .select(
            *_header(settings.VEHICLE_EVENT, epoch, published_at),
            empty_to_null(trip["route_id"]).alias("route_id"),
            empty_to_null(trip["trip_id"]).alias("trip_id"),
            first_text(descriptor["id"], F.col("id")).alias("vehicle_id"),
            F.struct(
                position["latitude"].alias("latitude"),
                position["longitude"].alias("longitude"),
                position["bearing"].alias("bearing"),
                position["odometer"].alias("odometer"),
                position["speed"].alias("speed_mps"),
                trip["direction_id"].alias("direction_id"),
                vehicle["current_stop_sequence"].alias("current_stop_sequence"),
                empty_to_null(vehicle["stop_id"]).alias("stop_id"),
                vehicle["current_status"].alias("current_status"),
                empty_to_null(descriptor["label"]).alias("vehicle_label"),
                vehicle["occupancy_status"].alias("occupancy_status"),
            ).alias("payload"),
        )
    )


def trip_events(entities: DataFrame, published_at=None) -> DataFrame:
    """Trip updates with a trip id; a cancelled trip keeps its empty stop list."""
    update = F.col("trip_update")
    trip = update["trip"]
    epoch = F.coalesce(update["timestamp"], F.col("feed_timestamp"))

    def stop(item: Column) -> Column:
        return F.struct(
            empty_to_null(item["stop_id"]).alias("stop_id"),
            item["stop_sequence"].alias("stop_sequence"),
            F.timestamp_seconds(item["arrival"]["time"]).alias("predicted_arrival"),
            F.timestamp_seconds(item["departure"]["time"]).alias("predicted_departure"),
            F.coalesce(
                item["arrival"]["delay"], item["departure"]["delay"], update["delay"]
            ).alias("delay_seconds"),
            item["schedule_relationship"].alias("schedule_relationship"),
        )

    return (
        _live(entities, "trip_update")
        .where(empty_to_null(trip["trip_id"]).isNotNull())
        .select(
            *_header(settings.TRIP_EVENT, epoch, published_at),
            empty_to_null(trip["route_id"]).alias("route_id"),
            trip["trip_id"].alias("trip_id"),
            empty_to_null(trip["start_date"]).alias("start_date"),
            empty_to_null(trip["start_time"]).alias("start_time"),
            empty_to_null(update["vehicle"]["id"]).alias("vehicle_id"),
            F.struct(
                trip["direction_id"].alias("direction_id"),
                trip["schedule_relationship"].alias("schedule_relationship"),
                update["delay"].alias("trip_delay_seconds"),
                F.coalesce(F.transform(update["stop_time_update"], stop), F.array()).alias(
                    "stop_time_updates"
                ),
            ).alias("payload"),
        )
    )


def alert_events(entities: DataFrame, published_at=None) -> DataFrame:
    """Alerts that inform at least one entity; their time is that of the feed."""
    alert = F.col("alert")

    def period(item: Column) -> Column:
        return F.struct(
            F.timestamp_seconds(item["start"]).alias("start"),
            F.timestamp_seconds(item["end"]).alias("end"),
        )

    def target(item: Column) -> Column:
        trip = item["trip"]
        return F.struct(
            empty_to_null(item["agency_id"]).alias("agency_id"),
            first_text(item["route_id"], trip["route_id"]).alias("route_id"),
            item["route_type"].alias("route_type"),
            empty_to_null(trip["trip_id"]).alias("trip_id"),
            empty_to_null(item["stop_id"]).alias("stop_id"),
            F.coalesce(item["direction_id"], trip["direction_id"]).alias("direction_id"),
        )

    return (
        _live(entities, "alert")
        .where(F.size(alert["informed_entity"]) > 0)
        .select(
            *_header(settings.ALERT_EVENT, F.col("feed_timestamp"), published_at),
            F.col("id").alias("alert_id"),
            F.struct(
                alert["cause"].alias("cause"),
                alert["effect"].alias("effect"),
                alert["severity_level"].alias("severity"),
                translated(alert["header_text"]).alias("header_text"),
                translated(alert["description_text"]).alias("description_text"),
                translated(alert["url"]).alias("url"),
                F.coalesce(F.transform(alert["active_period"], period), F.array()).alias(
                    "active_periods"
                ),
                F.transform(alert["informed_entity"], target).alias("informed_entities"),
            ).alias("payload"),
        )
    )


@dataclass(frozen=True)
class Feed:
    """How one polled feed becomes a stream."""

    normalize: Callable[..., DataFrame]
    topic: str
    key: str


FEEDS = {
    "vehicle_positions": Feed(vehicle_events, settings.VEHICLE_TOPIC, "vehicle_id"),
    "trip_updates": Feed(trip_events, settings.TRIP_TOPIC, "trip_id"),
    "alerts": Feed(alert_events, settings.ALERT_TOPIC, "alert_id"),
}


# Keep null fields and whole microseconds.
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def published_messages(events: DataFrame, topic: str, key: str) -> DataFrame:
    """Key, JSON text and topic of events; null fields are kept, as contracts ask."""
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("*"), _JSON).alias("value"),
        F.lit(topic).alias("topic"),
    )


def all_messages(entities: DataFrame, published_at=None) -> DataFrame:
    """Messages of all feeds, from one table of mixed entities."""
    messages = [
        published_messages(feed.normalize(entities, published_at), feed.topic, feed.key)
        for feed in FEEDS.values()
    ]
    return messages[0].unionByName(messages[1]).unionByName(messages[2])
