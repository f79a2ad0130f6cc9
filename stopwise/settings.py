"""Tunable parameters shared by the batch and streaming plans."""

from __future__ import annotations

from dataclasses import dataclass

# Event identity, as carried in every event.
EVENT_SOURCE = "mbta_gtfs_realtime"
SCHEMA_VERSION = 1
VEHICLE_EVENT = "vehicle_position"
TRIP_EVENT = "trip_update"
ALERT_EVENT = "service_alert"
DEAD_LETTER_EVENT = "dead_letter"

# Stream names.
VEHICLE_TOPIC = "transit.vehicle_positions.v1"
TRIP_TOPIC = "transit.trip_updates.v1"
ALERT_TOPIC = "transit.service_alerts.v1"
DEAD_LETTER_TOPIC = "transit.dead_letter.v1"

# Direction of a sample whose feed and schedule give none.
UNKNOWN_DIRECTION = -1


@dataclass(frozen=True)
class Settings:
    """Parameters of the derived tables."""

    timezone: str = "America/New_York"
    bucket_minutes: int = 5
    late_threshold_seconds: int = 300
    route_type: int = 3
    vehicle_freshness_seconds: int = 90
    alert_freshness_seconds: int = 600


DEFAULTS = Settings()
