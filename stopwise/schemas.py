"""Column layouts, written as Spark DDL.

Fixed values: field names and types of the events and tables.
"""

from __future__ import annotations

ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
# The same envelope as text, the form in which files carry it.
ENVELOPE_TEXT = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

_HEADER = (
    "event_id string, event_type string, schema_version int, source string, "
    "source_timestamp timestamp, feed_timestamp timestamp, "
    "ingested_at timestamp, published_at timestamp"
)

VEHICLE_PAYLOAD = (
    "struct<latitude: double, longitude: double, bearing: double, odometer: double, "
    "speed_mps: double, direction_id: int, current_stop_sequence: int, stop_id: string, "
    "current_status: string, vehicle_label: string, occupancy_status: string>"
)
VEHICLE_EVENT = (
    f"{_HEADER}, route_id string, trip_id string, vehicle_id string, payload {VEHICLE_PAYLOAD}"
)

STOP_TIME_UPDATE = (
    "struct<stop_id: string, stop_sequence: int, predicted_arrival: timestamp, "
    "predicted_departure: timestamp, delay_seconds: int, schedule_relationship: string>"
)
TRIP_PAYLOAD = (
    "struct<direction_id: int, schedule_relationship: string, trip_delay_seconds: int, "
    f"stop_time_updates: array<{STOP_TIME_UPDATE}>>"
)
TRIP_EVENT = (
    f"{_HEADER}, route_id string, trip_id string, start_date string, start_time string, "
    f"vehicle_id string, payload {TRIP_PAYLOAD}"
)

ACTIVE_PERIODS = "array<struct<start: timestamp, end: timestamp>>"
INFORMED_ENTITIES = (
    "array<struct<agency_id: string, route_id: string, route_type: int, trip_id: string, "
    "stop_id: string, direction_id: int>>"
)
ALERT_PAYLOAD = (
    "struct<cause: string, effect: string, severity: string, header_text: string, "
    "description_text: string, tts_header_text: string, tts_description_text: string, "
    f"url: string, active_periods: {ACTIVE_PERIODS}, informed_entities: {INFORMED_ENTITIES}>"
)
ALERT_EVENT = f"{_HEADER}, alert_id string, payload {ALERT_PAYLOAD}"

# Feed entities in their JSON form, times in epoch seconds.
_TRIP_DESCRIPTOR = (
    "struct<trip_id: string, route_id: string, start_date: string, start_time: string, "
    "direction_id: int, schedule_relationship: string>"
)
_VEHICLE_DESCRIPTOR = "struct<id: string, label: string>"
_TRANSLATED = "struct<translation: array<struct<text: string, language: string>>>"
_STOP_EVENT = "struct<time: bigint, delay: int>"
FEED_ENTITY = (
    "id string, is_deleted boolean, "
    f"vehicle struct<trip: {_TRIP_DESCRIPTOR}, vehicle: {_VEHICLE_DESCRIPTOR}, "
    "position: struct<latitude: double, longitude: double, bearing: double, odometer: double, "
    "speed: double>, current_stop_sequence: int, stop_id: string, current_status: string, "
    "timestamp: bigint, occupancy_status: string>, "
    f"trip_update struct<trip: {_TRIP_DESCRIPTOR}, vehicle: {_VEHICLE_DESCRIPTOR}, "
    "timestamp: bigint, delay: int, stop_time_update: array<struct<stop_sequence: int, "
    f"stop_id: string, arrival: {_STOP_EVENT}, departure: {_STOP_EVENT}, "
    "schedule_relationship: string>>>, "
    "alert struct<active_period: array<struct<start: bigint, end: bigint>>, "
    "informed_entity: array<struct<agency_id: string, route_id: string, route_type: int, "
    f"trip: {_TRIP_DESCRIPTOR}, stop_id: string, direction_id: int>>, cause: string, "
    f"effect: string, severity_level: string, header_text: {_TRANSLATED}, "
    f"description_text: {_TRANSLATED}, url: {_TRANSLATED}>"
)

# Static schedule tables: (column, type, required in every feed).
STATIC_TABLES: dict[str, list[tuple[str, str, bool]]] = {
    "routes": [
        ("route_id", "string", True),
        ("agency_id", "string", False),
        ("route_short_name", "string", False),
        ("route_long_name", "string", False),
        ("route_desc", "string", False),
        ("route_type", "int", True),
        ("route_color", "string", False),
        ("route_text_color", "string", False),
        ("route_url", "string", False),
        ("route_sort_order", "int", False),
        ("route_fare_class", "string", False),
        ("line_id", "string", False),
        ("listed_route", "int", False),
        ("network_id", "string", False),
    ],
    "stops": [
        ("stop_id", "string", True),
        ("stop_code", "string", False),
        ("stop_name", "string", False),
        ("stop_desc", "string", False),
        ("platform_name", "string", False),
        ("zone_id", "string", False),
        ("stop_address", "string", False),
        ("stop_url", "string", False),
        ("level_id", "string", False),
        ("municipality", "string", False),
        ("on_street", "string", False),
        ("at_street", "string", False),
        ("vehicle_type", "int", False),
        ("stop_lat", "double", False),
        ("stop_lon", "double", False),
        ("location_type", "int", False),
        ("parent_station", "string", False),
        ("wheelchair_boarding", "int", False),
        ("platform_code", "string", False),
    ],
    "trips": [
        ("trip_id", "string", True),
        ("route_id", "string", True),
        ("service_id", "string", True),
        ("trip_headsign", "string", False),
        ("trip_short_name", "string", False),
        ("direction_id", "int", False),
        ("block_id", "string", False),
        ("shape_id", "string", False),
        ("wheelchair_accessible", "int", False),
        ("bikes_allowed", "int", False),
        ("trip_route_type", "int", False),
        ("route_pattern_id", "string", False),
    ],
    "stop_times": [
        ("trip_id", "string", True),
        ("stop_sequence", "int", True),
        ("stop_id", "string", True),
        ("arrival_time", "string", False),
        ("departure_time", "string", False),
        ("stop_headsign", "string", False),
        ("pickup_type", "int", False),
        ("drop_off_type", "int", False),
        ("timepoint", "int", False),
        ("checkpoint_id", "string", False),
        ("continuous_pickup", "int", False),
        ("continuous_drop_off", "int", False),
    ],
    "calendar": [
        ("service_id", "string", True),
        ("monday", "int", True),
        ("tuesday", "int", True),
        ("wednesday", "int", True),
        ("thursday", "int", True),
        ("friday", "int", True),
        ("saturday", "int", True),
        ("sunday", "int", True),
        ("start_date", "date", True),
        ("end_date", "date", True),
    ],
    "calendar_dates": [
        ("service_id", "string", True),
        ("date", "date", True),
        ("exception_type", "int", True),
        ("holiday_name", "string", False),
    ],
}
# Tables a feed may leave empty.
MAY_BE_EMPTY = ("calendar", "calendar_dates")

FEED_STATE = (
    "feed_version string, sha256 string, feed_start_date date, feed_end_date date, "
    "source_url string, archive_path string, row_counts map<string, bigint>, loaded_at timestamp"
)

APPLICATION_EVENT = (
    "application_name string, kind string, query_id string, run_id string, "
    "recorded_at timestamp, progress string, error_message string"
)
BATCH_RUN = (
    "run_id string, status string, started_at timestamp, finished_at timestamp, "
    "duration_seconds double, error_message string"
)
WATERMARK_OFFSETS = "topic string, partition int, low bigint, high bigint"


def ddl(table: str) -> str:
    """DDL of one static schedule table."""
    return ", ".join(f"{name} {kind}" for name, kind, _ in STATIC_TABLES[table])
