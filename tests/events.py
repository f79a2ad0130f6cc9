"""Valid example events and their envelope."""

import copy
import json
from datetime import datetime

from stopwise import schemas

_HEADER = {
    "schema_version": 1,
    "source": "mbta_gtfs_realtime",
    "source_timestamp": "2026-03-07T12:00:00+00:00",
    "feed_timestamp": "2026-03-07T12:00:05+00:00",
    "ingested_at": "2026-03-07T12:00:06+00:00",
    "published_at": "2026-03-07T12:00:07+00:00",
}

_VEHICLE = {
    **_HEADER,
    "event_id": "bus-7:1772884800",
    "event_type": "vehicle_position",
    "route_id": "39",
    "trip_id": "trip-39",
    "vehicle_id": "bus-7",
    "payload": {
        "latitude": 42.25,
        "longitude": -71.125,
        "bearing": 180.0,
        "odometer": None,
        "speed_mps": None,
        "direction_id": 1,
        "current_stop_sequence": 4,
        "stop_id": "0064",
        "current_status": "STOPPED_AT",
        "vehicle_label": "7",
        "occupancy_status": "FULL",
    },
}


def _stop(stop_id, sequence, delay):
    return {
        "stop_id": stop_id,
        "stop_sequence": sequence,
        "predicted_arrival": "2026-03-07T12:05:00+00:00",
        "predicted_departure": None,
        "delay_seconds": delay,
        "schedule_relationship": None,
    }


_TRIP = {
    **_HEADER,
    "event_id": "trip-39:1772884800",
    "event_type": "trip_update",
    "route_id": "39",
    "trip_id": "trip-39",
    "start_date": "20260307",
    "start_time": "24:40:30",
    "vehicle_id": "bus-7",
    "payload": {
        "direction_id": 0,
        "schedule_relationship": "SCHEDULED",
        "trip_delay_seconds": 45,
        "stop_time_updates": [_stop("quay", 3, -15), _stop("market", 7, 240)],
    },
}


def _entity(**values):
    names = ("agency_id", "route_id", "route_type", "trip_id", "stop_id", "direction_id")
    return {name: values.get(name) for name in names}


_ALERT = {
    **_HEADER,
    "event_id": "alert-5:1772884805",
    "event_type": "service_alert",
    "alert_id": "alert-5",
    "payload": {
        "cause": "WEATHER",
        "effect": "REDUCED_SERVICE",
        "severity": "SEVERE",
        "header_text": "Fewer boats in the storm",
        "description_text": None,
        "url": None,
        "active_periods": [{"start": "2026-03-07T06:00:00Z", "end": "2026-03-08T06:00:00Z"}],
        "informed_entities": [
            _entity(route_id="39", route_type=3, direction_id=0),
            _entity(stop_id="quay", direction_id=1),
        ],
    },
}

EXAMPLES = {"vehicle": _VEHICLE, "trip": _TRIP, "alert": _ALERT}


def event(kind, path=None, value=None, **top):
    """An example with one value replaced (dotted path) and top-level changes."""
    result = copy.deepcopy(EXAMPLES[kind])
    result.update(top)
    if path is not None:
        *parents, last = path.split(".")
        place = result
        for name in parents:
            place = place[int(name)] if name.isdigit() else place[name]
        place[int(last) if last.isdigit() else last] = value
    return result


def without(kind, path):
    result = copy.deepcopy(EXAMPLES[kind])
    *parents, last = path.split(".")
    place = result
    for name in parents:
        place = place[int(name)] if name.isdigit() else place[name]
    del place[last]
    return result


def envelope(spark, events, topic="topic"):
    """Envelope rows of events (dicts, or raw texts); the offset is the position."""
    rows = [
        (
            f"key-{place}",
            item if isinstance(item, str) else json.dumps(item),
            topic,
            0,
            place,
            datetime(2026, 8, 14, 12, 0, 8),
        )
        for place, item in enumerate(events)
    ]
    return spark.createDataFrame(rows, schemas.ENVELOPE_TEXT)
