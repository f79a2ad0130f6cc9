"""Messages derived from the driver's events, as JSON text.

Every event becomes one message of each kind. Its id picks a variant, so that
each boundary case occurs throughout the table; a variant is a text
replacement together with the verdict it must lead to.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from checks import oracle
from checks.projections import duckdb_text


@dataclass(frozen=True)
class Variant:
    """``old`` becomes ``new``; verdicts of the contract and of the quality check."""

    old: str = ""
    new: str = ""
    contract: bool = True
    quality: bool = True


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def json_text(template: str, values: dict[str, str]) -> str:
    """SQL that fills ``${name}`` of a JSON template."""
    pieces = re.split(r"\$\{(\w+)\}", " ".join(template.split()))
    parts = [
        literal(piece) if place % 2 == 0 else f"cast({values[piece]} as @str)"
        for place, piece in enumerate(pieces)
        if piece
    ]
    return f"concat({', '.join(parts)})"


def varied(base: str, kind: str, variants: list[Variant]) -> str:
    """SQL that applies the variant a row's kind names."""
    cases = " ".join(
        f"WHEN {number} THEN replace({base}, {literal(v.old)}, {literal(v.new)})"
        for number, v in enumerate(variants)
        if v.old
    )
    return f"CASE {kind} {cases} ELSE {base} END"


def numbers(variants: list[Variant], attribute: str) -> str:
    """Kinds whose verdict is true, as an SQL list."""
    return ", ".join(str(n) for n, v in enumerate(variants) if getattr(v, attribute))


_SECOND = "replace(cast(date_trunc('second', ts) as @str), ' ', 'T')"
_DAY = "cast(cast(ts as date) as @str)"
VALUES = {
    "id": "event_id",
    "iso": f"concat({_SECOND}, 'Z')",
    "user": "user_id",
    "route": "user_id % 27",
    "trip": "user_id % 40",
    "frac": "lpad(cast(event_id % 1000 as @str), 3, '0')",
    "bearing": "event_id * 7 % 361",
    "ymd": f"replace({_DAY}, '-', '')",
    "day": _DAY,
    "delay": "event_id % 400",
    "stop": "event_id % 100",
    "epoch": "@epoch",
    "direction": "user_id % 2",
    "backslash": "chr(92)",
}

_HEADER = """
"schema_version": 1, "source": "mbta_gtfs_realtime", "source_timestamp": "${iso}",
"feed_timestamp": "${iso}", "ingested_at": "${iso}", "published_at": "${iso}"
"""

VEHICLE_JSON = f"""
{{"event_id": "p${{id}}", "event_type": "vehicle_position", {_HEADER},
"route_id": "${{route}}", "trip_id": "${{trip}}", "vehicle_id": "v${{user}}",
"payload": {{"latitude": 42.${{frac}}, "longitude": -71.${{frac}}, "bearing": ${{bearing}},
"odometer": null, "speed_mps": 7.5, "direction_id": ${{direction}}, "current_stop_sequence": 3,
"stop_id": null, "current_status": "STOPPED_AT", "vehicle_label": "L${{user}}",
"occupancy_status": "FULL"}}}}
"""
VEHICLE_VARIANTS = [
    Variant(),
    Variant('"speed_mps": 7.5', '"speed_mps": null'),
    Variant('"speed_mps": 7.5', '"speed_mps": 0'),
    Variant('"latitude": 42', '"latitude": 999', False, False),
    Variant('"speed_mps": 7.5', '"speed_mps": -0.1', False, False),
    Variant('"bearing": ', '"bearing": 1000', False, False),
    Variant('"odometer": null', '"odometer": -1', False, False),
    Variant('"odometer": null', '"odometer": 0'),
    Variant('"vehicle_id": "v', '"vehicle_id": "", "stop": "v', False, False),
    Variant('"payload": {', '"content": {', False, False),
    Variant('"route_id"', '"line": 1, "route_id"', False, True),
    Variant('"schema_version": 1', '"schema_version": 2', False, False),
    Variant('"source": "mbta_gtfs_realtime"', '"source": "other"', False, False),
    Variant('{"event_id"', '{event_id', False, False),
    Variant('"latitude": 42', '"latitude": "n", "lat": 42', False, False),
    Variant('"direction_id": ', '"direction_id": 7', False, True),
    Variant('"route_id": "', '"route_id": 12, "line": "', False, True),
    Variant('"ingested_at": "', '"ingested_at": "x', False, False),
    Variant('"current_stop_sequence": 3', '"current_stop_sequence": 3.5', False, True),
    Variant('"event_type": "vehicle_position"', '"event_type": "other"', False, False),
    Variant('"event_id": "p', '"event_id": " ", "e": "p', False, False),
]

TRIP_JSON = f"""
{{"event_id": "t${{id}}", "event_type": "trip_update", {_HEADER},
"route_id": "${{route}}", "trip_id": "${{trip}}", "start_date": "${{ymd}}",
"start_time": "25:10:00", "vehicle_id": null,
"payload": {{"direction_id": ${{direction}}, "schedule_relationship": "SCHEDULED",
"trip_delay_seconds": ${{delay}}, "stop_time_updates": [
{{"stop_id": "${{stop}}", "stop_sequence": 1, "predicted_arrival": "${{iso}}",
"predicted_departure": null, "delay_seconds": 120, "schedule_relationship": null}},
{{"stop_id": null, "stop_sequence": 2, "predicted_arrival": null,
"predicted_departure": "${{iso}}", "delay_seconds": 180, "schedule_relationship": "SKIPPED"}}]}}}}
"""
TRIP_VARIANTS = [
    Variant(),
    Variant('"stop_time_updates": [', '"stop_time_updates": [], "x": [', False, True),
    Variant('"direction_id": ', '"direction_id": null, "d": ', False, True),
    Variant('"direction_id": ', '"direction_id": 2', False, False),
    Variant('"stop_sequence": 2', '"stop_sequence": null', False, False),
    Variant('"stop_sequence": 2', '"stop_sequence": -1', False, False),
    Variant(
        '"stop_id": null, "stop_sequence": 2',
        '"stop_id": "  ", "stop_sequence": null',
        True,
        False,
    ),
    Variant('"start_date": "', '"start_date": "20261399", "s": "', False, True),
    Variant('"start_time": "25:10:00"', '"start_time": null'),
    Variant('"start_time": "25:10:00"', '"start_time": "25:10:00", "n": 1', False, True),
    Variant('"stop_time_updates": [', '"stop_time_updates": [null, ', False, False),
    Variant('"trip_id": "', '"trip_id": "", "t": "', False, False),
    Variant('"trip_delay_seconds"', '"delay"', False, True),
    Variant('{"event_id"', '{event_id', False, False),
    Variant('"delay_seconds": 120', '"delay_seconds": 0'),
]

ALERT_JSON = f"""
{{"event_id": "a${{id}}", "event_type": "service_alert", {_HEADER}, "alert_id": "al${{user}}",
"payload": {{"cause": "MAINTENANCE", "effect": "DETOUR", "severity": "WARNING",
"header_text": "Header ${{user}}", "description_text": null,
"url": "https://example.org/${{user}}",
"active_periods": [{{"start": "${{day}}T06:00:00Z", "end": "${{day}}T18:00:00Z"}}],
"informed_entities": [
{{"agency_id": "1", "route_id": "${{route}}", "route_type": 3, "trip_id": null,
"stop_id": null, "direction_id": 0}},
{{"agency_id": null, "route_id": null, "route_type": null, "trip_id": "${{trip}}",
"stop_id": "${{stop}}", "direction_id": ${{direction}}}}]}}}}
"""
_PERIODS = '"active_periods": ['
_ENTITIES = '"informed_entities": ['
ALERT_VARIANTS = [
    Variant(),
    Variant('T18:00:00Z"}]', 'T18:00:00Z"}, {"start": null, "end": null}]'),
    Variant('T06:00:00Z"', 'T18:00:00Z"'),
    Variant('T06:00:00Z"', 'T20:00:00Z"', True, False),
    Variant(_PERIODS, '"active_periods": [], "x": [', False, True),
    Variant(_PERIODS, '"active_periods": [null, ', False, False),
    Variant(_PERIODS, '"active_periods": null, "x": [', False, False),
    Variant('T06:00:00Z"', 'T06:00:00Zbad"', False, False),
    Variant(_ENTITIES, '"informed_entities": [], "x": [', False, False),
    Variant(_ENTITIES, '"informed_entities": [null, ', False, False),
    Variant('"direction_id": 0', '"direction_id": 2', False, False),
    Variant('"route_type": 3', '"route_type": -1', False, False),
    Variant('"cause": "MAINTENANCE"', '"cause": "ALIENS"', False, True),
    Variant('"cause": "MAINTENANCE"', '"cause": null'),
    Variant('"url": "https', '"url": "no uri https', False, True),
    Variant('{"event_id"', '{event_id', False, False),
    Variant('"severity": "WARNING"', '"severity": null'),
]


def _messages(template: str, variants: list[Variant], topic: str, key: str) -> str:
    body = json_text(template, VALUES)
    return f"""
    SELECT {key} AS key, {varied("base", "kind", variants)} AS value, '{topic}' AS topic,
        cast(event_id % 3 as int) AS partition, cast(floor(event_id / 3) as bigint) AS @offset,
        cast(ts as timestamp) AS timestamp, kind
    FROM (SELECT event_id, user_id, ts, cast(event_id % {len(variants)} as int) AS kind,
        {body} AS base FROM @events) q
    """


VEHICLE_TOPIC = "transit.vehicle_positions.v1"
TRIP_TOPIC = "transit.trip_updates.v1"
ALERT_TOPIC = "transit.service_alerts.v1"

VEHICLE_MESSAGES = _messages(
    VEHICLE_JSON, VEHICLE_VARIANTS, VEHICLE_TOPIC, "concat('v', cast(user_id as @str))"
)
TRIP_MESSAGES = _messages(TRIP_JSON, TRIP_VARIANTS, TRIP_TOPIC, "cast(user_id % 40 as @str)")
ALERT_MESSAGES = _messages(
    ALERT_JSON, ALERT_VARIANTS, ALERT_TOPIC, "concat('al', cast(user_id as @str))"
)

# Feed entities: every third event each is a vehicle, a trip update, an alert.
FEED_VEHICLE = """
{"id": "e${id}", "is_deleted": false, "vehicle": {"trip": {"trip_id": "${trip}",
"route_id": "${route}", "direction_id": ${direction}}, "vehicle": {"id": "V${user}", "label": ""},
"position": {"latitude": 42.${frac}, "longitude": -71.${frac}, "bearing": 90.5},
"current_stop_sequence": 4, "stop_id": "", "current_status": "STOPPED_AT",
"timestamp": ${epoch}, "occupancy_status": "FULL"}}
"""
FEED_VEHICLE_VARIANTS = [
    Variant(),
    Variant('"is_deleted": false', '"is_deleted": true'),
    Variant('"position": {', '"place": {'),
    Variant('"timestamp": ', '"time": '),
    Variant('"vehicle": {"id": "V', '"vehicle": {"id": "", "name": "V'),
    Variant('"vehicle": {"trip"', '"other": {"trip"'),
]
FEED_TRIP = """
{"id": "e${id}", "is_deleted": false, "trip_update": {"trip": {"trip_id": "${trip}",
"route_id": "", "start_date": "${ymd}", "start_time": "25:10:00", "direction_id": ${direction},
"schedule_relationship": "SCHEDULED"}, "vehicle": {"id": "V${user}"}, "timestamp": ${epoch},
"delay": 0, "stop_time_update": [
{"stop_sequence": 1, "stop_id": "${stop}", "arrival": {"time": ${epoch}, "delay": 120},
"departure": {"time": ${epoch}, "delay": 130}},
{"stop_sequence": 2, "stop_id": "", "departure": {"time": ${epoch}, "delay": 180},
"schedule_relationship": "SKIPPED"}]}}
"""
FEED_TRIP_VARIANTS = [
    Variant(),
    Variant('"is_deleted": false', '"is_deleted": true'),
    Variant('"trip_id": "', '"trip_id": "", "name": "'),
    Variant('"timestamp": ', '"time": '),
    Variant('"delay": 1', '"late": 1'),
    Variant('"stop_time_update": [', '"other": ['),
]
FEED_ALERT = """
{"id": "e${id}", "is_deleted": false, "alert": {"active_period": [{"start": ${epoch},
"end": ${epoch}}], "informed_entity": [{"agency_id": "1", "route_id": "${route}", "route_type": 3,
"trip": {"route_id": "x", "direction_id": 1}, "direction_id": 0}, {"agency_id": "",
"trip": {"trip_id": "${trip}", "route_id": "T${route}", "direction_id": 1}, "stop_id": "${stop}"}],
"cause": "STRIKE", "effect": "DETOUR", "severity_level": "INFO", "header_text": {"translation": [
{"text": "Bonjour ${user}", "language": "fr"}, {"text": "Hello ${user}", "language": "en"}]},
"url": {"translation": [{"text": "https://example.org", "language": "fr"}]}}}
"""
FEED_ALERT_VARIANTS = [
    Variant(),
    Variant('"is_deleted": false', '"is_deleted": true'),
    Variant('"informed_entity": [', '"other": ['),
    Variant('"language": "en"', '"language": "es"'),
    Variant('"translation": [', '"other": ['),
    Variant('"end": ', '"until": '),
]
_KINDS = 6


def _entity(template: str, variants: list[Variant]) -> str:
    body = json_text(template, VALUES)
    return varied(body, f"cast(floor(event_id / 3) as int) % {_KINDS}", variants)


FEED_ENTITIES = f"""
SELECT event_id, user_id, ts, cast(floor(event_id / 3) as int) % {_KINDS} AS kind,
    CASE event_id % 3 WHEN 0 THEN {_entity(FEED_VEHICLE, FEED_VEHICLE_VARIANTS)}
        WHEN 1 THEN {_entity(FEED_TRIP, FEED_TRIP_VARIANTS)}
        ELSE {_entity(FEED_ALERT, FEED_ALERT_VARIANTS)} END AS entity,
    CASE WHEN event_id % 50 = 0 THEN null ELSE @epoch - @epoch % 60 END AS feed_timestamp,
    cast(ts as timestamp) AS ingested_at
FROM @events
"""

# The log of three applications, one entry per event.
PROGRESS_JSON = """
{"id": "q${app}", "runId": "r${run}", "timestamp": "${iso}", "batchId": ${batch},
"numInputRows": ${delay}, "inputRowsPerSecond": 20.5, "processedRowsPerSecond": ${rate},
"durationMs": {"triggerExecution": 1750}, "stateOperators": [{"numRowsDroppedByWatermark": 2},
{"numRowsDroppedByWatermark": 1}], "sources": [{"endOffset": {"transit.a": {"0": 5, "1": 6}}},
{"endOffset": {"transit.a": {"0": ${id}, "1": ${batch}}, "transit.b": {"2": ${delay}}}}]}
"""
_FIRST_SOURCE = '{"endOffset": {"transit.a": {"0": 5, "1": 6'
PROGRESS_VARIANTS = [
    Variant(),
    Variant('"numInputRows"', '"rows"'),
    Variant('"durationMs"', '"duration"'),
    Variant(_FIRST_SOURCE, '{"endOffset": "broken", "o": {"transit.a": {"0": 5, "1": 6'),
    Variant(_FIRST_SOURCE, '{"endOffset": {"logOffset": 4}, "o": {"a": {"0": 5, "1": 6'),
]
PROGRESS_LOG = f"""
SELECT CASE event_id % 3 WHEN 0 THEN 'vehicle-state' WHEN 1 THEN 'trip-update'
        ELSE 'unknown-job' END AS application_name,
    CASE WHEN event_id % 7 = 0 THEN 'started' WHEN event_id % 7 = 5 THEN 'idle'
        WHEN event_id % 7 = 6 THEN 'terminated' ELSE 'progress' END AS kind,
    concat('q', cast(event_id % 3 as @str)) AS query_id,
    concat('r', cast(cast(floor(event_id / 1000) as int) as @str)) AS run_id,
    cast(ts as timestamp) AS recorded_at,
    CASE WHEN event_id % 7 IN (0, 5, 6) THEN null ELSE {varied(json_text(PROGRESS_JSON, {
        **VALUES,
        "app": "event_id % 3",
        "run": "cast(floor(event_id / 1000) as int)",
        "batch": "cast(floor(event_id / 14) as int)",
        "rate": "event_id % 50 + 0.25e0",
    }), f"event_id % {len(PROGRESS_VARIANTS)}", PROGRESS_VARIANTS)} END AS progress,
    CASE WHEN event_id % 14 = 6 THEN 'lost executor' END AS error_message
FROM @events
"""

BATCH_RUNS = """
SELECT concat('run', cast(event_id as @str)) AS run_id,
    CASE event_id % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'success' ELSE 'failed' END AS status,
    cast(ts as timestamp) AS started_at,
    CASE WHEN event_id % 3 > 0 THEN cast(ts as timestamp) + interval '90' second END AS finished_at,
    CASE WHEN event_id % 3 > 0 THEN 90.0e0 END AS duration_seconds,
    CASE WHEN event_id % 3 = 2 THEN 'failed test' END AS error_message
FROM @events
"""

WATERMARKS = """
SELECT CASE event_id % 3 WHEN 0 THEN 'transit.a' WHEN 1 THEN 'transit.b' ELSE 'transit.dead' END
        AS topic, cast(event_id % 4 as int) AS partition, min(event_id) AS low,
    cast(floor(max(event_id) / 3) as bigint) + 100 AS high
FROM @events GROUP BY 1, 2
"""


def _stated(name: str, text: str) -> None:
    oracle.add_part(f"fx_{name}", duckdb_text(text))


for _name, _text in (
    ("vehicle_messages", VEHICLE_MESSAGES),
    ("trip_messages", TRIP_MESSAGES),
    ("alert_messages", ALERT_MESSAGES),
    ("feed_entities", FEED_ENTITIES),
    ("progress_log", PROGRESS_LOG),
    ("batch_runs", BATCH_RUNS),
    ("watermarks", WATERMARKS),
):
    _stated(_name, _text)
