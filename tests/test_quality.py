import pytest

from stopwise.operators import flatten, quality
from stopwise.streaming import jobs
from tests.events import envelope, event

VEHICLE = [
    ("payload.speed_mps", None, True),
    ("payload.speed_mps", 0.0, True),
    ("payload.speed_mps", -0.1, False),
    ("payload.odometer", None, True),
    ("payload.odometer", 0.0, True),
    ("payload.odometer", -1.0, False),
    ("payload.bearing", None, True),
    ("payload.bearing", 0.0, True),
    ("payload.bearing", 360.0, True),
    ("payload.bearing", -1.0, False),
    ("payload.bearing", 361.0, False),
    ("payload.latitude", 999.0, False),
    ("payload.latitude", None, False),
    ("payload.longitude", -180.5, False),
    ("vehicle_id", "   ", False),
    ("event_id", None, False),
    ("schema_version", 2, False),
    ("source", "elsewhere", False),
    ("published_at", None, False),
    ("payload", None, False),
]
TRIP = [
    ("payload.stop_time_updates", [], True),
    ("payload.direction_id", None, True),
    ("payload.direction_id", 2, False),
    ("payload.stop_time_updates.0.stop_id", None, True),
    ("payload.stop_time_updates.0.stop_sequence", None, True),
    ("payload.stop_time_updates.0.stop_sequence", -1, False),
    ("payload.stop_time_updates", [None], False),
    ("payload.stop_time_updates", None, False),
    ("payload.stop_time_updates.0.predicted_arrival", "not a time", True),
    ("trip_id", " ", False),
]
# A period may end when it starts, not before.
_END = event("alert")["payload"]["active_periods"][0]["end"]
ALERT = [
    ("payload.informed_entities", [None], False),
    ("payload.informed_entities", [], False),
    ("payload.informed_entities", None, False),
    ("payload.informed_entities.0.direction_id", 2, False),
    ("payload.informed_entities.0.route_type", -1, False),
    ("payload.active_periods", [None], False),
    ("payload.active_periods", None, False),
    ("payload.active_periods", [{"start": "bad", "end": None}], False),
    ("payload.active_periods", [{"start": None, "end": "bad"}], False),
    ("payload.active_periods", [], True),
    ("payload.active_periods", [{"start": None, "end": None}], True),
    ("payload.active_periods.0.end", None, True),
    ("payload.active_periods.0.start", None, True),
    ("payload.active_periods.0.start", _END, True),
    ("payload.active_periods.0.start", _END.replace(":00Z", ":01Z"), False),
    ("alert_id", "", False),
]
JOBS = {"vehicle": "vehicle-state", "trip": "trip-update", "alert": "service-alert"}


@pytest.mark.parametrize(
    ("kind", "cases"), [("vehicle", VEHICLE), ("trip", TRIP), ("alert", ALERT)]
)
def test_boundaries(spark, kind, cases):
    job = jobs.JOBS[JOBS[kind]]
    events = [event(kind, path, value) for path, value, _ in cases]
    raw = envelope(spark, [event(kind), *events, "{not json"])
    flagged = quality.with_flag(job.parse(raw), job.is_valid()).collect()
    verdicts = {row.kafka_offset: row[quality.FLAG] for row in flagged}
    wanted = [True, *[valid for _, _, valid in cases], False]
    assert [verdicts[place] for place in range(len(wanted))] == wanted


def test_a_stop_needs_an_id_or_a_sequence(spark):
    job = jobs.JOBS["trip-update"]
    stop = {"stop_id": " ", "stop_sequence": None}
    raw = envelope(spark, [event("trip", "payload.stop_time_updates", [stop])])
    valid, invalid = jobs.checked_events(raw, job)
    assert valid.count() == 0
    assert invalid.count() == 1


@pytest.mark.parametrize("kind", ["vehicle", "trip", "alert"])
def test_split_keeps_every_event_once_with_its_text(spark, kind):
    job = jobs.JOBS[JOBS[kind]]
    raw = envelope(spark, [event(kind), event(kind, event_id=" "), "junk"])
    valid, invalid = jobs.checked_events(raw, job)
    assert quality.FLAG not in valid.columns
    assert [row.kafka_offset for row in valid.collect()] == [0]
    rejected = {row.kafka_offset: row.raw_value for row in invalid.collect()}
    assert rejected.keys() == {1, 2}
    assert rejected[2] == "junk"


def test_rejected_alerts_stay_rejected_when_few_columns_are_read(spark):
    job = jobs.JOBS["service-alert"]
    bad = event("alert", "payload.active_periods.0.start", "bad")
    valid, _ = jobs.checked_events(envelope(spark, [event("alert", event_id="ok"), bad]), job)
    rows = flatten.alert_entity_rows(valid).select("event_id").distinct().collect()
    assert [row.event_id for row in rows] == ["ok"]


def test_json_is_parsed_once(spark):
    job = jobs.JOBS["vehicle-state"]
    rows = jobs.table_rows(envelope(spark, [event("vehicle")]), job)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_flattened_stops(spark):
    job = jobs.JOBS["trip-update"]
    raw = envelope(spark, [event("trip"), event("trip", "start_date", "20261399", event_id="x")])
    rows = job.flatten(job.parse(raw)).orderBy("kafka_offset", "stop_update_index").collect()
    assert [(r.stop_update_index, r.stop_id, r.delay_seconds) for r in rows[:2]] == [
        (0, "quay", -15),
        (1, "market", 240),
    ]
    assert rows[0].start_date.isoformat() == "2026-03-07"
    assert rows[0].start_time == "24:40:30"
    assert rows[2].start_date is None


def test_flattened_alert_and_its_periods(spark):
    job = jobs.JOBS["service-alert"]
    raw = envelope(
        spark,
        [event("alert"), event("alert", "payload.active_periods", [], event_id="none")],
    )
    rows = job.flatten(job.parse(raw))
    found = rows.where("event_id <> 'none'").orderBy("informed_entity_index").collect()
    assert [(r.informed_entity_index, r.stop_id, r.direction_id) for r in found] == [
        (0, None, 0),
        (1, "quay", 1),
    ]
    periods = flatten.alert_period_rows(rows).collect()
    numbers = sorted((r.event_id, r.active_period_index or 0) for r in periods)
    assert numbers == [
        ("alert-5:1772884805", 1),
        ("alert-5:1772884805", 1),
        ("none", 0),
        ("none", 0),
    ]


def test_flattened_vehicle(spark):
    job = jobs.JOBS["vehicle-state"]
    row = job.flatten(job.parse(envelope(spark, [event("vehicle")]))).first()
    assert (row.vehicle_id, row.latitude, row.kafka_offset) == ("bus-7", 42.25, 0)
    assert "payload" not in row.asDict()
    assert "stop_id" not in row.asDict()
