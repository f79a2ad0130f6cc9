import json
from datetime import UTC, datetime

from pyspark.sql import functions as F

from stopwise import schemas, settings
from stopwise.operators import contracts, normalize

AT = 1_700_000_000
NOW = "2026-08-11 03:00:00"


def feed(spark, *items, feed_timestamp=AT):
    rows = [(json.dumps(item), feed_timestamp, datetime(2026, 8, 11, 3)) for item in items]
    table = spark.createDataFrame(rows, "e string, feed_timestamp bigint, ingested_at timestamp")
    entity = F.from_json("e", schemas.FEED_ENTITY).alias("e")
    return table.select(entity, "feed_timestamp", "ingested_at").select(
        "e.*", "feed_timestamp", "ingested_at"
    )


def meets_contract(events):
    texts = normalize.published_messages(events, "t", "event_id")
    found = contracts.with_violations(texts).select(contracts.VIOLATIONS).collect()
    return all(row[0] == [] for row in found)


def test_trip_update_with_all_its_stops(spark):
    events = normalize.trip_events(
        feed(
            spark,
            {
                "id": "u1",
                "trip_update": {
                    "timestamp": AT + 10,
                    "delay": 90,
                    "trip": {
                        "trip_id": "trip-1",
                        "route_id": "1",
                        "start_date": "20260814",
                        "start_time": "25:10:00",
                        "direction_id": 0,
                        "schedule_relationship": "SCHEDULED",
                    },
                    "vehicle": {"id": "vehicle-1"},
                    "stop_time_update": [
                        {
                            "stop_id": "a",
                            "stop_sequence": 1,
                            "arrival": {"time": AT + 300, "delay": 120},
                            "departure": {"time": AT + 330, "delay": 5},
                        },
                        {
                            "stop_id": "b",
                            "stop_sequence": 2,
                            "arrival": {"time": AT + 600},
                            "departure": {"time": AT + 630, "delay": 0},
                        },
                        {"stop_id": "", "stop_sequence": 3},
                    ],
                },
            },
        ),
        NOW,
    )
    event = events.first()
    assert event.event_id == f"u1:{AT + 10}"
    stops = event.payload.stop_time_updates
    assert [stop.delay_seconds for stop in stops] == [120, 0, 90]
    assert stops[2].stop_id is None
    assert stops[0].predicted_arrival == datetime.fromtimestamp(AT + 300, UTC).replace(tzinfo=None)
    assert meets_contract(events)


def test_cancelled_trip_keeps_an_empty_list(spark):
    trip = {"trip_id": "t", "route_id": "66", "schedule_relationship": "CANCELED"}
    events = normalize.trip_events(feed(spark, {"id": "c", "trip_update": {"trip": trip}}), NOW)
    event = events.first()
    assert event.event_id == f"c:{AT}"
    assert event.payload.stop_time_updates == []
    assert event.start_date is None
    assert meets_contract(events)


def test_skipped_entities(spark):
    position = {"latitude": 1.0, "longitude": 2.0}
    entities = feed(
        spark,
        {"id": "gone", "is_deleted": True, "vehicle": {"position": position}},
        {"id": "nowhere", "vehicle": {}},
        {"id": "no-trip", "trip_update": {"trip": {"trip_id": ""}}},
        {"id": "no-target", "alert": {"informed_entity": []}},
        {"id": "fine", "vehicle": {"position": position, "vehicle": {"id": ""}}},
    )
    assert [row.vehicle_id for row in normalize.vehicle_events(entities).collect()] == ["fine"]
    assert normalize.trip_events(entities).count() == 0
    assert normalize.alert_events(entities).count() == 0
    assert meets_contract(normalize.vehicle_events(entities, NOW))


def test_alert_targets_and_texts(spark):
    texts = [{"text": "Bonjour", "language": "fr"}, {"text": "Hello", "language": "en"}]
    events = normalize.alert_events(
        feed(
            spark,
            {
                "id": "a1",
                "alert": {
                    "cause": "MAINTENANCE",
                    "effect": "DETOUR",
                    "header_text": {"translation": texts},
                    "description_text": {"translation": texts[:1]},
                    "active_period": [{"start": AT}],
                    "informed_entity": [
                        {"route_id": "Red", "direction_id": 0, "trip": {"direction_id": 1}},
                        {"trip": {"route_id": "Orange", "trip_id": "t", "direction_id": 1}},
                    ],
                },
            },
        ),
        NOW,
    )
    event = events.first()
    assert event.source_timestamp == event.feed_timestamp
    payload = event.payload
    assert (payload.header_text, payload.description_text, payload.url) == ("Hello", "Bonjour", None)
    assert [(t.route_id, t.direction_id) for t in payload.informed_entities] == [
        ("Red", 0),
        ("Orange", 1),
    ]
    assert payload.active_periods[0].end is None
    assert meets_contract(events)


def test_feed_without_time_is_quarantined(spark):
    entities = feed(
        spark, {"id": "x", "vehicle": {"position": {"latitude": 1.0}}}, feed_timestamp=None
    )
    assert normalize.vehicle_events(entities).count() == 0
    assert [row.id for row in normalize.unusable_feed(entities).collect()] == ["x"]


def test_routes_of_the_feeds():
    assert {name: (feed.topic, feed.key) for name, feed in normalize.FEEDS.items()} == {
        "vehicle_positions": (settings.VEHICLE_TOPIC, "vehicle_id"),
        "trip_updates": (settings.TRIP_TOPIC, "trip_id"),
        "alerts": (settings.ALERT_TOPIC, "alert_id"),
    }
