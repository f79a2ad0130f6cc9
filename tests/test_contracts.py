import json

import pytest
from pyspark.sql import functions as F

from checks import streams
from checks.projections import Staged
from stopwise.operators import contracts, dead_letters, normalize
from tests.events import envelope, event, without

CASES = {
    "vehicle": [
        (event("vehicle"), None),
        (event("vehicle", "payload.latitude", 90), None),
        (event("vehicle", "payload.latitude", 90.5), "payload.latitude: above maximum"),
        (event("vehicle", "payload.latitude", "42"), "payload.latitude: wrong type"),
        (event("vehicle", "payload.latitude", True), "payload.latitude: wrong type"),
        (event("vehicle", "payload.direction_id", 1.0), None),
        (event("vehicle", "payload.direction_id", 2), "payload.direction_id: above maximum"),
        (event("vehicle", "payload.extra", 1), "payload.extra: unknown field"),
        (event("vehicle", "extra", 1), "extra: unknown field"),
        (event("vehicle", "vehicle_id", ""), "vehicle_id: too short"),
        (event("vehicle", "vehicle_id", "  "), None),
        (event("vehicle", "payload", []), "payload: wrong type"),
        (event("vehicle", "source_timestamp", "2026-08-14 12:00:00Z"), "source_timestamp: malformed"),
        (event("vehicle", "source_timestamp", "2026-08-14T12:00:00"), "source_timestamp: malformed"),
        (event("vehicle", "source_timestamp", "2026-02-30T12:00:00Z"), "source_timestamp: malformed"),
        (event("vehicle", "source_timestamp", "2026-08-14T12:00:00.25-04:00"), None),
        (without("vehicle", "route_id"), None),
        (without("vehicle", "vehicle_id"), "vehicle_id: missing"),
        (without("vehicle", "payload.longitude"), "payload.longitude: missing"),
        (without("vehicle", "payload"), "payload: missing"),
    ],
    "trip": [
        (event("trip"), None),
        (event("trip", "start_date", "2026-08-14"), "start_date: malformed"),
        (event("trip", "start_date", "20261399"), None),
        (event("trip", "start_time", "5:10:00"), "start_time: malformed"),
        (event("trip", "start_time", None), None),
        (event("trip", "payload.stop_time_updates", []), None),
        (event("trip", "payload.stop_time_updates", None), "payload.stop_time_updates: wrong type"),
        (
            event("trip", "payload.stop_time_updates.0", None),
            "payload.stop_time_updates[]: wrong type",
        ),
        (
            without("trip", "payload.stop_time_updates.1.delay_seconds"),
            "payload.stop_time_updates[].delay_seconds: missing",
        ),
        (
            event("trip", "payload.stop_time_updates.0.stop_sequence", -1),
            "payload.stop_time_updates[].stop_sequence: below minimum",
        ),
        (event("trip", "payload.stop_time_updates.0.stop_id", None), None),
        (event("trip", "payload.stop_time_updates.0.stop_sequence", None), None),
        (without("trip", "payload.direction_id"), "payload.direction_id: missing"),
    ],
    "alert": [
        (event("alert"), None),
        (event("alert", "payload.cause", "ALIENS"), "payload.cause: not an allowed value"),
        (event("alert", "payload.cause", None), None),
        (event("alert", "payload.url", "https://example.org/a?b=1"), None),
        (event("alert", "payload.url", "not a uri"), "payload.url: malformed"),
        (event("alert", "payload.informed_entities", []), "payload.informed_entities: too few items"),
        (
            event("alert", "payload.active_periods.0.start", "bad"),
            "payload.active_periods[].start: malformed",
        ),
        (
            event("alert", "payload.informed_entities.0.route_type", -1),
            "payload.informed_entities[].route_type: below minimum",
        ),
        (event("alert", "payload.tts_header_text", "spoken"), None),
    ],
}


@pytest.mark.parametrize("kind", sorted(CASES))
def test_contract(spark, kind):
    messages = envelope(spark, [item for item, _ in CASES[kind]])
    rows = contracts.with_violations(messages).orderBy("offset").collect()
    label = {"vehicle": "vehicle_position", "trip": "trip_update", "alert": "service_alert"}[kind]
    for row, (_, reason) in zip(rows, CASES[kind], strict=True):
        found = row[contracts.VIOLATIONS]
        if reason is None:
            assert found == [], row.value
        else:
            assert f"{label} v1 at {reason}" in found, row.value


ODD = [
    None, True, 0, 1, 2, -1, 1.0, 0.5, 1e300, 10**20, "", " ", "x", "1", "true", "20260807", 20260807,
    "25:10:00", "https://e.org", "2026-08-14T12:00:00Z", "2026-02-30T12:00:00Z", "WEATHER", [], [None],
    [{}], [1, "a"], {}, {"a": None},
]


def _paths(value, path=""):
    """Dotted paths of all values inside a document."""
    inside = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for name, item in inside:
        yield f"{path}{name}"
        yield from _paths(item, f"{path}{name}.")


def _odd_messages(kind):
    """An example with each value replaced by each odd one, left out, or with a field beside it."""
    for path in _paths(event(kind)):
        yield from (event(kind, path, odd) for odd in ODD)
        if not path[-1].isdigit():
            yield without(kind, path)
            yield event(kind, f"{path}_odd", 1)


@pytest.mark.parametrize("given", [False, True])
@pytest.mark.parametrize("kind", sorted(CASES))
def test_the_verdict_is_that_there_are_no_violations(spark, kind, given):
    texts = ["[1]", "{", "null", '{"event_type": "trip_update", "event_type": "trip_update"}']
    items = [item for item, _ in CASES[kind]] + list(_odd_messages(kind)) + texts
    contract = {"vehicle": contracts.VEHICLE, "trip": contracts.TRIP, "alert": contracts.ALERT}[kind]
    messages = envelope(spark, items).repartition(8, "offset").persist()
    asked = [messages, contract] if given else [messages]
    violations = contracts.with_violations(*asked).select("offset", F.size(contracts.VIOLATIONS) == 0)
    verdicts = contracts.with_verdict(*asked).select("offset", contracts.MEETS)
    expected, found = dict(violations.collect()), dict(verdicts.collect())
    assert {True, False} == set(expected.values())
    assert [items[place] for place in expected if expected[place] != found[place]] == []


def test_texts_of_violations_are_not_made_where_nothing_reads_them(spark):
    _, rejected = dead_letters.route(envelope(spark, [event("trip"), event("trip", "extra", 1)]))
    letters = dead_letters.dead_letters(rejected, "2026-08-14 12:00:00")
    with_texts, without_texts = (
        frame._jdf.queryExecution().optimizedPlan().toString()
        for frame in (letters, letters.drop("error_message"))
    )
    assert "unknown field" in with_texts and "unknown field" not in without_texts


def test_a_stop_needs_one_reference(spark):
    stop = {**event("trip")["payload"]["stop_time_updates"][0], "stop_id": None, "stop_sequence": None}
    messages = envelope(spark, [event("trip", "payload.stop_time_updates", [stop])])
    found = contracts.with_violations(messages).first()[contracts.VIOLATIONS]
    assert found == [
        "trip_update v1 at payload.stop_time_updates[]: one of its fields is needed"
    ]


def test_messages_are_dealt_to_all_cores(spark):
    """The events of the smallest tables are one row group, which one task would read."""
    messages = streams.messages(Staged(spark, "/root/testdata/sf0.001"), "trip")
    assert messages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_streamed_messages_are_dealt_to_all_cores(spark):
    streamed = streams._stream(Staged(spark, "/root/testdata/sf0.001"), "trip")
    plan = streamed._jdf.queryExecution().analyzed().toString()
    parts = streams.PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    assert [x for x in plan.splitlines() if "RepartitionByExpression" in x and x.endswith(f", {parts}")]


def test_generators_hold_no_lambda(spark):
    """A generator with a lambda is interpreted as a whole, for each message and each contract."""
    checked = contracts.with_violations(envelope(spark, [event("trip")]), contracts.TRIP)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "Generate explode" in line]
    assert steps and not [step for step in steps if "lambda" in step]


def test_dispatch(spark):
    items = [
        event("vehicle", event_type=5),
        event("vehicle", schema_version="1"),
        event("vehicle", schema_version=True),
        event("vehicle", schema_version=9),
        event("vehicle", event_type="metro"),
        "[1, 2]",
        "{",
    ]
    rows = contracts.with_violations(envelope(spark, items)).orderBy("offset").collect()
    assert [row[contracts.VIOLATIONS][0] for row in rows] == [
        "event_type must be a string",
        "schema_version must be an integer",
        "schema_version must be an integer",
        "Unsupported event schema: vehicle_position v9",
        "Unsupported event schema: metro v1",
        "event_type must be a string",
        "event_type must be a string",
    ]


def test_dead_letters(spark):
    bad = event("vehicle", "payload.latitude", 91)
    messages = envelope(spark, [event("vehicle"), bad, "{", event("trip", event_id=3)], "stream")
    accepted, rejected = dead_letters.route(messages)
    assert [row.offset for row in accepted.collect()] == [0]
    letters = dead_letters.dead_letters(rejected, "2026-08-14 12:00:00")
    rows = {row.original_offset: row for row in letters.drop("raw_payload").collect()}
    assert rows[1].error_message == "vehicle_position v1 at payload.latitude: above maximum"
    assert rows[1].correlation_id == bad["event_id"]
    assert rows[1].original_schema_version == 1
    assert rows[3].correlation_id is None
    assert rows[2].original_schema_version is None
    again = dead_letters.dead_letters(rejected, "2027-01-01 00:00:00").collect()
    assert {row.event_id for row in again} == {row.event_id for row in rows.values()}
    texts = normalize.published_messages(letters, "dead", "event_id")
    checked = contracts.with_violations(texts).collect()
    assert [row[contracts.VIOLATIONS] for row in checked] == [[], [], []]
    raw = {json.loads(row.value)["original_offset"]: json.loads(row.value) for row in checked}
    assert raw[1]["raw_payload"]["payload"]["latitude"] == 91
    assert raw[2]["raw_payload"] == "{"


def test_publish_counts_both_branches(spark, tmp_path):
    messages = envelope(spark, [event("vehicle"), event("vehicle", "extra", 1), event("alert")])
    written = {}

    def keep(name):
        def write(rows):
            written[name] = rows.select(F.col("topic") if name == "ok" else "event_id").collect()

        return write

    assert dead_letters.publish(messages, keep("ok"), keep("dead")) == (2, 1)
    assert (len(written["ok"]), len(written["dead"])) == (2, 1)
