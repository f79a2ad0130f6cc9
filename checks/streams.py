"""Checks of normalising, contracts, quality, parsing, flattening and the streaming jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import messages as m
from checks import oracle
from checks.projections import AS_OF, Staged, driver_table, over, project
from checks.registry import check
from stopwise import schemas
from stopwise.functions import text, times
from stopwise.functions.plan import projected_once
from stopwise.operators import contracts, dead_letters, flatten, normalize, quality
from stopwise.session import shared_folder
from stopwise.sources.envelopes import read_envelopes, write_envelopes
from stopwise.streaming import events, jobs, sinks

TEXTS = {
    "vehicle": (m.VEHICLE_MESSAGES, m.VEHICLE_VARIANTS),
    "trip": (m.TRIP_MESSAGES, m.TRIP_VARIANTS),
    "alert": (m.ALERT_MESSAGES, m.ALERT_VARIANTS),
}
PARTS_PER_CORE = 3
JOBS = {"vehicle": "vehicle-state", "trip": "trip-update", "alert": "service-alert"}


def projected(t: Staged, sql: str) -> DataFrame:
    return project(t.spark, t.folder, sql)


def _dealt(events: DataFrame) -> DataFrame:
    parts = PARTS_PER_CORE * events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(parts, "event_id")


def messages(t: Staged, kind: str) -> DataFrame:
    """Messages in as many parts as a topic of the size would have.

    The events are a file of few row groups, often one, and a message takes long to check. Events are
    small, so they are dealt out before they become messages.
    """
    return over(TEXTS[kind][0], events=_dealt(driver_table(t.spark, t.folder, "events")))


def all_messages(t: Staged) -> DataFrame:
    return reduce(DataFrame.unionByName, [messages(t, kind) for kind in TEXTS])


# Documents of the messages, null where the text is no JSON.
for _kind in TEXTS:
    oracle.add_part(
        f"{_kind}_docs",
        f"""
        SELECT *, CASE WHEN json_valid(value) THEN value END AS doc FROM fx_{_kind}_messages
        """,
    )


def field(path: str, kind: str = "varchar") -> str:
    value = f"json_extract_string(doc, '$.{path}')"
    if kind == "varchar":
        return value
    if kind == "timestamp":
        return f"try_cast(replace({value}, 'Z', '') as timestamp)"
    return f"try_cast({value} as {kind})"


def good(kind: str, attribute: str) -> str:
    return f"kind IN ({m.numbers(TEXTS[kind][1], attribute)})"


_PLACE = (
    'topic AS kafka_topic, partition AS kafka_partition, "offset" AS kafka_offset, '
    "timestamp AS kafka_timestamp"
)
_TIMES = ("source_timestamp", "feed_timestamp", "ingested_at", "published_at")
_HEADER = ", ".join(
    [f"{field(c)} AS {c}" for c in ("event_id", "event_type", "source")]
    + [f"{field('schema_version', 'int')} AS schema_version"]
    + [f"{field(c, 'timestamp')} AS {c}" for c in _TIMES]
)

# Envelope and parsing ----------------------------------------------------


@check(
    "envelope_columns",
    "STR1",
    f"SELECT key AS kafka_key, value AS raw_value, {_PLACE} FROM fx_vehicle_messages",
)
def _(t):
    return events.envelope_columns(messages(t, "vehicle"))


@check(
    "envelope_files",
    "SRC2",
    "SELECT * EXCLUDE (kind) FROM fx_alert_messages",
)
def _(t):
    folder = f"{shared_folder(t.spark)}/envelopes/{t.run_name}"
    write_envelopes(messages(t, "alert"), folder)
    return read_envelopes(t.spark, folder)


_VEHICLE_FIELDS = """
latitude longitude bearing odometer speed_mps
""".split()
oracle.add_part(
    "vehicle_parsed",
    f"""
    SELECT kind, {_HEADER}, {field("route_id")} AS route_id, {field("trip_id")} AS trip_id,
        {field("vehicle_id")} AS vehicle_id,
        {", ".join(f"{field('payload.' + c, 'double')} AS {c}" for c in _VEHICLE_FIELDS)},
        {field("payload.direction_id", "int")} AS direction_id,
        {field("payload.occupancy_status")} AS occupancy_status, {_PLACE}
    FROM vehicle_docs
    """,
)
_PARSED = "event_id, event_type, source, schema_version, " + ", ".join(_TIMES)


@check(
    "parsed_vehicle_events",
    "STR2",
    f"""
    SELECT {_PARSED}, route_id, trip_id, vehicle_id, latitude, longitude, bearing, odometer,
        speed_mps, direction_id, occupancy_status, kafka_topic, kafka_partition, kafka_offset,
        kafka_timestamp FROM vehicle_parsed
    """,
)
def _(t):
    parsed = events.parse_vehicle_events(messages(t, "vehicle"))
    return parsed.select(
        *_PARSED.split(", "),
        *"route_id trip_id vehicle_id".split(),
        *[f"payload.{c}" for c in (*_VEHICLE_FIELDS, "direction_id", "occupancy_status")],
        *"kafka_topic kafka_partition kafka_offset kafka_timestamp".split(),
    )


@check(
    "parsed_trip_events",
    "STR2",
    f"""
    SELECT {_HEADER}, {field("trip_id")} AS trip_id, {field("start_date")} AS start_date,
        {field("start_time")} AS start_time,
        {field("payload.trip_delay_seconds", "int")} AS trip_delay_seconds,
        json_array_length(doc, '$.payload.stop_time_updates') AS stops, "offset" AS kafka_offset
    FROM trip_docs
    """,
)
def _(t):
    parsed = events.parse_trip_events(messages(t, "trip"))
    return parsed.select(
        *_PARSED.split(", "),
        *"trip_id start_date start_time payload.trip_delay_seconds".split(),
        F.size("payload.stop_time_updates").cast("bigint").alias("stops"),
        "kafka_offset",
    )


_BROKEN_ALERTS = [
    n for n, v in enumerate(m.ALERT_VARIANTS) if "Zbad" in v.new or v.new.startswith("{event_id")
]


@check(
    "parsed_alert_events",
    "STR3",
    f"""
    SELECT {_HEADER}, {field("alert_id")} AS alert_id, {field("payload.cause")} AS cause,
        kind IN ({", ".join(map(str, _BROKEN_ALERTS))}) AS is_corrupt, "offset" AS kafka_offset
    FROM alert_docs
    """,
)
def _(t):
    parsed = events.parse_alert_events(messages(t, "alert"))
    return parsed.select(
        *_PARSED.split(", "),
        "alert_id",
        "payload.cause",
        F.col(quality.CORRUPT).isNotNull().alias("is_corrupt"),
        "kafka_offset",
    )


# Quality -----------------------------------------------------------------


def _flags(kind: str, covers: str) -> None:
    @check(
        f"{kind}_quality",
        covers,
        f'SELECT partition, "offset", {good(kind, "quality")} AS is_valid FROM fx_{kind}_messages',
    )
    def _(t):
        job = jobs.JOBS[JOBS[kind]]
        flagged = quality.with_flag(job.parse(messages(t, kind)), job.is_valid())
        return flagged.select(
            F.col("kafka_partition").alias("partition"),
            F.col("kafka_offset").alias("offset"),
            F.col(quality.FLAG).alias("is_valid"),
        )

    @check(
        f"{kind}_rejects",
        "DQ9",
        f"""
        SELECT partition, "offset", value FROM fx_{kind}_messages WHERE NOT {good(kind, "quality")}
        """,
    )
    def _(t):
        _, invalid = jobs.checked_events(messages(t, kind), jobs.JOBS[JOBS[kind]])
        return invalid.select(
            F.col("kafka_partition").alias("partition"),
            F.col("kafka_offset").alias("offset"),
            F.col("raw_value").alias("value"),
        )


_flags("vehicle", "DQ6")
_flags("trip", "DQ7")
_flags("alert", "DQ8")


# Flattening --------------------------------------------------------------

oracle.add_part(
    "vehicle_rows",
    f"""
    SELECT event_id, vehicle_id, source_timestamp AS event_timestamp, feed_timestamp,
        published_at, ingested_at, route_id, trip_id, latitude, longitude, bearing, odometer,
        speed_mps, occupancy_status, source, schema_version, kafka_topic, kafka_partition,
        kafka_offset, kafka_timestamp
    FROM vehicle_parsed WHERE {good("vehicle", "quality")}
    """,
)


def _items(path: str, most: int) -> str:
    return f"""
    CROSS JOIN (SELECT cast(unnest(range({most})) as int) AS i) n
    WHERE n.i < json_array_length(doc, '$.{path}')
    """


def _item(path: str, name: str, kind: str = "varchar") -> str:
    value = f"json_extract_string(doc, concat('$.{path}[', n.i, '].{name}'))"
    if kind == "timestamp":
        return f"cast(replace({value}, 'Z', '') as timestamp)"
    return value if kind == "varchar" else f"cast({value} as {kind})"


_STOPS = "payload.stop_time_updates"
oracle.add_part(
    "stop_rows",
    f"""
    SELECT {field("event_id")} AS event_id, n.i AS stop_update_index,
        {field("source_timestamp", "timestamp")} AS event_timestamp,
        {field("feed_timestamp", "timestamp")} AS feed_timestamp,
        {field("ingested_at", "timestamp")} AS ingested_at,
        {field("published_at", "timestamp")} AS published_at, {field("trip_id")} AS trip_id,
        cast(try_strptime({field("start_date")}, '%Y%m%d') as date) AS start_date,
        {field("start_time")} AS start_time, {field("route_id")} AS route_id,
        {field("vehicle_id")} AS vehicle_id, {field("payload.direction_id", "int")} AS direction_id,
        {field("payload.schedule_relationship")} AS trip_schedule_relationship,
        {field("payload.trip_delay_seconds", "int")} AS trip_delay_seconds,
        {_item(_STOPS, "stop_id")} AS stop_id, {_item(_STOPS, "stop_sequence", "int")} AS stop_sequence,
        {_item(_STOPS, "predicted_arrival", "timestamp")} AS predicted_arrival,
        {_item(_STOPS, "predicted_departure", "timestamp")} AS predicted_departure,
        {_item(_STOPS, "delay_seconds", "int")} AS delay_seconds,
        {_item(_STOPS, "schedule_relationship")} AS stop_schedule_relationship,
        {field("source")} AS source, {field("schema_version", "int")} AS schema_version, {_PLACE}
    FROM (SELECT * FROM trip_docs WHERE {good("trip", "quality")}) d {_items(_STOPS, 3)}
    """,
)
_ENTITIES = "payload.informed_entities"
_ISO = "concat({value}, '.000Z')"


def _period(place: int) -> str:
    def end(name: str) -> str:
        value = f"json_extract_string(doc, '$.payload.active_periods[{place}].{name}')"
        return f"""CASE WHEN {value} IS NOT NULL THEN '"{name}":"' || replace({value}, 'Z', '.000Z') || '"' END"""

    return (
        f"CASE WHEN json_array_length(doc, '$.payload.active_periods') > {place} "
        f"THEN '{{' || concat_ws(',', {end('start')}, {end('end')}) || '}}' END"
    )


oracle.add_part(
    "alert_rows",
    f"""
    SELECT {field("event_id")} AS event_id, n.i AS informed_entity_index,
        {field("alert_id")} AS alert_id, {field("source_timestamp", "timestamp")} AS event_timestamp,
        {field("feed_timestamp", "timestamp")} AS feed_timestamp,
        {field("ingested_at", "timestamp")} AS ingested_at,
        {field("published_at", "timestamp")} AS published_at,
        {", ".join(f"{field('payload.' + c)} AS {c}" for c in
            "cause effect severity header_text description_text url".split())},
        '[' || concat_ws(',', {_period(0)}, {_period(1)}) || ']' AS active_periods,
        {_item(_ENTITIES, "agency_id")} AS agency_id, {_item(_ENTITIES, "route_id")} AS route_id,
        {_item(_ENTITIES, "route_type", "int")} AS route_type,
        {_item(_ENTITIES, "trip_id")} AS trip_id, {_item(_ENTITIES, "stop_id")} AS stop_id,
        {_item(_ENTITIES, "direction_id", "int")} AS direction_id, {field("source")} AS source,
        {field("schema_version", "int")} AS schema_version, {_PLACE}
    FROM (SELECT * FROM alert_docs WHERE {good("alert", "quality")}) d {_items(_ENTITIES, 3)}
    """,
)
ROWS = {"vehicle": "vehicle_rows", "trip": "stop_rows", "alert": "alert_rows"}
DATES = {"vehicle": (), "trip": ("start_date",), "alert": ()}


def _flattened(kind: str, covers: str) -> None:
    @check(f"{ROWS[kind]}_flattened", covers, f"SELECT * FROM {ROWS[kind]}", dates=DATES[kind])
    def _(t):
        job = jobs.JOBS[JOBS[kind]]
        valid, _ = jobs.checked_events(messages(t, kind), job)
        return job.flatten(valid)


_flattened("vehicle", "FLT1")
_flattened("trip", "FLT2")
_flattened("alert", "FLT3")


# Streaming jobs ----------------------------------------------------------


def _stream(t: Staged, kind: str) -> DataFrame:
    """The driver's events as a stream in which every message is sent twice."""
    raw = (
        t.spark.readStream.schema(
            "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
            "value double, props string"
        )
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.folder)
    )
    # Dealt out as in ``messages``: a batch of one file would be parsed by one task.
    return over(TEXTS[kind][0].replace("FROM @events", "FROM @events @repeat2"), events=_dealt(raw))


def _streamed(kind: str, covers: str) -> None:
    @check(f"streamed_{ROWS[kind]}", covers, f"SELECT * FROM {ROWS[kind]}", dates=DATES[kind])
    def _(t):
        job, folder = jobs.JOBS[JOBS[kind]], shared_folder(t.spark)
        base = f"{folder}/streams/{t.run_name}/{kind}"
        query = jobs.start(
            _stream(t, kind),
            job,
            target=f"{base}/{job.table}",
            checkpoint=f"{base}/checkpoint",
            trigger={"availableNow": True},
        )
        query.awaitTermination()
        return sinks.read_keyed(t.spark, f"{base}/{job.table}")


_streamed("vehicle", "SRC2 STR4 STR5 STR7 STR8 SNK1 SNK2")
_streamed("trip", "STR4 STR5 STR8 SNK1 SNK2")
_streamed("alert", "STR4 STR5 STR8 SNK1 SNK2")


@check(
    "deduplicated_events",
    "STR5",
    """
    SELECT event_id, vehicle_id, latitude FROM vehicle_rows
    """,
)
def _(t):
    raw = messages(t, "vehicle")
    valid, _ = jobs.checked_events(raw.unionByName(raw), jobs.JOBS["vehicle-state"])
    rows = flatten.vehicle_rows(events.deduplicated(valid))
    return rows.select("event_id", "vehicle_id", "latitude")


# Contracts and routing ---------------------------------------------------


def _contract(kind: str, covers: str, shape: contracts.Contract) -> None:
    @check(
        f"{kind}_contract",
        covers,
        f'SELECT partition, "offset", {good(kind, "contract")} AS is_valid FROM fx_{kind}_messages',
    )
    def _(t):
        checked = contracts.with_verdict(messages(t, kind), shape)
        return checked.select("partition", "offset", F.col(contracts.MEETS).alias("is_valid"))


_contract("vehicle", "DQ1", contracts.VEHICLE)
_contract("trip", "DQ2", contracts.TRIP)
_contract("alert", "DQ3", contracts.ALERT)

oracle.add_part(
    "all_docs",
    " UNION ALL ".join(
        f'SELECT key, value, topic, partition, "offset", doc, {good(kind, "contract")} AS ok '
        f"FROM {kind}_docs"
        for kind in TEXTS
    ),
)


@check(
    "dispatched_contracts",
    "DQ5",
    'SELECT topic, partition, "offset", ok AS is_valid FROM all_docs',
)
def _(t):
    checked = contracts.with_verdict(all_messages(t))
    return checked.select("topic", "partition", "offset", F.col(contracts.MEETS).alias("is_valid"))


@check(
    "unsupported_contracts",
    "DQ5",
    f"""
    SELECT topic, partition, "offset", CASE
        WHEN {field("event_type")} IS NULL THEN 'event_type must be a string'
        ELSE 'Unsupported event schema: ' || {field("event_type")} || ' v'
            || {field("schema_version")} END AS error_message
    FROM all_docs
    WHERE {field("event_type")} IS NULL OR {field("event_type")} = 'other'
        OR {field("schema_version")} <> '1'
    """,
)
def _(t):
    _, rejected = dead_letters.route(all_messages(t))
    message = F.get(F.col(contracts.VIOLATIONS), F.lit(0))
    told = projected_once(rejected, "error_message", message)
    return told.where(~F.contains("error_message", F.lit(" at "))).select(
        "topic", "partition", "offset", "error_message"
    )


@check(
    "dead_letters",
    "DQ10",
    f"""
    SELECT sha256(concat_ws('|', topic, partition, "offset")) AS event_id,
        'dead_letter' AS event_type, 1 AS schema_version,
        'schema_validation' AS failure_stage, 'EventValidationError' AS error_type,
        topic AS original_topic, partition AS original_partition, "offset" AS original_offset,
        key AS original_key, {field("schema_version", "int")} AS original_schema_version,
        {field("event_id")} AS correlation_id, {field("source")} AS raw_source
    FROM all_docs WHERE NOT ok
    """,
)
def _(t):
    _, rejected = dead_letters.route(all_messages(t))
    raw_source = F.try_variant_get("raw_payload", "$.source", "string").alias("raw_source")
    letters = dead_letters.dead_letters(rejected, AS_OF)
    return letters.select("*", raw_source).drop("failed_at", "error_message", "raw_payload")


@check(
    "dead_letters_meet_their_contract",
    "DQ4",
    "SELECT topic AS original_topic, count(*) AS valid_letters FROM all_docs WHERE NOT ok GROUP BY topic",
)
def _(t):
    _, rejected = dead_letters.route(all_messages(t))
    letters = dead_letters.dead_letters(rejected, AS_OF)
    texts = normalize.published_messages(letters, "dead", "event_id")
    checked = contracts.with_verdict(texts, contracts.DEAD_LETTER)
    topic = F.get_json_object("value", "$.original_topic").alias("original_topic")
    valid = checked.where(contracts.MEETS)
    return valid.groupBy(topic).agg(F.count("*").alias("valid_letters"))


@check(
    "routed_counts",
    "DQ11",
    """
    SELECT topic, count(*) FILTER (ok) AS published, count(*) FILTER (NOT ok) AS rejected
    FROM all_docs GROUP BY topic
    """,
)
def _(t):
    return dead_letters.route_counts(all_messages(t))


# Normalising -------------------------------------------------------------


def entities(t: Staged) -> DataFrame:
    feed = projected(t, m.FEED_ENTITIES)
    entity = F.from_json("entity", schemas.FEED_ENTITY)
    return feed.select(entity.alias("e"), "feed_timestamp", "ingested_at").select(
        "e.*", "feed_timestamp", "ingested_at"
    )


_SOURCE_SECOND = (
    "CASE WHEN kind = 3 THEN feed_timestamp ELSE epoch_us(ts) // 1000000 END"
)


def _event_header(event_type: str, second: str) -> str:
    return f"""
    concat('e', event_id, ':', {second}) AS event_id, '{event_type}' AS event_type,
    1 AS schema_version, 'mbta_gtfs_realtime' AS source,
    make_timestamp(({second}) * 1000000) AS source_timestamp,
    make_timestamp(feed_timestamp * 1000000) AS feed_timestamp, ingested_at,
    {oracle.NOW} AS published_at
    """


oracle.add_part(
    "feed_vehicles",
    f"""
    SELECT {_event_header("vehicle_position", _SOURCE_SECOND)},
        cast(user_id % 27 as varchar) AS route_id, cast(user_id % 40 as varchar) AS trip_id,
        CASE WHEN kind = 4 THEN concat('e', event_id) ELSE concat('V', user_id) END AS vehicle_id,
        cast('42.' || lpad(cast(event_id % 1000 as varchar), 3, '0') as double) AS latitude,
        cast('-71.' || lpad(cast(event_id % 1000 as varchar), 3, '0') as double) AS longitude,
        90.5e0 AS bearing, cast(null as double) AS odometer, cast(null as double) AS speed_mps,
        cast(user_id % 2 as int) AS direction_id, 4 AS current_stop_sequence,
        cast(null as varchar) AS stop_id, 'STOPPED_AT' AS current_status,
        cast(null as varchar) AS vehicle_label, 'FULL' AS occupancy_status
    FROM fx_feed_entities
    WHERE event_id % 3 = 0 AND kind IN (0, 3, 4) AND feed_timestamp IS NOT NULL
    """,
)


@check("normalised_vehicles", "NRM1 NRM5", "SELECT * FROM feed_vehicles")
def _(t):
    found = normalize.vehicle_events(entities(t), AS_OF)
    return found.select("*", "payload.*").drop("payload")


oracle.add_part(
    "feed_trips",
    f"""
    SELECT *, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS seen_at
    FROM fx_feed_entities
    WHERE event_id % 3 = 1 AND kind IN (0, 3, 4, 5) AND feed_timestamp IS NOT NULL
    """,
)


@check(
    "normalised_trips",
    "NRM2",
    f"""
    SELECT {_event_header("trip_update", _SOURCE_SECOND)}, cast(null as varchar) AS route_id,
        cast(user_id % 40 as varchar) AS trip_id, strftime(ts, '%Y%m%d') AS start_date,
        '25:10:00' AS start_time, concat('V', user_id) AS vehicle_id,
        cast(user_id % 2 as int) AS direction_id, 'SCHEDULED' AS schedule_relationship,
        0 AS trip_delay_seconds, CASE WHEN kind = 5 THEN 0 ELSE 2 END AS stop_count
    FROM feed_trips
    """,
)
def _(t):
    found = normalize.trip_events(entities(t), AS_OF)
    return found.select(
        *[c for c in found.columns if c != "payload"],
        *[f"payload.{c}" for c in "direction_id schedule_relationship trip_delay_seconds".split()],
        F.size("payload.stop_time_updates").alias("stop_count"),
    )


@check(
    "normalised_trip_stops",
    "NRM2",
    f"""
    SELECT concat('e', event_id, ':', {_SOURCE_SECOND}) AS event_id, 0 AS position,
        cast(event_id % 100 as varchar) AS stop_id, 1 AS stop_sequence, seen_at AS predicted_arrival,
        seen_at AS predicted_departure, CASE WHEN kind = 4 THEN 0 ELSE 120 END AS delay_seconds,
        cast(null as varchar) AS schedule_relationship FROM feed_trips WHERE kind <> 5
    UNION ALL SELECT concat('e', event_id, ':', {_SOURCE_SECOND}), 1, null, 2, null, seen_at,
        CASE WHEN kind = 4 THEN 0 ELSE 180 END, 'SKIPPED' FROM feed_trips WHERE kind <> 5
    """,
)
def _(t):
    found = normalize.trip_events(entities(t), AS_OF)
    stops = found.select(
        "event_id", F.posexplode("payload.stop_time_updates").alias("position", "stop")
    )
    return stops.select("event_id", "position", "stop.*")


oracle.add_part(
    "feed_alerts",
    """
    SELECT *, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS seen_at
    FROM fx_feed_entities
    WHERE event_id % 3 = 2 AND kind NOT IN (1, 2) AND feed_timestamp IS NOT NULL
    """,
)


@check(
    "normalised_alerts",
    "NRM3 NRM4",
    f"""
    SELECT {_event_header("service_alert", "feed_timestamp")}, concat('e', event_id) AS alert_id,
        'STRIKE' AS cause, 'DETOUR' AS effect, 'INFO' AS severity,
        CASE WHEN kind = 3 THEN concat('Bonjour ', user_id)
            WHEN kind <> 4 THEN concat('Hello ', user_id) END AS header_text,
        cast(null as varchar) AS description_text,
        CASE WHEN kind <> 4 THEN 'https://example.org' END AS url,
        seen_at AS period_start, CASE WHEN kind <> 5 THEN seen_at END AS period_end
    FROM feed_alerts
    """,
)
def _(t):
    found = normalize.alert_events(entities(t), AS_OF)
    period = F.get("payload.active_periods", F.lit(0))
    return found.select(
        *[c for c in found.columns if c != "payload"],
        *[
            f"payload.{c}"
            for c in "cause effect severity header_text description_text url".split()
        ],
        period["start"].alias("period_start"),
        period["end"].alias("period_end"),
    )


@check(
    "normalised_alert_targets",
    "NRM3",
    """
    SELECT concat('e', event_id) AS alert_id, 0 AS position, '1' AS agency_id,
        cast(user_id % 27 as varchar) AS route_id, 3 AS route_type,
        cast(null as varchar) AS trip_id, cast(null as varchar) AS stop_id, 0 AS direction_id
    FROM feed_alerts
    UNION ALL SELECT concat('e', event_id), 1, null, concat('T', user_id % 27), null,
        cast(user_id % 40 as varchar), cast(event_id % 100 as varchar), 1 FROM feed_alerts
    """,
)
def _(t):
    found = normalize.alert_events(entities(t), AS_OF)
    targets = found.select(
        "alert_id", F.posexplode("payload.informed_entities").alias("position", "target")
    )
    return targets.select("alert_id", "position", "target.*")


@check(
    "translated_texts",
    "NRM4",
    """
    SELECT concat('e', event_id) AS id, CASE WHEN kind = 3 THEN concat('Bonjour ', user_id)
        WHEN kind <> 4 THEN concat('Hello ', user_id) END AS header
    FROM fx_feed_entities WHERE event_id % 3 = 2
    """,
)
def _(t):
    alerts = entities(t).where("alert IS NOT NULL")
    return alerts.select("id", text.translated(F.col("alert.header_text")).alias("header"))


@check(
    "quarantined_entities",
    "NRM6",
    "SELECT concat('e', event_id) AS id FROM fx_feed_entities WHERE feed_timestamp IS NULL",
)
def _(t):
    return normalize.unusable_feed(entities(t)).select("id")


@check(
    "feed_fan_out",
    "NRM7",
    f"""
    SELECT '{m.VEHICLE_TOPIC}' AS topic, vehicle_id AS key, count(*) AS messages
    FROM feed_vehicles GROUP BY vehicle_id
    UNION ALL SELECT '{m.TRIP_TOPIC}', cast(user_id % 40 as varchar), count(*)
    FROM feed_trips GROUP BY user_id % 40
    UNION ALL SELECT '{m.ALERT_TOPIC}', concat('e', event_id), count(*)
    FROM feed_alerts GROUP BY event_id
    """,
)
def _(t):
    sent = normalize.all_messages(entities(t), AS_OF)
    return sent.groupBy("topic", "key").agg(F.count("*").alias("messages"))


_STAMP = "strftime({value}, '%Y-%m-%dT%H:%M:%S.%fZ')"


@check(
    "published_messages",
    "SNK5",
    f"""
    SELECT vehicle_id AS key, '{m.VEHICLE_TOPIC}' AS topic,
        concat('{{"event_id":"', event_id, '","event_type":"vehicle_position",',
        '"schema_version":1,"source":"mbta_gtfs_realtime","source_timestamp":"',
        {_STAMP.format(value="source_timestamp")}, '","feed_timestamp":"',
        {_STAMP.format(value="feed_timestamp")}, '","ingested_at":"',
        {_STAMP.format(value="ingested_at")}, '","published_at":"',
        {_STAMP.format(value="published_at")}, '","route_id":"', route_id, '","trip_id":"',
        trip_id, '","vehicle_id":"', vehicle_id, '","payload":{{"latitude":', latitude,
        ',"longitude":', longitude, ',"bearing":90.5,"odometer":null,"speed_mps":null,',
        '"direction_id":', direction_id, ',"current_stop_sequence":4,"stop_id":null,',
        '"current_status":"STOPPED_AT","vehicle_label":null,"occupancy_status":"FULL"}}}}') AS value
    FROM feed_vehicles
    """,
)
def _(t):
    found = normalize.vehicle_events(entities(t), AS_OF)
    return normalize.published_messages(found, m.VEHICLE_TOPIC, "vehicle_id")


@check(
    "epoch_instants",
    "NRM5",
    "SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS seen_at FROM events",
)
def _(t):
    source = driver_table(t.spark, t.folder, "events")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    return source.select("event_id", F.timestamp_seconds(second).alias("seen_at"))


@check(
    "local_times",
    "AGG3",
    f"""
    SELECT event_id, {oracle.local("ts")} AS local_time,
        {oracle.instant(oracle.local("ts"))} AS back
    FROM events
    """,
)
def _(t):
    seen = F.col("ts").cast("timestamp")
    local = times.to_local(seen, oracle.ZONE)
    return driver_table(t.spark, t.folder, "events").select(
        "event_id", local.alias("local_time"), times.to_instant(local, oracle.ZONE).alias("back")
    )
