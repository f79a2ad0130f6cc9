"""Transit-shaped projections of the driver's tables.

Each is one SQL text that Spark and DuckDB both run over a whole table; only
the name of the text type differs. Values, never rows, are varied by id, so
that nulls, misses and boundary cases occur.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stopwise.session import use_utc

AS_OF = "2024-01-30 23:58:00"

_T = "cast(ts as timestamp)"
_DAY = "cast(cast(ts as date) as @str)"
_LINEAGE = (
    "'mbta_gtfs_realtime' AS source, 1 AS schema_version, "
    "'{topic}' AS kafka_topic, cast(event_id % 3 as int) AS kafka_partition, "
    "cast(floor(event_id / 3) as bigint) AS kafka_offset, "
    f"{_T} + interval '3' second AS kafka_timestamp"
)
_NO = "cast(null as @str)"
_NO_INT = "cast(null as int)"

ROUTES = f"""
SELECT cast(n_nationkey as @str) AS route_id, {_NO} AS agency_id,
    CASE WHEN n_nationkey % 6 = 5 THEN null ELSE n_name END AS route_short_name,
    concat('Route ', n_name) AS route_long_name, {_NO} AS route_desc,
    CASE WHEN n_regionkey <= 2 THEN 3 ELSE 1 END AS route_type,
    concat('00FF', lpad(cast(n_nationkey as @str), 2, '0')) AS route_color,
    {_NO} AS route_text_color, {_NO} AS route_url, cast(n_nationkey * 10 as int) AS route_sort_order,
    {_NO} AS route_fare_class, {_NO} AS line_id, 1 AS listed_route, {_NO} AS network_id
FROM @nation
"""

STOPS = f"""
SELECT cast(s_suppkey as @str) AS stop_id, {_NO} AS stop_code, s_name AS stop_name,
    {_NO} AS stop_desc, {_NO} AS platform_name, {_NO} AS zone_id, {_NO} AS stop_address,
    {_NO} AS stop_url, {_NO} AS level_id, concat('Town ', cast(s_nationkey as @str)) AS municipality,
    {_NO} AS on_street, {_NO} AS at_street, {_NO_INT} AS vehicle_type,
    42.0e0 + s_suppkey / 1000.0e0 AS stop_lat, -71.0e0 - s_suppkey / 1000.0e0 AS stop_lon,
    cast(s_suppkey % 6 as int) AS location_type,
    CASE WHEN s_suppkey % 4 = 0 THEN '' WHEN s_suppkey % 9 = 1 THEN 'nowhere'
        ELSE cast(s_suppkey - s_suppkey % 4 as @str) END AS parent_station,
    cast(s_suppkey % 3 as int) AS wheelchair_boarding,
    CASE WHEN s_suppkey % 5 = 0 THEN null ELSE concat('P', cast(s_suppkey % 5 as @str)) END
        AS platform_code
FROM @supplier
"""

TRIPS = f"""
SELECT cast(c_custkey as @str) AS trip_id, cast(c_nationkey + c_custkey % 3 as @str) AS route_id,
    c_mktsegment AS service_id, c_name AS trip_headsign, {_NO} AS trip_short_name,
    CASE WHEN c_custkey % 11 = 0 THEN null ELSE cast(c_custkey % 2 as int) END AS direction_id,
    concat('b', cast(c_custkey % 7 as @str)) AS block_id, {_NO} AS shape_id,
    1 AS wheelchair_accessible, 0 AS bikes_allowed, {_NO_INT} AS trip_route_type,
    {_NO} AS route_pattern_id
FROM @customer
"""

_CLOCK = (
    "concat(lpad(cast(o_orderkey % 28 as @str), 2, '0'), ':', "
    "lpad(cast(o_orderkey % 60 as @str), 2, '0'), ':{seconds}')"
)
STOP_TIMES = f"""
SELECT cast(cast(floor(o_orderkey / 12) as bigint) as @str) AS trip_id,
    cast(o_orderkey % 12 + 1 as int) AS stop_sequence, cast(o_custkey % 120 as @str) AS stop_id,
    CASE WHEN o_orderkey % 11 = 0 THEN null ELSE {_CLOCK.format(seconds="00")} END AS arrival_time,
    CASE WHEN o_orderkey % 17 = 0 THEN null ELSE {_CLOCK.format(seconds="30")} END
        AS departure_time,
    CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus END AS stop_headsign,
    cast(o_orderkey % 4 as int) AS pickup_type, 0 AS drop_off_type, 1 AS timepoint,
    {_NO} AS checkpoint_id, {_NO_INT} AS continuous_pickup, {_NO_INT} AS continuous_drop_off
FROM @orders
"""

CALENDAR = """
SELECT o_orderpriority AS service_id, 1 AS monday, 1 AS tuesday, 1 AS wednesday, 1 AS thursday,
    1 AS friday, 0 AS saturday, 0 AS sunday, cast(min(o_orderdate) as date) AS start_date,
    cast(max(o_orderdate) as date) AS end_date
FROM @orders GROUP BY o_orderpriority
"""

CALENDAR_DATES = f"""
SELECT c_mktsegment AS service_id, cast('2024-02-01' as date) AS date,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 2 ELSE 1 END AS exception_type,
    {_NO} AS holiday_name
FROM @customer GROUP BY c_mktsegment
"""

VEHICLE_POSITIONS = f"""
SELECT cast(event_id as @str) AS event_id, concat('v', cast(user_id as @str)) AS vehicle_id,
    {_T} AS event_timestamp, cast(date_trunc('minute', ts) as timestamp) AS feed_timestamp,
    {_T} + interval '2' second AS published_at, {_T} AS ingested_at,
    CASE WHEN event_id % 3 = 0 THEN null ELSE cast(user_id % 27 as @str) END AS route_id,
    CASE WHEN event_id % 10 = 9 THEN null ELSE cast(user_id % 40 as @str) END AS trip_id,
    42.0e0 + value / 1000.0e0 AS latitude, -71.0e0 - value / 1000.0e0 AS longitude,
    CASE WHEN event_id % 5 = 0 THEN null ELSE cast(event_id * 7 % 361 as double) END AS bearing,
    CASE WHEN event_id % 4 = 0 THEN null ELSE cast(event_id * 10 as double) END AS odometer,
    CASE WHEN event_id % 3 = 1 THEN null ELSE value / 20.0e0 END AS speed_mps,
    CASE event_id % 4 WHEN 0 THEN 'MANY_SEATS_AVAILABLE' WHEN 1 THEN 'FULL' WHEN 2 THEN '' END
        AS occupancy_status,
    {_LINEAGE.format(topic="transit.vehicle_positions.v1")}
FROM @events
"""

TRIP_STOP_UPDATES = f"""
SELECT cast(event_id as @str) AS event_id, k AS stop_update_index, {_T} AS event_timestamp,
    cast(date_trunc('minute', ts) as timestamp) AS feed_timestamp, {_T} AS ingested_at,
    {_T} + interval '2' second AS published_at,
    CASE WHEN user_id % 10 = 9 THEN 'unscheduled' ELSE cast(user_id % 40 as @str) END AS trip_id,
    CASE WHEN event_id % 8 = 0 THEN null ELSE cast(ts as date) END AS start_date,
    CASE WHEN event_id % 9 = 0 THEN '25:10:00' END AS start_time,
    CASE WHEN event_id % 4 = 0 THEN null ELSE cast(user_id % 25 as @str) END AS route_id,
    concat('v', cast(user_id as @str)) AS vehicle_id,
    CASE WHEN event_id % 6 = 0 THEN null ELSE cast(user_id % 2 as int) END AS direction_id,
    CASE WHEN event_id % 7 = 0 THEN 'ADDED' ELSE 'SCHEDULED' END AS trip_schedule_relationship,
    CASE WHEN event_id % 2 = 0 THEN cast(event_id % 400 as int) END AS trip_delay_seconds,
    cast((event_id + k) % 100 as @str) AS stop_id,
    CASE WHEN event_id % 13 = 0 THEN null ELSE cast((event_id + k) % 12 + 1 as int) END
        AS stop_sequence,
    CASE WHEN event_id % 5 = 0 THEN null ELSE cast(date_trunc('second', ts)
        + interval '1' second * cast(k * 240 - 120 + event_id % 600 as int) as timestamp) END
        AS predicted_arrival,
    CASE WHEN event_id % 7 = 0 THEN null ELSE cast(date_trunc('second', ts)
        + interval '1' second * cast(k * 240 - 60 + event_id % 600 as int) as timestamp) END
        AS predicted_departure,
    cast(event_id % 300 - 60 as int) AS delay_seconds, {_NO} AS stop_schedule_relationship,
    {_LINEAGE.format(topic="transit.trip_updates.v1")}
FROM @events @repeat4
"""

SERVICE_ALERT_ENTITIES = f"""
SELECT cast(event_id as @str) AS event_id, k AS informed_entity_index,
    concat('a', cast(user_id % 20 as @str)) AS alert_id, {_T} AS event_timestamp,
    cast(date_trunc('day', ts) as timestamp) AS feed_timestamp, {_T} AS ingested_at,
    {_T} + interval '2' second AS published_at,
    CASE WHEN user_id % 2 = 0 THEN 'MAINTENANCE' END AS cause,
    CASE WHEN user_id % 3 = 0 THEN 'DETOUR' WHEN user_id % 3 = 1 THEN 'NO_SERVICE' END AS effect,
    CASE WHEN user_id % 20 < 5 THEN null WHEN user_id % 20 < 12 THEN 'WARNING' ELSE 'INFO' END
        AS severity,
    concat('Alert ', event_type) AS header_text, {_NO} AS description_text,
    CASE WHEN event_id % 2 = 0 THEN 'https://example.org/alert' END AS url,
    CASE event_id % 6
        WHEN 1 THEN concat('[{{"start":"', {_DAY}, 'T06:00:00.000Z","end":"', {_DAY},
            'T18:00:00.000Z"}}]')
        WHEN 2 THEN concat('[{{"start":"', {_DAY}, 'T20:00:00.000Z"}}]')
        WHEN 4 THEN concat('[{{"start":"', {_DAY}, 'T06:00:00.000Z","end":"', {_DAY},
            'T08:00:00.000Z"}},{{"start":"', {_DAY}, 'T22:00:00.000Z","end":"', {_DAY},
            'T23:59:59.000Z"}}]')
        WHEN 5 THEN concat('[{{"end":"', {_DAY}, 'T12:00:00.000Z"}}]')
        ELSE '[]' END AS active_periods,
    CASE WHEN event_id % 5 = 0 THEN '1' END AS agency_id,
    CASE WHEN user_id % 20 = 7 OR (event_id + k) % 3 = 0 THEN null
        ELSE cast(user_id % 27 as @str) END AS route_id,
    CASE WHEN event_id % 7 = 0 THEN 3 END AS route_type,
    CASE WHEN user_id % 20 <> 7 AND (event_id + k) % 4 = 0 THEN cast(user_id % 40 as @str) END
        AS trip_id,
    CASE WHEN k = 1 THEN cast(event_id % 110 as @str) END AS stop_id,
    CASE WHEN event_id % 3 = 0 THEN null ELSE cast(event_id % 2 as int) END AS direction_id,
    {_LINEAGE.format(topic="transit.service_alerts.v1")}
FROM @events @repeat2
"""

PROJECTIONS = {
    "routes": ROUTES,
    "stops": STOPS,
    "trips": TRIPS,
    "stop_times": STOP_TIMES,
    "calendar": CALENDAR,
    "calendar_dates": CALENDAR_DATES,
    "vehicle_positions": VEHICLE_POSITIONS,
    "trip_stop_updates": TRIP_STOP_UPDATES,
    "service_alert_entities": SERVICE_ALERT_ENTITIES,
}
DRIVER_TABLES = ("nation", "supplier", "customer", "orders", "events", "documents")


# ``@repeatN``: every row N times, numbered ``k`` from 0.
REPEATS = (2, 4)


def duckdb_text(text: str) -> str:
    """The projection as DuckDB runs it, over the driver's views."""
    for n in REPEATS:
        numbers = f"(SELECT cast(unnest(range({n})) as int) AS k) n"
        text = text.replace(f"@repeat{n}", f"CROSS JOIN {numbers}")
    for name in DRIVER_TABLES:
        text = text.replace(f"@{name}", name)
    text = text.replace("@epoch", "(epoch_us(ts) // 1000000)")
    return text.replace("@offset", '"offset"').replace("@str", "varchar").strip()


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def over(text: str, **tables: DataFrame) -> DataFrame:
    """The projection as Spark runs it, over the given tables."""
    spark = next(iter(tables.values())).sparkSession
    text = text.replace("@offset", "offset").replace("@str", "string").replace("{", "{{").replace("}", "}}")
    text = text.replace("@epoch", "unix_seconds(cast(ts as timestamp))")
    for n in REPEATS:
        text = text.replace(f"@repeat{n}", f"LATERAL VIEW explode(sequence(0, {n - 1})) n AS k")
    for name in tables:
        text = text.replace(f"@{name}", "{" + name + "}")
    return spark.sql(text, **tables)


def project(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = [name for name in DRIVER_TABLES if f"@{name}" in text]
    return over(text, **{name: driver_table(spark, sf_dir, name) for name in used})


class Staged(dict):
    """Staged tables by name, projected when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.folder = spark, sf_dir
        # Output folders of one run are its own.
        self.run_name = uuid.uuid4().hex[:12]

    def __missing__(self, name: str) -> DataFrame:
        self[name] = project(self.spark, self.folder, PROJECTIONS[name])
        return self[name]
