"""Checks of the operational rules: alert life, bunching, stalled vehicles, windows and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.projections import Staged, project
from checks.registry import check
from stopwise.operators import bunching, stalled
from stopwise.session import shared_folder
from stopwise.streaming import alerts, windows

# Delays of trips as detections: a fingerprint per user, times as they are. The last row is
# far later and of a fingerprint of its own, so that the watermark passes all others.
DETECTIONS = """
SELECT concat('f', cast(user_id % 40 as @str)) AS alert_fingerprint, cast(ts as timestamp) AS detected_at,
    value AS observed_value FROM @events WHERE value >= 5.0e0
"""
COOLDOWN = 1800


def _detections(t: Staged):
    return project(t.spark, t.folder, DETECTIONS)


_ISLANDS = f"""
SELECT * FROM (WITH d AS ({DETECTIONS.replace("@str", "varchar").replace("@events", "events")}),
marked AS (
    SELECT *, CASE WHEN epoch_us(detected_at) - lag(epoch_us(detected_at)) OVER (
        PARTITION BY alert_fingerprint ORDER BY detected_at) <= {COOLDOWN} * 1000000 THEN 0 ELSE 1 END AS begins
    FROM d
), numbered AS (
    SELECT *, sum(begins) OVER (PARTITION BY alert_fingerprint ORDER BY detected_at) AS island FROM marked
), islands AS (
    SELECT alert_fingerprint, min(detected_at) AS first_detected_at, max(detected_at) AS last_detected_at,
        count(*) AS detections, max(cast(observed_value as double)) AS observed_value
    FROM numbered GROUP BY alert_fingerprint, island
)
SELECT alert_fingerprint, 'active' AS status, first_detected_at, first_detected_at AS last_detected_at,
    cast(null as bigint) AS detections, cast(null as double) AS observed_value FROM islands
UNION ALL
SELECT alert_fingerprint, 'resolved' AS status, first_detected_at, last_detected_at, detections,
    observed_value FROM islands) q
"""


@check("alert_lifecycle", "RULE1", _ISLANDS)
def _(t):
    """As a stream in two runs on one checkpoint; a last detection lets the watermark pass the others."""
    base = f"{shared_folder(t.spark)}/alerts/{t.run_name}"
    rows = _detections(t)
    late = rows.agg(F.max("detected_at").alias("x")).select(
        F.lit("end").alias("alert_fingerprint"),
        (F.col("x") + F.expr("INTERVAL 30 DAYS")).alias("detected_at"),
        F.lit(0.0).alias("observed_value"),
    )


    parts = (rows, late)
    for part in parts:
        part.select("alert_fingerprint", "detected_at", F.col("observed_value").cast("double").alias("observed_value")).write.mode("append").parquet(f"{base}/in")
        stream = t.spark.readStream.schema(
            "alert_fingerprint string, detected_at timestamp, observed_value double"
        ).parquet(f"{base}/in")
        query = (
            alerts.lifecycle(stream, COOLDOWN)
            .writeStream.option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .format("parquet")
            .start(f"{base}/out")
        )
        query.awaitTermination()
    return t.spark.read.parquet(f"{base}/out").where("alert_fingerprint <> 'end'")


@check("alert_islands", "RULE1", _ISLANDS)
def _(t):
    return alerts.alerts_of(_detections(t), COOLDOWN)


VISITS = """
SELECT route_id, direction_id, stop_id, vehicle_id, predicted_arrival AS observed_at FROM fx_trip_stop_updates
"""
HEADWAY = 900


@check(
    "bunched_vehicles",
    "RULE2",
    f"""
    SELECT * FROM (WITH visits AS (
        SELECT DISTINCT * FROM ({VISITS}) WHERE stop_id IS NOT NULL AND vehicle_id IS NOT NULL
            AND observed_at IS NOT NULL
    ), led AS (
        SELECT *, lag(vehicle_id) OVER w AS leader_id, lag(observed_at) OVER w AS leader_at FROM visits
        WINDOW w AS (PARTITION BY route_id, direction_id, stop_id ORDER BY observed_at, vehicle_id)
    ), headways AS (
        SELECT *, (epoch_us(observed_at) - epoch_us(leader_at)) / 1000000.0 AS headway FROM led
        WHERE leader_id <> vehicle_id AND epoch_us(observed_at) - epoch_us(leader_at) <= 86400000000
    ), runs AS (
        SELECT *, row_number() OVER (PARTITION BY route_id, direction_id, leader_id, vehicle_id
                ORDER BY observed_at, stop_id)
            - row_number() OVER (PARTITION BY route_id, direction_id, leader_id, vehicle_id,
                headway < {HEADWAY} ORDER BY observed_at, stop_id) AS run FROM headways
    )
    SELECT route_id, direction_id, leader_id, vehicle_id, min(observed_at) AS first_at,
        max(observed_at) AS last_at, count(*) AS observations,
        cast(round(min(headway), 3) as double) AS least_headway_seconds
    FROM runs WHERE headway < {HEADWAY} GROUP BY route_id, direction_id, leader_id, vehicle_id, run
    HAVING count(*) >= 2) q
    """,
)
def _(t):
    visits = t["trip_stop_updates"].withColumn("observed_at", F.col("predicted_arrival"))
    return bunching.bunched(visits, HEADWAY, width=86_400)


STILL, SPAN = 6000.0, 43_200


@check(
    "stalled_vehicles",
    "RULE3",
    f"""
    SELECT * FROM (WITH known AS (
        SELECT vehicle_id, event_timestamp, latitude, longitude, epoch_us(event_timestamp) AS us
        FROM fx_vehicle_positions WHERE vehicle_id IS NOT NULL AND event_timestamp IS NOT NULL
            AND latitude IS NOT NULL AND longitude IS NOT NULL AND trip_id IS NOT NULL
    ), boxes AS (
        SELECT vehicle_id, event_timestamp, (us - min(us) OVER w) / 1000000.0 AS observed_seconds,
            (max(latitude) OVER w - min(latitude) OVER w) * 110574.0e0 AS north,
            (max(longitude) OVER w - min(longitude) OVER w) * 111320.0e0
                * cos(radians((min(latitude) OVER w + max(latitude) OVER w) / 2)) AS across
        FROM known WINDOW w AS (PARTITION BY vehicle_id ORDER BY us
            RANGE BETWEEN {SPAN * 1_000_000} PRECEDING AND CURRENT ROW)
    ), marked AS (
        SELECT *, sqrt(north * north + across * across) AS moved,
            sqrt(north * north + across * across) <= {STILL} AND observed_seconds >= {SPAN} * 0.5e0 AS still
        FROM boxes
    ), runs AS (
        SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_timestamp, moved)
            - row_number() OVER (PARTITION BY vehicle_id, still ORDER BY event_timestamp, moved) AS run
        FROM marked
    )
    SELECT vehicle_id, min(event_timestamp) AS first_at, max(event_timestamp) AS last_at,
        count(*) AS observations, round(max(moved), 3) AS most_metres
    FROM runs WHERE still GROUP BY vehicle_id, run) q
    """,
)
def _(t):
    found = stalled.stalled(t["vehicle_positions"], STILL, SPAN, seen=0.5, width=2 * SPAN)
    return found.withColumn("most_metres", F.round("most_metres", 3))


RECORDS = """
SELECT cast(ts as timestamp) AS event_at,
    CASE WHEN event_id % 37 = 0 THEN null ELSE cast(ts as timestamp)
        + cast(event_id * event_id % 95003 - 500 as int) * interval '1' millisecond END AS arrived_at,
    event_id % 150 <> 0 AS is_valid, event_id % 450 = 7 AS is_dead_letter,
    CASE WHEN user_id % 90 = 0 THEN null ELSE user_id END AS route_id
FROM @events
"""


def _records(t: Staged):
    rows = project(t.spark, t.folder, RECORDS)
    return rows.withColumn("route_id", F.col("route_id").cast("string"))


def _windows_sql(seconds: int) -> str:
    return f"""
    SELECT time_bucket(interval '{seconds}' second, event_at) AS window_start, {seconds} AS window_seconds,
        count(*) AS records, count(*) FILTER (NOT is_valid) / count(*) AS invalid_ratio,
        count(*) FILTER (is_dead_letter) / count(*) AS dead_letters_ratio,
        count(*) FILTER (route_id IS NULL) / count(*) AS missing_route_ratio,
        quantile_disc(ms, 0.95) AS p95
    FROM timed GROUP BY ALL"""


_WINDOWS = f"""
SELECT * FROM (WITH timed AS (
    SELECT *, greatest(cast(floor((epoch_us(arrived_at) - epoch_us(event_at)) / 1000) as bigint), 0) AS ms
    FROM ({RECORDS.replace("@events", "events")})
), timed_or_not AS (
    SELECT * REPLACE (CASE WHEN arrived_at IS NULL THEN null ELSE ms END AS ms) FROM timed
), found AS ({" UNION ALL ".join(_windows_sql(x).replace("FROM timed ", "FROM timed_or_not ") for x in windows.WINDOWS.values())}
), classes AS (
    SELECT * EXCLUDE (p95), cast(p95 | ((cast(1 as bigint) << greatest(length(bin(p95)) - 7, 0)) - 1) as bigint)
        AS p95_latency_ms FROM found
)
SELECT *, CASE WHEN invalid_ratio > 0.01 OR dead_letters_ratio > 0.005 THEN 'critical'
    WHEN missing_route_ratio > 0.02 OR p95_latency_ms > 60000 THEN 'warning' ELSE 'ok' END AS status
FROM classes) q
"""


@check("batch_windows", "RULE4 RULE5", _WINDOWS)
def _(t):
    return windows.all_windows(windows.minutes(_records(t)))


@check("streamed_windows", "RULE4 RULE5", _WINDOWS)
def _(t):
    """Counted by a stream in two runs on one checkpoint; a last record lets the watermark pass the others."""
    base = f"{shared_folder(t.spark)}/windows/{t.run_name}"
    rows = _records(t)
    schema = "event_at timestamp, arrived_at timestamp, is_valid boolean, is_dead_letter boolean, route_id string"
    last = rows.agg(F.max("event_at").alias("x")).select(
        (F.col("x") + F.expr("INTERVAL 30 DAYS")).alias("event_at"),
        F.lit(None).cast("timestamp").alias("arrived_at"),
        F.lit(True).alias("is_valid"),
        F.lit(False).alias("is_dead_letter"),
        F.lit("last").alias("route_id"),
    )
    for part in (rows, last):
        part.write.mode("append").parquet(f"{base}/in")
        query = (
            windows.minutes(t.spark.readStream.schema(schema).parquet(f"{base}/in"))
            .writeStream.option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .format("parquet")
            .start(f"{base}/out")
        )
        query.awaitTermination()
    counted = t.spark.read.parquet(f"{base}/out")
    return windows.all_windows(counted)
