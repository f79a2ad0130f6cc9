"""Checks of served queries and of their shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracle
from checks.batch import health, samples
from checks.projections import AS_OF
from checks.registry import LIVE, check
from stopwise.functions import text
from stopwise.plans import marts, serving, shaping

SINCE, UNTIL = "2024-01-10 00:00:00", "2024-01-25 00:00:00"
BEFORE = "2023-12-26 00:00:00"
_RANGE = f"observation_bucket >= TIMESTAMP '{SINCE}' AND observation_bucket < TIMESTAMP '{UNTIL}'"
_PERIOD = f"event_timestamp >= TIMESTAMP '{SINCE}' AND event_timestamp < TIMESTAMP '{UNTIL}'"
_LISTS = ("route_ids", "stop_ids", "trip_ids", "direction_ids")


def vehicles(t):
    return marts.vehicle_latest_state(t, AS_OF, LIVE)


def alerts(t):
    return marts.service_alerts_latest_snapshot(t, AS_OF, LIVE)


_SUMS = (
    "cast(sum(observed_trip_count) as bigint) AS observed_trip_count, "
    "cast(sum(eligible_trip_count) as bigint) AS eligible_trip_count, "
    "cast(sum(late_trip_count) as bigint) AS late_trip_count"
)
_SUM_RATE = oracle.rate(
    "cast(sum(late_trip_count) as bigint)", "cast(sum(eligible_trip_count) as bigint)", 1
)
_TREND = f"""
SELECT observation_bucket, {_SUMS}, {_SUM_RATE} AS predicted_late_percentage
FROM health WHERE {{where}} GROUP BY observation_bucket
"""
oracle.add_part("trend", _TREND.format(where=_RANGE))
oracle.add_part(
    "comparison",
    f"""
    SELECT route_id, max(route_short_name) AS route_short_name, {_SUMS},
        {_SUM_RATE} AS predicted_late_percentage
    FROM health WHERE {_RANGE} GROUP BY route_id HAVING sum(eligible_trip_count) >= 20
    """,
)
_LATE = "count(*) FILTER (is_predicted_late)"
_KNOWN = "count(predicted_delay_seconds)"
_MEASURES = f"""
count(*) AS observed_trip_count, {_KNOWN} AS eligible_trip_count, {_LATE} AS late_trip_count,
{oracle.rate(_LATE, _KNOWN, 1)} AS predicted_late_percentage,
{oracle.rate(_KNOWN, "count(*)", 1)} AS metric_coverage_percentage,
{oracle.decile("predicted_lateness_seconds", 1)} AS p90_predicted_lateness_minutes
"""


def _summary(where: str) -> str:
    return f"SELECT {_MEASURES} FROM samples WHERE route_type = 3 AND {where}"


oracle.add_part("period_summary", _summary(_PERIOD))
oracle.add_part(
    "previous_summary",
    _summary(
        f"event_timestamp >= TIMESTAMP '{BEFORE}' AND event_timestamp < TIMESTAMP '{SINCE}'"
    ),
)


@check(
    "vehicle_status",
    "QRY1 AGG7",
    """
    SELECT count(*) FILTER (is_fresh) AS fresh_vehicle_count,
        max(event_timestamp) AS latest_event_at
    FROM live_state WHERE route_type = 3
    """,
)
def _(t):
    return serving.vehicle_status(vehicles(t))


@check(
    "alert_status",
    "QRY2",
    """
    SELECT count(*) FILTER (is_display_active_now AND is_feed_fresh) AS active_alert_count,
        max(feed_timestamp) AS latest_feed_at
    FROM live_alerts
    """,
)
def _(t):
    return serving.alert_status(alerts(t))


@check(
    "alert_feed_status",
    "QRY3",
    """
    SELECT max(feed_timestamp) AS latest_feed_at,
        count(*) FILTER (is_feed_fresh) AS fresh_snapshot_entities
    FROM live_alerts
    """,
)
def _(t):
    return serving.alert_feed_status(alerts(t))


@check(
    "latest_bucket",
    "QRY4 QRY13",
    "SELECT max(observation_bucket) AS latest_bucket FROM health "
    "WHERE route_id = '7' AND direction_id = 1",
)
def _(t):
    return serving.latest_bucket(health(t), "7", 1)


@check(
    "latest_health_bucket",
    "QRY4",
    "SELECT max(observation_bucket) AS latest_bucket FROM health",
)
def _(t):
    return serving.latest_bucket(health(t))


@check("health_trend", "QRY5 AGG9", "SELECT * FROM trend")
def _(t):
    return serving.health_trend(health(t), SINCE, until=UNTIL)


@check(
    "route_trend",
    "QRY5 QRY13",
    _TREND.format(
        where=f"observation_bucket >= TIMESTAMP '{SINCE}' AND route_id = '7' AND direction_id = 0"
    ),
)
def _(t):
    return serving.health_trend(health(t), SINCE, "7", 0)


_ATTENTION = f"""
SELECT route_id, direction_id, max(route_short_name) AS route_short_name, {_MEASURES}
FROM samples WHERE route_type = 3 AND {_PERIOD} AND route_id IS NOT NULL
GROUP BY route_id, direction_id HAVING {_KNOWN} >= 5
ORDER BY predicted_late_percentage DESC NULLS LAST,
    p90_predicted_lateness_minutes DESC NULLS LAST, eligible_trip_count DESC, route_id,
    direction_id
LIMIT 10
"""


@check(
    "routes_needing_attention",
    "QRY6 TOP3",
    f"SELECT * EXCLUDE (late_trip_count) FROM ({_ATTENTION}) a",
)
def _(t):
    return serving.routes_needing_attention(samples(t), SINCE, UNTIL, min_eligible=5)


@check(
    "bus_routes",
    "QRY7",
    "SELECT route_id, route_short_name, route_long_name FROM fx_routes WHERE route_type = 3",
)
def _(t):
    return serving.routes(marts.dim_routes(t))


@check("route_comparison", "QRY8", "SELECT * FROM comparison")
def _(t):
    return serving.route_comparison(health(t), SINCE, until=UNTIL, min_eligible=20)


@check("period_summary", "QRY9 AGG10", "SELECT * FROM period_summary")
def _(t):
    return serving.period_summary(samples(t), SINCE, UNTIL)


@check(
    "route_period_summary",
    "QRY9 QRY13",
    _summary(f"{_PERIOD} AND route_id = '7' AND direction_id = 1"),
)
def _(t):
    return serving.period_summary(samples(t), SINCE, UNTIL, "7", 1)


_SAMPLE_COLUMNS = """
observation_bucket, observation_local_timestamp, route_id, route_short_name, direction_id,
trip_id, trip_instance_key, stop_name, delay_basis, scheduled_prediction_timestamp,
delay_prediction_timestamp, predicted_delay_seconds, is_predicted_late
"""
oracle.add_part(
    "newest_samples",
    f"""
    SELECT {_SAMPLE_COLUMNS} FROM samples
    WHERE route_type = 3 AND observation_bucket >= TIMESTAMP '{SINCE}'
    ORDER BY observation_bucket DESC, event_timestamp DESC, trip_instance_key LIMIT 100
    """,
)


@check("trip_samples_latest", "QRY10 TOP4", "SELECT * FROM newest_samples")
def _(t):
    return serving.trip_samples(samples(t), SINCE)


@check(
    "trip_samples_largest_delay",
    "QRY10 TOP4",
    f"""
    SELECT {_SAMPLE_COLUMNS} FROM samples
    WHERE route_type = 3 AND observation_bucket >= TIMESTAMP '{SINCE}' AND route_id = '7'
        AND direction_id = 1
    ORDER BY predicted_delay_seconds DESC NULLS FIRST, observation_bucket DESC,
        event_timestamp DESC, trip_instance_key
    LIMIT 50
    """,
)
def _(t):
    return serving.trip_samples(samples(t), SINCE, "7", 1, limit=50, sort_by="largest_delay")


_LIVE = """
SELECT vehicle_id, event_timestamp, route_id, route_short_name, trip_id, trip_headsign,
    direction_id, latitude, longitude, occupancy_status, source_age_seconds
FROM live_state
WHERE route_type = 3 AND is_fresh AND latitude BETWEEN -90 AND 90
    AND longitude BETWEEN -180 AND 180{more}
ORDER BY event_timestamp DESC, vehicle_id LIMIT {limit}
"""
oracle.add_part("live_vehicles", _LIVE.format(more="", limit=2001))


@check("live_vehicles", "QRY11", "SELECT * FROM live_vehicles")
def _(t):
    return serving.live_vehicles(vehicles(t))


@check(
    "live_vehicles_truncated",
    "TOP1 TOP2",
    f"""
    SELECT * FROM (SELECT *, (SELECT count(*) FROM live_vehicles) > 5 AS is_truncated
        FROM ({_LIVE.format(more="", limit=6)}) a ORDER BY event_timestamp DESC, vehicle_id LIMIT 5) b
    """,
)
def _(t):
    first = serving.live_vehicles(vehicles(t), limit=5)
    return shaping.page(first, 5, F.col("event_timestamp").desc(), F.col("vehicle_id"))


@check(
    "active_alerts",
    "QRY12",
    """
    SELECT alert_id, feed_timestamp, cause, severity, effect, header_text, description_text, url,
        route_ids, stop_ids, trip_ids, direction_ids, source_age_seconds
    FROM live_alerts WHERE is_display_active_now AND is_feed_fresh
        AND (list_contains(route_ids, '7') OR len(route_ids) = 0)
    """,
    lists=_LISTS,
)
def _(t):
    return serving.active_alerts(alerts(t), "7")


@check(
    "active_alerts_all_routes",
    "QRY12",
    """
    SELECT alert_id, feed_timestamp, cause, severity, effect, header_text, description_text, url,
        route_ids, stop_ids, trip_ids, direction_ids, source_age_seconds
    FROM live_alerts WHERE is_display_active_now AND is_feed_fresh
    """,
    lists=_LISTS,
)
def _(t):
    return serving.active_alerts(alerts(t))


@check("most_late_routes", "TOP5", """
    SELECT * FROM comparison
    ORDER BY predicted_late_percentage DESC NULLS LAST, eligible_trip_count DESC NULLS LAST, route_id
    LIMIT 10
    """)
def _(t):
    comparison = serving.route_comparison(health(t), SINCE, until=UNTIL, min_eligible=20)
    return shaping.most_late_routes(comparison)


@check(
    "filtered_samples",
    "QRY13",
    f"""
    SELECT event_id, observation_bucket, route_id, direction_id FROM samples
    WHERE {_RANGE} AND route_id = '7' AND direction_id = 1
    """,
)
def _(t):
    rows = serving.matching(
        samples(t), since=SINCE, until=UNTIL, route_id="7", direction_id=1
    )
    return rows.select("event_id", "observation_bucket", "route_id", "direction_id")


# Shaping -----------------------------------------------------------------


@check(
    "gap_filled_trend",
    "PST1",
    f"""
    SELECT s.observation_bucket, t.observed_trip_count, t.eligible_trip_count, t.late_trip_count,
        t.predicted_late_percentage, {oracle.local("s.observation_bucket")} AS local_time
    FROM (SELECT unnest(generate_series(min(observation_bucket), max(observation_bucket),
        interval '5' minute)) AS observation_bucket FROM trend) s
    LEFT JOIN trend t ON t.observation_bucket = s.observation_bucket
    """,
)
def _(t):
    return shaping.gap_filled(serving.health_trend(health(t), SINCE, until=UNTIL))


@check(
    "reliability_summary",
    "PST2",
    """
    SELECT observed, eligible, late,
        cast(format('{:.1f}', 100 * late / eligible) as double) AS late_percentage,
        cast(format('{:.1f}', 100 * eligible / observed) as double) AS coverage_percentage
    FROM (SELECT cast(sum(observed_trip_count) as bigint) AS observed,
        cast(sum(eligible_trip_count) as bigint) AS eligible,
        cast(sum(late_trip_count) as bigint) AS late FROM trend) q
    """,
)
def _(t):
    return shaping.reliability_summary(serving.health_trend(health(t), SINCE, until=UNTIL))


@check(
    "period_changes",
    "PST3",
    """
    SELECT CASE WHEN least(n.eligible_trip_count, p.eligible_trip_count) >= 20
            THEN round(n.predicted_late_percentage - p.predicted_late_percentage, 1) END
            AS predicted_late_percentage_change,
        CASE WHEN least(n.eligible_trip_count, p.eligible_trip_count) >= 20
            THEN round(n.metric_coverage_percentage - p.metric_coverage_percentage, 1) END
            AS metric_coverage_percentage_change,
        CASE WHEN least(n.eligible_trip_count, p.eligible_trip_count) >= 20
            THEN round(n.p90_predicted_lateness_minutes - p.p90_predicted_lateness_minutes, 1) END
            AS p90_predicted_lateness_minutes_change
    FROM period_summary n CROSS JOIN previous_summary p
    """,
)
def _(t):
    sampled = samples(t)
    return shaping.period_changes(
        serving.period_summary(sampled, SINCE, UNTIL),
        serving.period_summary(sampled, BEFORE, SINCE),
        20,
    )


@check(
    "source_status",
    "PST4",
    f"""
    SELECT vehicle_id, CASE WHEN event_timestamp IS NULL THEN 'missing'
        WHEN epoch_us({oracle.NOW}) - epoch_us(event_timestamp) > 90000000 THEN 'stale'
        ELSE 'fresh' END AS status
    FROM live_state
    """,
)
def _(t):
    status = shaping.source_status(F.col("event_timestamp"), shaping.VEHICLE_MINUTES, AS_OF)
    return vehicles(t).select("vehicle_id", status.alias("status"))


@check(
    "alerts_by_severity_and_effect",
    "PST5",
    """
    SELECT alert_id, severity, effect FROM live_alerts
    WHERE coalesce(severity, 'Unknown') = 'Unknown' AND effect = 'DETOUR'
    """,
)
def _(t):
    found = shaping.filtered_alerts(alerts(t), "Unknown", "DETOUR")
    return found.select("alert_id", "severity", "effect")


@check(
    "found_vehicles",
    "PST6",
    "SELECT vehicle_id FROM latest_state WHERE contains(lower(vehicle_id), lower('V1'))",
)
def _(t):
    return shaping.found_vehicles(vehicles(t), " V1 ").select("vehicle_id")


@check(
    "route_labels",
    "PST7",
    """
    SELECT route_id, coalesce(nullif(route_short_name, ''), route_id)
        || CASE WHEN route_long_name <> '' THEN ' · ' || route_long_name ELSE '' END AS label
    FROM fx_routes
    """,
)
def _(t):
    return shaping.route_labels(t["routes"])


@check(
    "map_markers",
    "PST7",
    """
    SELECT vehicle_id, coalesce(route_short_name, 'Unknown') AS route_short_name,
        coalesce(trip_id, 'Unknown') AS trip_id,
        coalesce(trip_headsign, 'Unknown') AS trip_headsign,
        coalesce(source_age_seconds, -1) AS source_age_seconds, latitude, longitude,
        coalesce(source_age_seconds || ' seconds', 'Unknown') AS age_label,
        CASE occupancy_status WHEN 'MANY_SEATS_AVAILABLE' THEN 'Many seats available'
            WHEN 'FULL' THEN 'Full' ELSE 'Unknown' END AS occupancy_label
    FROM latest_state
    """,
)
def _(t):
    return shaping.map_markers(vehicles(t))


@check(
    "alert_scopes",
    "PST7",
    """
    SELECT alert_id, CASE WHEN len(route_ids) > 0 THEN array_to_string(route_ids, ', ')
        ELSE 'Route not specified' END AS scope
    FROM alert_snapshot
    """,
)
def _(t):
    return alerts(t).select("alert_id", text.scope_label(F.col("route_ids")).alias("scope"))


@check(
    "map_centre",
    "PST8",
    """
    SELECT median(latitude) AS latitude, median(longitude) AS longitude
    FROM (SELECT * FROM live_vehicles
          ORDER BY event_timestamp DESC NULLS FIRST, vehicle_id LIMIT 2000)
    """,
)
def _(t):
    newest = [F.col("event_timestamp").desc_nulls_first(), F.col("vehicle_id").asc()]
    return shaping.map_centre(shaping.page(serving.live_vehicles(vehicles(t)), 2000, *newest))


_MINUTE = "strftime({value}, '%Y-%m-%d %H:%M')"


@check(
    "sample_lines",
    "PST9",
    f"""
    SELECT {_MINUTE.format(value="observation_local_timestamp")} AS observed,
        coalesce(route_short_name, route_id) AS route,
        CASE WHEN direction_id = -1 THEN 'Unknown' ELSE cast(direction_id as varchar) END
            AS direction,
        trip_id AS trip, stop_name AS next_stop, delay_basis AS basis,
        {_MINUTE.format(value=oracle.local("scheduled_prediction_timestamp"))} AS scheduled,
        {_MINUTE.format(value=oracle.local("delay_prediction_timestamp"))} AS predicted,
        round_even(predicted_delay_seconds / 60.0e0 * 10, 0) / 10 AS offset_minutes
    FROM newest_samples
    """,
)
def _(t):
    return shaping.sample_lines(serving.trip_samples(samples(t), SINCE))
