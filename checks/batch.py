"""Checks of scans, joins, sampling, delays, derived tables and data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracle
from checks.projections import AS_OF, Staged, driver_table
from checks.registry import SETTINGS, check
from stopwise.functions import numbers, periods, times
from stopwise.operators import (
    constraints,
    enrich,
    expectations,
    flatten,
    integrity,
    latest,
    sampling,
)
from stopwise.plans import marts
from stopwise.session import shared_folder
from stopwise.sources import static_feed, tables

SAMPLE_DATES = ("observation_local_date", "start_date")


def samples(t: Staged) -> DataFrame:
    return marts.trip_monitoring_samples(t, SETTINGS)


def health(t: Staged) -> DataFrame:
    return marts.route_health(samples(t), SETTINGS)


# Scans, reads and writes -------------------------------------------------


@check("staged_stop_times", "SRC4", "SELECT * FROM fx_stop_times")
def _(t):
    return t["stop_times"]


@check(
    "staged_row_counts",
    "SRC4 REF8 SET1",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM fx_{name}"
        for name in tables.STAGED
    ),
)
def _(t):
    return integrity.row_counts({name: t[name] for name in tables.STAGED})


@check(
    "parameterised_read",
    "SRC5",
    """
    SELECT vehicle_id, count(*) AS positions, max(event_timestamp) AS latest_event_at
    FROM fx_vehicle_positions
    WHERE event_timestamp >= TIMESTAMP '2024-01-10 00:00:00' AND route_id = '7'
    GROUP BY vehicle_id
    """,
)
def _(t):
    return tables.read_query(
        t.spark,
        """
        SELECT vehicle_id, count(*) AS positions, max(event_timestamp) AS latest_event_at
        FROM {positions} WHERE event_timestamp >= to_timestamp(:since) AND route_id = :route
        GROUP BY vehicle_id
        """,
        {"since": "2024-01-10 00:00:00", "route": "7"},
        positions=t["vehicle_positions"],
    )


@check("replaced_table", "SNK6", "SELECT * FROM health", dates=["observation_local_date"])
def _(t):
    spark = t.spark
    path = f"{shared_folder(spark)}/replaced/{t.run_name}/route_health_5m"
    tables.replace_table(health(t), path, ["observation_local_date"])
    return tables.read_table(spark, path)


@check(
    "replaced_by_less",
    "SNK6",
    "SELECT * FROM health WHERE direction_id = 0",
    dates=["observation_local_date"],
)
def _(t):
    """A smaller table in place of a larger one, under dynamic overwrite."""
    spark = t.spark
    path = f"{shared_folder(spark)}/replaced/{t.run_name}/smaller"
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows = health(t)
        tables.replace_table(rows, path, ["observation_local_date"])
        tables.replace_table(rows.where("direction_id = 0"), path, ["observation_local_date"])
    finally:
        spark.conf.set(setting, before)
    return tables.read_table(spark, path)


# Joins -------------------------------------------------------------------


@check("trip_stop_schedule", "JN1", "SELECT * FROM schedule")
def _(t):
    return marts.trip_stop_schedule(t)


@check("vehicle_positions_enriched", "JN2", "SELECT * FROM positions")
def _(t):
    return marts.enriched_positions(t)


@check("trip_stop_updates_enriched", "JN3", "SELECT * FROM updates", dates=["start_date"])
def _(t):
    return marts.enriched_stop_updates(t)


@check("service_alert_entities_enriched", "JN4", "SELECT * FROM alerts")
def _(t):
    return marts.enriched_alerts(t)


@check(
    "latest_alert_entities",
    "JN5",
    """
    SELECT * FROM fx_service_alert_entities
    WHERE feed_timestamp = (SELECT max(feed_timestamp) FROM fx_service_alert_entities)
    """,
)
def _(t):
    return marts.newest_alert_entities(t["service_alert_entities"])


@check("service_alert_periods", "FLT4 JN6", "SELECT * FROM periods")
def _(t):
    return marts.alert_periods(t)


@check(
    "alert_entities_active_now",
    "JN11 AGG12",
    """
    SELECT e.event_id, e.informed_entity_index, coalesce(o.open, true) AS is_active
    FROM fx_service_alert_entities e LEFT JOIN open_items o
        ON o.event_id = e.event_id AND o.informed_entity_index = e.informed_entity_index
    """,
)
def _(t):
    active = periods.active_at(flatten.periods_of(), times.moment(AS_OF))
    return t["service_alert_entities"].select(
        "event_id", "informed_entity_index", active.alias("is_active")
    )


@check(
    "orphaned_parent_stations",
    "JN8",
    """
    SELECT s.parent_station AS value, count(*) AS row_count FROM fx_stops s
    WHERE s.parent_station <> ''
        AND NOT EXISTS (SELECT 1 FROM fx_stops p WHERE p.stop_id = s.parent_station)
    GROUP BY s.parent_station
    """,
)
def _(t):
    nested = t["stops"].where("parent_station <> ''")
    return integrity.orphans(nested, "parent_station", t["stops"], "stop_id")


# Windows and sampling ----------------------------------------------------


@check(
    "observation_buckets",
    "WIN1",
    f"""
    SELECT event_id, {oracle.bucket("event_timestamp", 5)} AS bucket_5m,
        {oracle.bucket("event_timestamp", 7)} AS bucket_7m
    FROM fx_vehicle_positions
    """,
)
def _(t):
    seen = F.col("event_timestamp")
    return t["vehicle_positions"].select(
        "event_id",
        times.bucket_start(seen, 5).alias("bucket_5m"),
        times.bucket_start(seen, 7).alias("bucket_7m"),
    )


@check(
    "trip_instance_keys",
    "WIN2",
    """
    SELECT event_id, stop_update_index, trip_id || '|'
        || coalesce(strftime(start_date, '%Y%m%d'), 'unknown-date') || '|'
        || coalesce(start_time, 'scheduled') AS trip_instance_key
    FROM fx_trip_stop_updates
    """,
)
def _(t):
    key = sampling.trip_instance_key().alias("trip_instance_key")
    return t["trip_stop_updates"].select("event_id", "stop_update_index", key)


@check(
    "upcoming_stop_predictions",
    "WIN3",
    """
    SELECT u.event_id AS event_id, u.stop_update_index AS stop_update_index,
        slot AS observation_bucket, due AS next_prediction_timestamp FROM ahead
    """,
)
def _(t):
    return sampling.upcoming_stops(t["trip_stop_updates"], SETTINGS).select(
        "event_id", "stop_update_index", "observation_bucket", "next_prediction_timestamp"
    )


@check(
    "newest_event_stops",
    "WIN4",
    """
    SELECT a.u.event_id AS event_id, a.u.stop_update_index AS stop_update_index,
        a.slot AS observation_bucket, a.trip AS trip_instance_key
    FROM ahead a JOIN newest_events n
        ON n.slot = a.slot AND n.trip = a.trip
        AND n.newest.seen = a.seen AND n.newest.event = a.event
    """,
)
def _(t):
    upcoming = sampling.upcoming_stops(t["trip_stop_updates"], SETTINGS)
    return sampling.newest_event_stops(upcoming).select(
        "event_id", "stop_update_index", "observation_bucket", "trip_instance_key"
    )


@check(
    "next_stops",
    "WIN5",
    """
    SELECT first_stop.u.event_id AS event_id, first_stop.u.stop_update_index AS stop_update_index,
        slot AS observation_bucket, trip AS trip_instance_key,
        first_stop.u.stop_sequence AS stop_sequence, first_stop.due AS next_prediction_timestamp
    FROM picked
    """,
)
def _(t):
    return sampling.next_stops(sampling.upcoming_stops(t["trip_stop_updates"], SETTINGS)).select(
        *"event_id stop_update_index observation_bucket trip_instance_key".split(),
        *"stop_sequence next_prediction_timestamp".split(),
    )


@check(
    "latest_vehicle_positions",
    "WIN6",
    """
    SELECT * FROM fx_vehicle_positions
    QUALIFY row_number() OVER (PARTITION BY vehicle_id
        ORDER BY event_timestamp DESC, ingested_at DESC, event_id DESC) = 1
    """,
)
def _(t):
    return latest.newest_positions(t["vehicle_positions"])


@check(
    "latest_vehicle_positions_aggregated",
    "WIN6",
    """
    SELECT vehicle_id, max(event_timestamp) AS event_timestamp,
        arg_max(event_id, event_timestamp) AS event_id
    FROM fx_vehicle_positions GROUP BY vehicle_id
    """,
)
def _(t):
    order = F.struct("event_timestamp", "ingested_at", "event_id")
    newest = latest.last_values(t["vehicle_positions"], ["vehicle_id"], order)
    return newest.select("vehicle_id", "event_timestamp", "event_id")


# Delay -------------------------------------------------------------------


def _sampled(t: Staged) -> DataFrame:
    upcoming = sampling.upcoming_stops(t["trip_stop_updates"], SETTINGS)
    return marts.enriched_stop_updates(t, sampling.next_stops(upcoming))


@check(
    "delay_basis",
    "AGG1",
    """
    SELECT u.event_id AS event_id, u.stop_update_index AS stop_update_index,
        way.basis AS delay_basis, way.said AS delay_prediction_timestamp,
        way.clock AS scheduled_time_text
    FROM compared
    """,
)
def _(t):
    return sampling.with_delay_basis(_sampled(t)).select(
        *"event_id stop_update_index delay_basis delay_prediction_timestamp".split(),
        "scheduled_time_text",
    )


@check(
    "service_day_seconds",
    "AGG2",
    """
    SELECT trip_id, stop_sequence, cast(split_part(arrival_time, ':', 1) as int) * 3600
        + cast(split_part(arrival_time, ':', 2) as int) * 60
        + cast(split_part(arrival_time, ':', 3) as int) AS arrival_second
    FROM fx_stop_times
    """,
)
def _(t):
    second = times.service_seconds(F.col("arrival_time")).alias("arrival_second")
    return t["stop_times"].select("trip_id", "stop_sequence", second)


@check(
    "scheduled_instants",
    "AGG3",
    """
    SELECT event_id, stop_update_index, scheduled_prediction_timestamp FROM delayed
    """,
)
def _(t):
    timed = sampling.with_predicted_delay(sampling.with_delay_basis(_sampled(t)), SETTINGS)
    return timed.select("event_id", "stop_update_index", "scheduled_prediction_timestamp")


@check(
    "predicted_delays",
    "AGG4",
    """
    SELECT event_id, stop_update_index, predicted_delay_seconds, predicted_lateness_seconds,
        is_predicted_late
    FROM (SELECT *, CASE WHEN predicted_delay_seconds < 0 THEN 0 ELSE predicted_delay_seconds END
        AS predicted_lateness_seconds, predicted_delay_seconds > 300 AS is_predicted_late
        FROM delayed) q
    """,
)
def _(t):
    timed = sampling.with_predicted_delay(sampling.with_delay_basis(_sampled(t)), SETTINGS)
    return timed.select(
        *"event_id stop_update_index predicted_delay_seconds".split(),
        *"predicted_lateness_seconds is_predicted_late".split(),
    )


# Derived tables ----------------------------------------------------------


@check("trip_monitoring_samples", "AGG5", "SELECT * FROM samples", dates=SAMPLE_DATES)
def _(t):
    return samples(t)


@check("route_health", "AGG6", "SELECT * FROM health", dates=["observation_local_date"])
def _(t):
    return health(t)


@check(
    "samples_by_condition",
    "AGG7",
    """
    SELECT route_type, count(*) AS sample_count, count(*) FILTER (delay_basis = 'arrival') AS arrivals,
        count(*) FILTER (is_predicted_late) AS late_samples,
        count(predicted_delay_seconds) AS eligible_samples
    FROM samples GROUP BY route_type
    """,
)
def _(t):
    return (
        samples(t)
        .groupBy("route_type")
        .agg(
            F.count("*").alias("sample_count"),
            F.count_if(F.col("delay_basis") == "arrival").alias("arrivals"),
            F.count_if("is_predicted_late").alias("late_samples"),
            F.count("predicted_delay_seconds").alias("eligible_samples"),
        )
    )


@check(
    "late_share_by_vehicle",
    "AGG8",
    f"""
    SELECT vehicle_id, {oracle.rate("count(*) FILTER (is_predicted_late)",
        "count(predicted_delay_seconds)", 2)} AS late_percentage
    FROM samples GROUP BY vehicle_id
    """,
)
def _(t):
    late = F.count_if("is_predicted_late")
    share = numbers.percentage(late, marts.eligible(), 2).alias("late_percentage")
    return samples(t).groupBy("vehicle_id").agg(share)


@check(
    "late_share_of_sums",
    "AGG9",
    f"""
    SELECT route_id, {oracle.rate("cast(sum(late_trip_count) as bigint)",
        "cast(sum(eligible_trip_count) as bigint)", 1)} AS late_percentage
    FROM health GROUP BY route_id
    """,
)
def _(t):
    share = numbers.percentage(F.sum("late_trip_count"), F.sum("eligible_trip_count"), 1)
    return health(t).groupBy("route_id").agg(share.alias("late_percentage"))


@check(
    "lateness_deciles",
    "AGG10",
    f"""
    SELECT trip_id, {oracle.decile("predicted_lateness_seconds", 2)} AS p90_minutes
    FROM samples GROUP BY trip_id
    """,
)
def _(t):
    decile = numbers.minutes_of_decile(marts.lateness_decile(), 2)
    return samples(t).groupBy("trip_id").agg(decile.alias("p90_minutes"))


_LISTS = ("route_ids", "stop_ids", "trip_ids", "direction_ids")


@check("service_alerts_snapshot", "AGG11", "SELECT * FROM alert_snapshot", lists=_LISTS)
def _(t):
    return marts.service_alerts_latest_snapshot(t, AS_OF, SETTINGS)


@check("vehicle_latest_state", "WIN6 AGG13", "SELECT * FROM latest_state")
def _(t):
    return marts.vehicle_latest_state(t, AS_OF, SETTINGS)


@check(
    "position_ages",
    "AGG13",
    f"""
    SELECT event_id, {oracle.age("event_timestamp")} AS age_seconds,
        {oracle.fresh("event_timestamp", 90)} AS is_fresh
    FROM fx_vehicle_positions
    """,
)
def _(t):
    now, seen = times.moment(AS_OF), F.col("event_timestamp")
    return t["vehicle_positions"].select(
        "event_id",
        times.age_seconds(seen, now).alias("age_seconds"),
        times.within_seconds(seen, now, 90).alias("is_fresh"),
    )


@check("dim_dates", "AGG15 SET1", "SELECT * FROM dates", dates=["date_day"])
def _(t):
    return marts.dim_dates(t)


@check(
    "date_bounds",
    "AGG14",
    "SELECT first_day, last_day, greatest(first_day, last_day) AS later_day FROM date_range",
    dates=["first_day", "last_day", "later_day"],
)
def _(t):
    ends = marts.dim_dates(t).agg(
        F.min("date_day").alias("first_day"), F.max("date_day").alias("last_day")
    )
    return ends.select("*", F.greatest("first_day", "last_day").alias("later_day"))


@check("dim_routes", "FLT5", "SELECT * FROM fx_routes")
def _(t):
    return marts.dim_routes(t)


@check("dim_stops", "FLT5", "SELECT * FROM fx_stops")
def _(t):
    return marts.dim_stops(t)


# Static schedule ---------------------------------------------------------


@check(
    "broken_references",
    "REF7 SET2 JN8",
    """
    SELECT 'trips.route_id' AS reference, route_id AS value, count(*) AS row_count
    FROM fx_trips WHERE route_id NOT IN (SELECT route_id FROM fx_routes) GROUP BY route_id
    UNION ALL SELECT 'stop_times.trip_id', trip_id, count(*)
    FROM fx_stop_times WHERE trip_id NOT IN (SELECT trip_id FROM fx_trips) GROUP BY trip_id
    UNION ALL SELECT 'stop_times.stop_id', stop_id, count(*)
    FROM fx_stop_times WHERE stop_id NOT IN (SELECT stop_id FROM fx_stops) GROUP BY stop_id
    UNION ALL SELECT 'trips.service_id', service_id, count(*)
    FROM fx_trips WHERE service_id NOT IN (SELECT service_id FROM fx_calendar UNION
        SELECT service_id FROM fx_calendar_dates WHERE exception_type = 1) GROUP BY service_id
    UNION ALL SELECT 'stops.parent_station', parent_station, count(*)
    FROM fx_stops WHERE parent_station <> ''
        AND parent_station NOT IN (SELECT stop_id FROM fx_stops) GROUP BY parent_station
    """,
)
def _(t):
    names = ("routes", "stops", "trips", "stop_times", "calendar", "calendar_dates")
    return integrity.broken_references({name: t[name] for name in names})


@check(
    "active_services",
    "SET2",
    """
    SELECT service_id FROM fx_calendar
    UNION SELECT service_id FROM fx_calendar_dates WHERE exception_type = 1
    """,
)
def _(t):
    return integrity.active_services(t["calendar"], t["calendar_dates"])


@check(
    "content_digests",
    "REF4",
    """
    SELECT doc_id, sha256(text) AS sha256,
        CASE WHEN doc_id % 3 = 0 THEN 'loaded' ELSE 'unchanged' END AS status
    FROM documents
    """,
)
def _(t):
    documents = driver_table(t.spark, t.folder, "documents")
    digests = documents.select(
        F.col("doc_id").alias("feed"), static_feed.content_digest(F.col("text")).alias("sha256")
    )
    # What was loaded before: every third document has changed since.
    earlier = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("."))).otherwise(
        F.col("text")
    )
    state = documents.select(
        F.col("doc_id").alias("feed"), static_feed.content_digest(earlier).alias("sha256")
    )
    return static_feed.with_outcome(digests, state).withColumnRenamed("feed", "doc_id")


# Constraints -------------------------------------------------------------


@check(
    "broken_constraints",
    "DQ12",
    """
    SELECT 'vehicle_positions' AS table_name, c AS constraint_name,
        count(*) FILTER (bad) AS broken_rows
    FROM (
        SELECT unnest(['event_id', 'vehicle_id', 'event_timestamp', 'feed_timestamp',
            'published_at', 'ingested_at', 'latitude', 'longitude', 'source', 'schema_version',
            'kafka_topic', 'kafka_partition', 'kafka_offset', 'kafka_timestamp']) || ' present' AS c,
            unnest([event_id IS NULL, vehicle_id IS NULL, event_timestamp IS NULL,
            feed_timestamp IS NULL, published_at IS NULL, ingested_at IS NULL,
            latitude + 47.7 IS NULL, longitude IS NULL, source IS NULL, schema_version IS NULL,
            kafka_topic IS NULL, kafka_partition IS NULL, kafka_offset IS NULL,
            kafka_timestamp IS NULL]) AS bad FROM fx_vehicle_positions
        UNION ALL
        SELECT unnest(['latitude in range', 'longitude in range', 'bearing in range',
            'odometer not negative', 'speed not negative', 'schema version positive']),
            unnest([latitude + 47.7 > 90, longitude < -180, bearing > 360, odometer - 500 < 0,
            speed_mps < 0, schema_version <= 0]) FROM fx_vehicle_positions
    ) q GROUP BY c
    """,
)
def _(t):
    # Shifted so that some rows leave the allowed ranges.
    shifted = t["vehicle_positions"].withColumns(
        {"latitude": F.col("latitude") + 47.7, "odometer": F.col("odometer") - 500}
    )
    return constraints.constraint_violations(shifted, "vehicle_positions")


@check(
    "enforced_constraints",
    "DQ12",
    "SELECT * FROM fx_trip_stop_updates",
    dates=["start_date"],
)
def _(t):
    placed = F.col("stop_id").isNotNull()
    return constraints.enforced(t["trip_stop_updates"].where(placed), "trip_stop_updates")


# Data tests --------------------------------------------------------------


@check(
    "test_not_null",
    "TST1",
    "SELECT * FROM samples WHERE route_id IS NULL",
    dates=SAMPLE_DATES,
)
def _(t):
    return expectations.not_null(samples(t), "route_id")


@check(
    "test_unique",
    "TST1",
    """
    SELECT trip_id, count(*) AS row_count FROM samples
    WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1
    """,
)
def _(t):
    return expectations.unique(samples(t), "trip_id")


@check(
    "test_relationships",
    "TST2",
    """
    SELECT route_id AS value, count(*) AS row_count FROM samples
    WHERE route_id NOT IN (SELECT route_id FROM fx_routes) GROUP BY route_id
    """,
)
def _(t):
    return expectations.relationships(samples(t), "route_id", t["routes"], "route_id")


@check(
    "test_accepted_values",
    "TST3",
    """
    SELECT delay_basis AS value, count(*) AS row_count FROM samples
    WHERE delay_basis <> 'arrival' GROUP BY delay_basis
    """,
)
def _(t):
    return expectations.accepted_values(samples(t), "delay_basis", ["arrival"])


@check(
    "test_grains",
    "TST4",
    """
    SELECT 'schedule by trip' AS model_name, trip_id AS grain_key, count(*) AS row_count
    FROM schedule GROUP BY trip_id HAVING count(*) > 1
    UNION ALL SELECT 'samples by trip and basis',
        trip_id || ':' || coalesce(delay_basis, 'none'), count(*)
    FROM samples GROUP BY trip_id, delay_basis HAVING count(*) > 1
    """,
)
def _(t):
    # The declared grains hold (and add no row); two coarser ones do not.
    sampled = samples(t)
    return expectations.duplicate_grains(
        {
            "schedule": (marts.trip_stop_schedule(t), ["trip_id", "stop_sequence"]),
            "positions": (marts.enriched_positions(t), ["event_id"]),
            "updates": (marts.enriched_stop_updates(t), ["event_id", "stop_update_index"]),
            "alerts": (marts.enriched_alerts(t), ["event_id", "informed_entity_index"]),
            "periods": (
                marts.alert_periods(t),
                ["event_id", "informed_entity_index", "active_period_index"],
            ),
            "samples": (sampled, ["observation_bucket", "trip_instance_key"]),
            "health": (health(t), ["observation_bucket", "route_id", "direction_id"]),
            "schedule by trip": (marts.trip_stop_schedule(t), ["trip_id"]),
            "samples by trip and basis": (sampled, ["trip_id", "delay_basis"]),
        }
    )


_PRESERVED = {
    "schedule": ("stop_times", marts.trip_stop_schedule),
    "positions": ("vehicle_positions", marts.enriched_positions),
    "updates": ("trip_stop_updates", marts.enriched_stop_updates),
    "alerts": ("service_alert_entities", marts.enriched_alerts),
}


@check(
    "test_row_preservation",
    "TST5",
    " UNION ALL ".join(
        f"SELECT '{name}' AS model_name, a.n AS expected_rows, b.n AS actual_rows "
        f"FROM (SELECT count(*) AS n FROM fx_{source}) a, (SELECT count(*) AS n FROM {name}) b"
        for name, (source, _) in _PRESERVED.items()
    ),
)
def _(t):
    return expectations.row_count_changes(
        {name: (t[source], plan(t)) for name, (source, plan) in _PRESERVED.items()}
    )


@check(
    "test_period_expansion",
    "TST6 JN10",
    """
    SELECT e.n AS expected_rows, a.n AS actual_rows
    FROM (SELECT cast(sum(greatest(json_array_length(active_periods), 1)) as bigint) AS n
        FROM fx_service_alert_entities) e
    CROSS JOIN (SELECT count(*) AS n FROM periods) a
    """,
)
def _(t):
    return expectations.period_row_counts(t["service_alert_entities"], marts.alert_periods(t))


@check("test_sample_invariants", "TST7", "SELECT * FROM samples WHERE false", dates=SAMPLE_DATES)
def _(t):
    return expectations.inconsistent_samples(samples(t))


@check(
    "test_sample_invariants_violated",
    "TST7",
    "SELECT event_id, trip_instance_key FROM samples "
    "WHERE predicted_delay_seconds IS NOT NULL AND direction_id = 1",
)
def _(t):
    # Samples of one direction lose their basis but keep their delay.
    basis = F.when(F.col("direction_id") != 1, F.col("delay_basis"))
    found = expectations.inconsistent_samples(samples(t).withColumn("delay_basis", basis))
    return found.select("event_id", "trip_instance_key")


@check(
    "test_health_bounds",
    "TST8",
    "SELECT * FROM health WHERE late_trip_count = 0 AND eligible_trip_count > 0",
    dates=["observation_local_date"],
)
def _(t):
    # The bounds hold; counting all eligible samples late, plus one, breaks them.
    late = F.when(
        (F.col("late_trip_count") == 0) & (F.col("eligible_trip_count") > 0),
        F.col("eligible_trip_count") + 1,
    ).otherwise(F.col("late_trip_count"))
    found = expectations.out_of_bounds_health(health(t).withColumn("late_trip_count", late))
    return found.withColumn("late_trip_count", F.lit(0).cast("bigint"))


@check(
    "test_health_scope",
    "TST8",
    "SELECT * FROM health WHERE false",
    dates=["observation_local_date"],
)
def _(t):
    return expectations.out_of_scope_health(health(t), SETTINGS.route_type)


@check(
    "test_health_recomputation",
    "TST8 JN9",
    f"""
    SELECT observation_bucket, route_id, direction_id, {", ".join(
        f"{m} AS actual_{m}, CASE WHEN late_trip_count <= 1 THEN {m} END AS expected_{m}"
        for m in expectations.HEALTH_MEASURES)}
    FROM health WHERE late_trip_count > 1
    """,
)
def _(t):
    # Expected rows of buckets with several late trips are missing.
    actual = health(t)
    expected = marts.route_health(samples(t), SETTINGS).where("late_trip_count <= 1")
    return expectations.differing_health(actual, expected)


@check(
    "test_alerts_are_latest",
    "TST9 JN10",
    "SELECT alert_id, feed_timestamp FROM alert_snapshot WHERE direction_ids = [1]",
)
def _(t):
    # Alerts of one direction are dated back by a day.
    back = F.when(
        F.to_json("direction_ids") == "[1]", F.col("feed_timestamp") - F.expr("INTERVAL 1 DAY")
    ).otherwise(F.col("feed_timestamp"))
    snapshot = marts.service_alerts_latest_snapshot(t, AS_OF, SETTINGS)
    found = expectations.outdated_alerts(
        snapshot.withColumn("feed_timestamp", back), t["service_alert_entities"]
    )
    restored = (F.col("feed_timestamp") + F.expr("INTERVAL 1 DAY")).alias("feed_timestamp")
    return found.select("alert_id", restored)


@check(
    "joined_on_composite_key",
    "JN3",
    """
    SELECT u.event_id, u.stop_update_index, s.arrival_time FROM fx_trip_stop_updates u
    LEFT JOIN fx_stop_times s ON s.trip_id = u.trip_id AND s.stop_sequence = u.stop_sequence
    """,
)
def _(t):
    u, s = t["trip_stop_updates"].alias("u"), t["stop_times"].alias("s")
    keys = [(F.col(f"u.{c}"), F.col(f"s.{c}")) for c in ("trip_id", "stop_sequence")]
    joined = enrich.left_join(u, s, keys, F.col("u.event_id"))
    return joined.select("u.event_id", "u.stop_update_index", "s.arrival_time")
