"""Derived tables, from staged events and the static schedule.

``tables`` maps the names of ``sources.tables.STAGED`` to DataFrames. Enriching
joins keep every row and add none, so anything that narrows the rows (newest
position, sampled stop, newest alert snapshot) is done before them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions.numbers import minutes_of_decile, minutes_of_mean, percentage
from stopwise.functions.periods import active_at
from stopwise.functions.times import age_seconds, local_date, moment, to_local, within_seconds
from stopwise.operators import enrich, flatten, latest, sampling
from stopwise.settings import DEFAULTS, UNKNOWN_DIRECTION, Settings
from stopwise.sources.tables import read_table, replace_table

Tables = Mapping[str, DataFrame]


def trip_stop_schedule(tables: Tables) -> DataFrame:
    return enrich.trip_stop_schedule(
        tables["stop_times"], tables["trips"], tables["routes"], tables["stops"]
    )


def enriched_positions(tables: Tables, positions: DataFrame | None = None) -> DataFrame:
    rows = tables["vehicle_positions"] if positions is None else positions
    return enrich.vehicle_positions(rows, tables["trips"], tables["routes"])


def enriched_stop_updates(tables: Tables, updates: DataFrame | None = None) -> DataFrame:
    rows = tables["trip_stop_updates"] if updates is None else updates
    return enrich.stop_updates(rows, trip_stop_schedule(tables), tables["routes"], tables["stops"])


def enriched_alerts(tables: Tables, alerts: DataFrame | None = None) -> DataFrame:
    rows = tables["service_alert_entities"] if alerts is None else alerts
    return enrich.alert_entities(rows, tables["trips"], tables["routes"], tables["stops"])


def alert_periods(tables: Tables) -> DataFrame:
    return flatten.alert_period_rows(enriched_alerts(tables))


def dim_routes(tables: Tables) -> DataFrame:
    return tables["routes"].select(
        "route_id",
        "agency_id",
        "route_short_name",
        "route_long_name",
        "route_desc",
        "route_type",
        "route_color",
        "route_text_color",
        "route_url",
        "route_sort_order",
        "route_fare_class",
        "line_id",
        "listed_route",
        "network_id",
    )


def dim_stops(tables: Tables) -> DataFrame:
    return tables["stops"].select(
        "stop_id",
        "stop_code",
        "stop_name",
        "stop_desc",
        "platform_name",
        "zone_id",
        "stop_address",
        "stop_url",
        "level_id",
        "municipality",
        "on_street",
        "at_street",
        "vehicle_type",
        "stop_lat",
        "stop_lon",
        "location_type",
        "parent_station",
        "wheelchair_boarding",
        "platform_code",
    )


def dim_dates(tables: Tables, settings: Settings = DEFAULTS) -> DataFrame:
    """Every day from the first to the last one any schedule or event covers."""
    bounds = tables["calendar"].agg(F.min("start_date").alias("a"), F.max("end_date").alias("b"))
    for name in ("vehicle_positions", "trip_stop_updates", "service_alert_entities"):
        # The local date never decreases with time, so the bounds are taken first.
        ends = tables[name].agg(F.min("event_timestamp").alias("a"), F.max("event_timestamp").alias("b"))
        bounds = bounds.unionByName(
            ends.select(*[local_date(F.col(c), settings.timezone).alias(c) for c in "ab"])
        )
    day = F.col("date_day")
    days = bounds.agg(F.min("a").alias("a"), F.max("b").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )
    weekday = F.weekday(day) + 1
    return days.select(
        day,
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_number"),
        weekday.alias("iso_day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )


def trip_monitoring_samples(tables: Tables, settings: Settings = DEFAULTS) -> DataFrame:
    """One sampled trip per observation bucket, with its predicted delay."""
    sampled = sampling.next_stops(sampling.upcoming_stops(tables["trip_stop_updates"], settings))
    samples = sampling.with_predicted_delay(
        sampling.with_delay_basis(enriched_stop_updates(tables, sampled)), settings
    )
    local = to_local(F.col("observation_bucket"), settings.timezone)
    return samples.select(
        "observation_bucket",
        local.alias("observation_local_timestamp"),
        F.to_date(local).alias("observation_local_date"),
        "event_id",
        "event_timestamp",
        "feed_timestamp",
        "ingested_at",
        "trip_id",
        "start_date",
        "start_time",
        "trip_instance_key",
        F.col("resolved_route_id").alias("route_id"),
        F.coalesce("direction_id", "scheduled_direction_id", F.lit(UNKNOWN_DIRECTION)).alias(
            "direction_id"
        ),
        "vehicle_id",
        "stop_id",
        "stop_sequence",
        "stop_name",
        "stop_lat",
        "stop_lon",
        "route_short_name",
        "route_long_name",
        "route_type",
        "route_color",
        "service_id",
        "trip_headsign",
        "predicted_arrival",
        "predicted_departure",
        "next_prediction_timestamp",
        "scheduled_arrival_time",
        "scheduled_departure_time",
        "scheduled_prediction_timestamp",
        "delay_prediction_timestamp",
        "delay_basis",
        F.col("delay_seconds").alias("raw_feed_delay_seconds"),
        "predicted_delay_seconds",
        "predicted_lateness_seconds",
        "is_predicted_late",
        "has_gtfs_schedule_match",
        "has_gtfs_route_match",
        "has_gtfs_stop_match",
        "trip_schedule_relationship",
        "stop_schedule_relationship",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
    )


def lateness() -> Column:
    """Delay with early running counted as on time; null while unknown."""
    delay = F.col("predicted_delay_seconds")
    return F.when(delay.isNotNull(), F.greatest(delay, F.lit(0)))


def lateness_decile() -> Column:
    """Exact 90th percentile of lateness in seconds.

    The state is a count per distinct whole second, at most half a day of
    them, so it stays small however many samples a group has.
    """
    return F.percentile(lateness(), F.lit(0.9))


def eligible() -> Column:
    return F.count("predicted_delay_seconds")


def route_health(samples: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Counts, rates and lateness per bucket, route and direction of one route type."""
    late = F.count_if(F.col("predicted_delay_seconds") > settings.late_threshold_seconds)
    grouped = (
        samples.where(F.col("route_id").isNotNull() & (F.col("route_type") == settings.route_type))
        .groupBy(
            "observation_bucket",
            "observation_local_timestamp",
            "observation_local_date",
            "route_id",
            "direction_id",
        )
        .agg(
            *[
                F.max(name).alias(name)
                for name in ("route_short_name", "route_long_name", "route_type", "route_color")
            ],
            F.count("*").alias("observed_trip_count"),
            eligible().alias("eligible_trip_count"),
            late.alias("late_trip_count"),
            F.countDistinct("vehicle_id").alias("observed_vehicle_count"),
            F.count_if("has_gtfs_schedule_match").alias("gtfs_schedule_match_count"),
            F.sum(lateness()).alias("_lateness"),
            lateness_decile().alias("_decile"),
        )
    )
    observed, known, late_count = (
        F.col("observed_trip_count"),
        F.col("eligible_trip_count"),
        F.col("late_trip_count"),
    )
    return grouped.select(
        *[name for name in grouped.columns if not name.startswith("_")],
        percentage(known, observed, 2).alias("metric_coverage_percentage"),
        percentage(late_count, known, 2).alias("predicted_late_percentage"),
        minutes_of_mean(F.col("_lateness"), known).alias("average_predicted_lateness_minutes"),
        minutes_of_decile(F.col("_decile"), 2).alias("p90_predicted_lateness_minutes"),
    )


def vehicle_latest_state(tables: Tables, as_of=None, settings: Settings = DEFAULTS) -> DataFrame:
    """Latest position of each vehicle, its age and freshness at ``as_of``."""
    now, seen = moment(as_of), F.col("event_timestamp")
    newest = enriched_positions(tables, latest.newest_positions(tables["vehicle_positions"]))
    return newest.select(
        "event_id",
        "vehicle_id",
        "event_timestamp",
        to_local(seen, settings.timezone).alias("event_local_timestamp"),
        "feed_timestamp",
        "ingested_at",
        "published_at",
        F.col("resolved_route_id").alias("route_id"),
        "route_short_name",
        "route_long_name",
        "route_type",
        "route_color",
        "trip_id",
        "service_id",
        "trip_headsign",
        F.col("gtfs_direction_id").alias("direction_id"),
        "latitude",
        "longitude",
        "bearing",
        "speed_mps",
        "odometer",
        "occupancy_status",
        "has_gtfs_trip_match",
        "has_gtfs_route_match",
        age_seconds(seen, now).alias("source_age_seconds"),
        within_seconds(seen, now, settings.vehicle_freshness_seconds).alias("is_fresh"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
    )


def newest_alert_entities(alerts: DataFrame) -> DataFrame:
    """Entities of the newest stored snapshot.

    The newest time is one value, known before the entities are read, so the
    second scan skips all files and row groups of older snapshots.
    """
    newest = alerts.agg(F.max("feed_timestamp")).first()[0]
    return alerts.where(F.col("feed_timestamp") == F.lit(newest))


def _distinct(column: str) -> Column:
    """Sorted distinct values; null-free, empty rather than null."""
    return F.array_sort(F.collect_set(column)).alias(f"{column}s")


def service_alerts_latest_snapshot(
    tables: Tables, as_of=None, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per alert of the newest snapshot.

    Duplicates are removed map-side, so an alert collects its distinct ids only.
    """
    now, seen = moment(as_of), F.col("feed_timestamp")
    entities = enriched_alerts(tables, newest_alert_entities(tables["service_alert_entities"]))
    newest = [
        "event_timestamp",
        "feed_timestamp",
        "ingested_at",
        "cause",
        "effect",
        "severity",
        "header_text",
        "description_text",
        "url",
    ]
    grouped = (
        entities.withColumn("_active", active_at(flatten.periods_of(), now))
        .groupBy("alert_id")
        .agg(
            *[F.max(name).alias(name) for name in newest],
            F.count("*").alias("informed_entity_count"),
            F.array_sort(F.collect_set("resolved_route_id")).alias("route_ids"),
            _distinct("stop_id"),
            _distinct("trip_id"),
            _distinct("direction_id"),
            F.bool_or("_active").alias("is_display_active_now"),
        )
    )
    return grouped.select(
        "*",
        age_seconds(seen, now).alias("source_age_seconds"),
        within_seconds(seen, now, settings.alert_freshness_seconds).alias("is_feed_fresh"),
    )


def build(tables: Tables, target: str, settings: Settings = DEFAULTS) -> None:
    """Write the stored derived tables.

    Health is computed from the written samples, so they are sampled once. The
    two current-state tables depend on the time of reading and are not stored.
    """
    samples = f"{target}/fct_trip_monitoring_samples"
    replace_table(dim_routes(tables), f"{target}/dim_routes")
    replace_table(dim_stops(tables), f"{target}/dim_stops")
    replace_table(dim_dates(tables, settings), f"{target}/dim_dates")
    replace_table(
        trip_monitoring_samples(tables, settings), samples, ["observation_local_date"]
    )
    spark = tables["routes"].sparkSession
    health = route_health(read_table(spark, samples), settings)
    replace_table(health, f"{target}/route_health_5m", ["observation_local_date"])
