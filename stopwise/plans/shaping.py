"""Shaping of served results for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.functions import text
from stopwise.functions.numbers import nearest_tenth
from stopwise.functions.times import moment, to_local, within_seconds
from stopwise.settings import DEFAULTS, UNKNOWN_DIRECTION

# Minutes after which a source counts as stale.
VEHICLE_MINUTES = 1.5
ALERT_MINUTES = 10
SAMPLE_MINUTES = 15

ALL_SEVERITIES = "All severities"
ALL_EFFECTS = "All effects"


def gap_filled(trend: DataFrame, minutes: int = DEFAULTS.bucket_minutes) -> DataFrame:
    """A row for every bucket between the first and the last; new ones are null."""
    ends = trend.agg(
        F.min("observation_bucket").alias("first"), F.max("observation_bucket").alias("last")
    )
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    buckets = ends.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", step)).alias("observation_bucket")
    )
    return buckets.join(trend, "observation_bucket", "left").withColumn(
        "local_time", to_local(F.col("observation_bucket"), DEFAULTS.timezone)
    )


def reliability_summary(trend: DataFrame) -> DataFrame:
    """Totals and rates of a trend; null for an empty one."""
    totals = trend.agg(
        F.sum("observed_trip_count").alias("observed"),
        F.sum("eligible_trip_count").alias("eligible"),
        F.sum("late_trip_count").alias("late"),
    )
    return totals.select(
        "*",
        nearest_tenth(_rate("late", "eligible")).alias("late_percentage"),
        nearest_tenth(_rate("eligible", "observed")).alias("coverage_percentage"),
    )


def _rate(part: str, whole: str) -> Column:
    return F.col(part) * 100 / F.nullif(F.col(whole), F.lit(0))


def comparable(
    value: Column, current_samples: Column, previous_samples: Column, minimum: int
) -> Column:
    """An earlier value, if both periods have enough samples."""
    return F.when((current_samples >= minimum) & (previous_samples >= minimum), value)


def change(current: Column, previous: Column) -> Column:
    """Difference to one decimal; null unless both exist."""
    return F.round(current - previous, 1)


def period_changes(current: DataFrame, previous: DataFrame, minimum: int) -> DataFrame:
    """Change of the rates of two period summaries (one row each)."""
    now = current.select(F.lit(1).alias("_one"), F.struct("*").alias("now"))
    before = previous.select(F.lit(1).alias("_one"), F.struct("*").alias("before"))
    samples = (F.col("now.eligible_trip_count"), F.col("before.eligible_trip_count"))
    names = (
        "predicted_late_percentage",
        "metric_coverage_percentage",
        "p90_predicted_lateness_minutes",
    )
    return now.join(before, "_one").select(
        *[
            change(
                F.col(f"now.{name}"), comparable(F.col(f"before.{name}"), *samples, minimum)
            ).alias(f"{name}_change")
            for name in names
        ]
    )


def source_status(observed_at: Column, max_minutes: float, as_of=None) -> Column:
    """``missing``, ``stale`` or ``fresh``."""
    return (
        F.when(observed_at.isNull(), F.lit("missing"))
        .when(within_seconds(observed_at, moment(as_of), max_minutes * 60), F.lit("fresh"))
        .otherwise(F.lit("stale"))
    )


def filtered_alerts(
    alerts: DataFrame, severity: str = ALL_SEVERITIES, effect: str = ALL_EFFECTS
) -> DataFrame:
    """Alerts of a severity and effect; an absent one is ``Unknown``."""
    for column, wanted, everything in (
        ("severity", severity, ALL_SEVERITIES),
        ("effect", effect, ALL_EFFECTS),
    ):
        if wanted != everything:
            alerts = alerts.where(F.coalesce(column, F.lit("Unknown")) == F.lit(wanted))
    return alerts


def found_vehicles(vehicles: DataFrame, search: str) -> DataFrame:
    """Vehicles whose id contains a text; a blank search finds all."""
    if not search.strip():
        return vehicles
    return vehicles.where(text.contains_ignoring_case(F.col("vehicle_id"), search))


def most_late_routes(comparison: DataFrame, limit: int = 10) -> DataFrame:
    """Routes with the highest late rates, larger ones first among equals."""
    return comparison.orderBy(
        F.col("predicted_late_percentage").desc_nulls_last(),
        F.col("eligible_trip_count").desc_nulls_last(),
        "route_id",
    ).limit(limit)


def page(rows: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first rows and whether there were more.

    At most ``limit + 1`` rows reach the window, so one task can hold them.
    """
    first = rows.orderBy(*order).limit(limit + 1)
    one = Window.partitionBy(F.lit(0))
    counted = first.withColumns(
        {
            "is_truncated": F.count("*").over(one) > limit,
            "_place": F.row_number().over(one.orderBy(*order)),
        }
    )
    return counted.where(F.col("_place") <= limit).drop("_place")


def map_centre(vehicles: DataFrame) -> DataFrame:
    """Median position of vehicles that have one.

    Served for at most one page of live vehicles, so the exact median is cheap.
    """
    placed = vehicles.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return placed.agg(
        F.median("latitude").alias("latitude"), F.median("longitude").alias("longitude")
    )


def map_markers(vehicles: DataFrame) -> DataFrame:
    """Marker texts of vehicles that have a position."""
    placed = vehicles.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return placed.select(
        "vehicle_id",
        *[
            F.coalesce(name, F.lit("Unknown")).alias(name)
            for name in ("route_short_name", "trip_id", "trip_headsign")
        ],
        F.coalesce("source_age_seconds", F.lit(-1)).alias("source_age_seconds"),
        "latitude",
        "longitude",
        text.age_label(F.col("source_age_seconds")).alias("age_label"),
        text.occupancy_label(F.col("occupancy_status")).alias("occupancy_label"),
    )


def route_labels(routes: DataFrame) -> DataFrame:
    return routes.select(
        "route_id",
        text.route_label(
            F.col("route_id"), F.col("route_short_name"), F.col("route_long_name")
        ).alias("label"),
    )


def _minute(local: Column) -> Column:
    return F.date_format(local, "yyyy-MM-dd HH:mm")


def sample_lines(samples: DataFrame, zone: str = DEFAULTS.timezone) -> DataFrame:
    """Trip samples as display texts, in local time."""
    direction = F.when(
        F.col("direction_id") == UNKNOWN_DIRECTION, F.lit("Unknown")
    ).otherwise(F.col("direction_id").cast("string"))
    return samples.select(
        _minute(F.col("observation_local_timestamp")).alias("observed"),
        F.coalesce("route_short_name", "route_id").alias("route"),
        direction.alias("direction"),
        F.col("trip_id").alias("trip"),
        F.col("stop_name").alias("next_stop"),
        F.col("delay_basis").alias("basis"),
        _minute(to_local(F.col("scheduled_prediction_timestamp"), zone)).alias("scheduled"),
        _minute(to_local(F.col("delay_prediction_timestamp"), zone)).alias("predicted"),
        (F.rint(F.col("predicted_delay_seconds") / 60 * 10) / 10).alias("offset_minutes"),
    )
