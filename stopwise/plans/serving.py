"""Queries served from the derived tables. A filter that is not given is not applied."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions.numbers import minutes_of_decile, percentage
from stopwise.functions.times import local_date, moment
from stopwise.plans.marts import lateness
from stopwise.settings import DEFAULTS

MAX_LIVE_ROWS = 2000
MAX_ATTENTION_ROWS = 50
MAX_SAMPLE_ROWS = 500


def check_limit(limit: int, most: int) -> None:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")


def matching(
    rows: DataFrame,
    *,
    since=None,
    until=None,
    route_id: str | None = None,
    direction_id: int | None = None,
    bucket=None,
    time_column: str = "observation_bucket",
) -> DataFrame:
    """Rows of a half-open time range, a route, a direction, a bucket - each if given.

    Where the rows have a local date, which is what stored tables are partitioned by, it
    is bounded as well. That drops no row: the local date never decreases with
    time, and a bucket begins at most a day before what it contains.
    """
    time = F.col(time_column)
    conditions: list[Column] = []
    if "observation_local_date" in rows.columns:
        conditions += _days(since, until, bucket, time_column)
    if since is not None:
        conditions.append(time >= moment(since))
    if until is not None:
        conditions.append(time < moment(until))
    if route_id is not None:
        conditions.append(F.col("route_id") == F.lit(route_id))
    if direction_id is not None:
        conditions.append(F.col("direction_id") == F.lit(direction_id))
    if bucket is not None:
        conditions.append(F.col("observation_bucket") == moment(bucket))
    return reduce(DataFrame.where, conditions, rows)


def _days(since, until, bucket, time_column: str) -> list[Column]:
    """The local dates that a time range can touch."""
    day = F.col("observation_local_date")
    earlier = F.expr("INTERVAL 1 DAY") if time_column == "event_timestamp" else None
    out: list[Column] = []
    if since is not None:
        first = moment(since) if earlier is None else moment(since) - earlier
        out.append(day >= local_date(first, DEFAULTS.timezone))
    if until is not None:
        out.append(day <= local_date(moment(until), DEFAULTS.timezone))
    if bucket is not None:
        out.append(day == local_date(moment(bucket), DEFAULTS.timezone))
    return out


def _of_type(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("route_type") == DEFAULTS.route_type)


def vehicle_status(vehicles: DataFrame) -> DataFrame:
    """Fresh vehicles and the latest event."""
    return _of_type(vehicles).agg(
        F.count_if("is_fresh").alias("fresh_vehicle_count"),
        F.max("event_timestamp").alias("latest_event_at"),
    )


def alert_status(alerts: DataFrame) -> DataFrame:
    """Alerts both active and fresh, and the latest feed."""
    return alerts.agg(
        F.count_if(F.col("is_display_active_now") & F.col("is_feed_fresh")).alias(
            "active_alert_count"
        ),
        F.max("feed_timestamp").alias("latest_feed_at"),
    )


def alert_feed_status(alerts: DataFrame) -> DataFrame:
    """Latest feed and fresh rows; no row at all says nothing about an empty feed."""
    return alerts.agg(
        F.max("feed_timestamp").alias("latest_feed_at"),
        F.count_if("is_feed_fresh").alias("fresh_snapshot_entities"),
    )


def latest_bucket(
    health: DataFrame, route_id: str | None = None, direction_id: int | None = None
) -> DataFrame:
    rows = matching(health, route_id=route_id, direction_id=direction_id)
    return rows.agg(F.max("observation_bucket").alias("latest_bucket"))


def _sums() -> list[Column]:
    return [
        F.sum(name).alias(name)
        for name in ("observed_trip_count", "eligible_trip_count", "late_trip_count")
    ]


def _late_rate(digits: int = 1) -> Column:
    return percentage(F.col("late_trip_count"), F.col("eligible_trip_count"), digits).alias(
        "predicted_late_percentage"
    )


def health_trend(
    health: DataFrame,
    since,
    route_id: str | None = None,
    direction_id: int | None = None,
    until=None,
) -> DataFrame:
    """Sums per bucket; the rate is that of the sums, not a mean of rates."""
    rows = matching(health, since=since, until=until, route_id=route_id, direction_id=direction_id)
    return (
        rows.groupBy("observation_bucket")
        .agg(*_sums())
        .select("*", _late_rate())
        .orderBy("observation_bucket")
    )


def route_comparison(
    health: DataFrame,
    since,
    *,
    route_id: str | None = None,
    direction_id: int | None = None,
    until=None,
    min_eligible: int = 0,
) -> DataFrame:
    """Sums per route with at least ``min_eligible`` eligible samples."""
    if min_eligible < 0:
        raise ValueError("min_eligible must not be negative")
    rows = matching(health, since=since, until=until, route_id=route_id, direction_id=direction_id)
    return (
        rows.groupBy("route_id")
        .agg(F.max("route_short_name").alias("route_short_name"), *_sums())
        .where(F.col("eligible_trip_count") >= min_eligible)
        .select("*", _late_rate())
    )


def _sample_measures(rows: DataFrame, *keys: str, names: tuple[str, ...] = ()) -> DataFrame:
    """Counts and lateness decile per key (of all rows without one).

    Samples are first counted per second of lateness. That spreads a key with
    very many samples over all tasks, and leaves the percentile at most half a
    day of seconds, each with its frequency. ``names`` are kept as maxima.
    """
    counted = rows.groupBy(*keys, lateness().alias("_seconds"), "is_predicted_late").agg(
        F.count("*").alias("_n"), *[F.max(name).alias(name) for name in names]
    )
    seconds, n = F.col("_seconds"), F.col("_n")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return counted.groupBy(*keys).agg(
        *[F.max(name).alias(name) for name in names],
        total(F.lit(True)).alias("observed_trip_count"),
        total(seconds.isNotNull()).alias("eligible_trip_count"),
        total(F.col("is_predicted_late")).alias("late_trip_count"),
        F.percentile(seconds, F.lit(0.9), n).alias("_decile"),
    )


def _sample_rates() -> list[Column]:
    return [
        _late_rate(),
        percentage(F.col("eligible_trip_count"), F.col("observed_trip_count"), 1).alias(
            "metric_coverage_percentage"
        ),
        minutes_of_decile(F.col("_decile"), 1).alias("p90_predicted_lateness_minutes"),
    ]


def routes_needing_attention(
    samples: DataFrame, start, end, *, min_eligible: int = 20, limit: int = 10
) -> DataFrame:
    """Worst routes and directions of a period, by late rate and then lateness."""
    if min_eligible < 1:
        raise ValueError("min_eligible must be positive")
    check_limit(limit, MAX_ATTENTION_ROWS)
    rows = matching(_of_type(samples), since=start, until=end, time_column="event_timestamp")
    grouped = _sample_measures(
        rows.where(F.col("route_id").isNotNull()),
        "route_id",
        "direction_id",
        names=("route_short_name",),
    ).where(F.col("eligible_trip_count") >= min_eligible)
    return (
        grouped.select("*", *_sample_rates())
        .orderBy(
            F.col("predicted_late_percentage").desc_nulls_last(),
            F.col("p90_predicted_lateness_minutes").desc_nulls_last(),
            F.col("eligible_trip_count").desc(),
            "route_id",
            "direction_id",
        )
        .limit(limit)
        .drop("_decile", "late_trip_count")
    )


def period_summary(
    samples: DataFrame, start, end, route_id: str | None = None, direction_id: int | None = None
) -> DataFrame:
    """Counts and rates of a period, as one row."""
    rows = matching(
        _of_type(samples),
        since=start,
        until=end,
        route_id=route_id,
        direction_id=direction_id,
        time_column="event_timestamp",
    )
    return _sample_measures(rows).select("*", *_sample_rates()).drop("_decile")


def routes(dim_routes: DataFrame) -> DataFrame:
    """Routes to choose from, by short name."""
    return (
        _of_type(dim_routes)
        .select("route_id", "route_short_name", "route_long_name")
        .orderBy(F.col("route_short_name").asc_nulls_last(), "route_id")
    )


# Orders to choose from; the sample key makes each of them total.
_TOTAL = ("observation_bucket", "event_timestamp")
SAMPLE_ORDERS = {
    "latest": lambda: [F.col(c).desc_nulls_first() for c in _TOTAL],
    "largest_delay": lambda: [
        F.col(c).desc_nulls_first() for c in ("predicted_delay_seconds", *_TOTAL)
    ],
}


def trip_samples(
    samples: DataFrame,
    since,
    route_id: str | None = None,
    direction_id: int | None = None,
    bucket=None,
    limit: int = 100,
    sort_by: str = "latest",
) -> DataFrame:
    """Samples behind the figures, newest or most delayed first (unknown delays lead)."""
    check_limit(limit, MAX_SAMPLE_ROWS)
    if sort_by not in SAMPLE_ORDERS:
        raise ValueError(f"sort_by must be one of {sorted(SAMPLE_ORDERS)}")
    rows = matching(
        _of_type(samples),
        since=since,
        route_id=route_id,
        direction_id=direction_id,
        bucket=bucket,
    )
    return (
        rows.orderBy(*SAMPLE_ORDERS[sort_by](), "trip_instance_key")
        .limit(limit)
        .select(
            "observation_bucket",
            "observation_local_timestamp",
            "route_id",
            "route_short_name",
            "direction_id",
            "trip_id",
            "trip_instance_key",
            "stop_name",
            "delay_basis",
            "scheduled_prediction_timestamp",
            "delay_prediction_timestamp",
            "predicted_delay_seconds",
            "is_predicted_late",
        )
    )


def live_vehicles(
    vehicles: DataFrame,
    route_id: str | None = None,
    direction_id: int | None = None,
    limit: int = MAX_LIVE_ROWS,
) -> DataFrame:
    """Fresh vehicles with usable coordinates, plus one row when there are more."""
    check_limit(limit, MAX_LIVE_ROWS)
    usable = (
        F.col("is_fresh")
        & F.col("latitude").between(-90, 90)
        & F.col("longitude").between(-180, 180)
    )
    rows = matching(_of_type(vehicles).where(usable), route_id=route_id, direction_id=direction_id)
    return (
        rows.orderBy(F.col("event_timestamp").desc_nulls_first(), "vehicle_id")
        .limit(limit + 1)
        .select(
            "vehicle_id",
            "event_timestamp",
            "route_id",
            "route_short_name",
            "trip_id",
            "trip_headsign",
            "direction_id",
            "latitude",
            "longitude",
            "occupancy_status",
            "source_age_seconds",
        )
    )


def active_alerts(alerts: DataFrame, route_id: str | None = None, limit: int = 100) -> DataFrame:
    """Alerts active and fresh, plus one row when there are more.

    An alert without routes stays visible under any route.
    """
    check_limit(limit, MAX_LIVE_ROWS)
    rows = alerts.where(F.col("is_display_active_now") & F.col("is_feed_fresh"))
    if route_id is not None:
        concerned = F.array_contains("route_ids", F.lit(route_id))
        rows = rows.where(concerned | (F.size("route_ids") == 0))
    return (
        rows.orderBy(F.col("feed_timestamp").desc_nulls_first(), "alert_id")
        .limit(limit + 1)
        .select(
            "alert_id",
            "feed_timestamp",
            "cause",
            "severity",
            "effect",
            "header_text",
            "description_text",
            "url",
            "route_ids",
            "stop_ids",
            "trip_ids",
            "direction_ids",
            "source_age_seconds",
        )
    )
