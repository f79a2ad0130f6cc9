"""Trip monitoring samples: one row per trip and time bucket, and its delay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.functions.times import (
    bucket_start,
    elapsed_seconds,
    nearest_service_instant,
    service_seconds,
)
from stopwise.settings import DEFAULTS, Settings

SAMPLE_KEY = ("observation_bucket", "trip_instance_key")


def trip_instance_key() -> Column:
    """Trip, service date and start time of one run of a trip."""
    return F.concat_ws(
        "|",
        F.col("trip_id"),
        F.coalesce(F.date_format("start_date", "yyyyMMdd"), F.lit("unknown-date")),
        F.coalesce("start_time", F.lit("scheduled")),
    )


def next_prediction() -> Column:
    return F.coalesce("predicted_arrival", "predicted_departure")


def upcoming_stops(updates: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Predictions not yet past when they were observed, with their sample key."""
    return updates.where(next_prediction() >= F.col("event_timestamp")).select(
        "*",
        bucket_start(F.col("event_timestamp"), settings.bucket_minutes).alias("observation_bucket"),
        trip_instance_key().alias("trip_instance_key"),
        next_prediction().alias("next_prediction_timestamp"),
    )


def _newest_first() -> list[Column]:
    return [F.col(name).desc_nulls_first() for name in ("event_timestamp", "event_id")]


def _next_stop_first() -> list[Column]:
    names = ("next_prediction_timestamp", "stop_sequence", "stop_update_index")
    return [F.col(name).asc_nulls_last() for name in names]


def newest_event_stops(upcoming: DataFrame) -> DataFrame:
    """All stops of the newest event of each sample key."""
    window = Window.partitionBy(*SAMPLE_KEY).orderBy(*_newest_first())
    ranked = upcoming.withColumn("_rank", F.dense_rank().over(window))
    return ranked.where("_rank = 1").drop("_rank")


def next_stops(upcoming: DataFrame) -> DataFrame:
    """The next stop of the newest event of each sample key.

    Newest event first and next stop first is one ordering, so one ranking
    finds both. The rank limit also runs before the shuffle: a map task sends
    at most one row per key, however many rows the key has.
    """
    window = Window.partitionBy(*SAMPLE_KEY).orderBy(*_newest_first(), *_next_stop_first())
    ranked = upcoming.withColumn("_rank", F.row_number().over(window))
    return ranked.where("_rank = 1").drop("_rank")


def with_delay_basis(samples: DataFrame) -> DataFrame:
    """Arrival when both predicted and scheduled, else departure when both, else none."""
    has_arrival = F.col("predicted_arrival").isNotNull() & F.col("scheduled_arrival_time").isNotNull()
    has_departure = (
        F.col("predicted_departure").isNotNull() & F.col("scheduled_departure_time").isNotNull()
    )

    def choose(arrival: Column, departure: Column) -> Column:
        return F.when(has_arrival, arrival).when(has_departure, departure)

    return samples.select(
        "*",
        choose(F.lit("arrival"), F.lit("departure")).alias("delay_basis"),
        choose(F.col("predicted_arrival"), F.col("predicted_departure")).alias(
            "delay_prediction_timestamp"
        ),
        choose(F.col("scheduled_arrival_time"), F.col("scheduled_departure_time")).alias(
            "scheduled_time_text"
        ),
    )


def with_predicted_delay(samples: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Scheduled instant, delay, lateness and late flag; unknown stays null."""
    timed = samples.withColumn(
        "scheduled_prediction_timestamp",
        nearest_service_instant(
            F.col("delay_prediction_timestamp"),
            service_seconds(F.col("scheduled_time_text")),
            settings.timezone,
        ),
    ).withColumn(
        "predicted_delay_seconds",
        elapsed_seconds(
            F.col("delay_prediction_timestamp"), F.col("scheduled_prediction_timestamp")
        ).cast("int"),
    )
    delay = F.col("predicted_delay_seconds")
    return timed.select(
        "*",
        F.when(delay.isNotNull(), F.greatest(delay, F.lit(0))).alias("predicted_lateness_seconds"),
        (delay > settings.late_threshold_seconds).alias("is_predicted_late"),
    )
