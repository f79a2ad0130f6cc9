"""Pipeline health: jobs, runs, data times and stream backlog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.functions.times import elapsed_seconds, moment, within_seconds
from stopwise.streaming.jobs import JOBS
from stopwise.streaming.progress import with_source_offsets

STALE_RUN_SECONDS = 20 * 60
STALE_PROGRESS_SECONDS = 120


def applications(spark: SparkSession) -> DataFrame:
    """The jobs that should be running."""
    rows = [(job.name, job.title) for job in JOBS.values()]
    return spark.createDataFrame(rows, "application_name string, display_name string")


def latest_progress(reports: DataFrame) -> DataFrame:
    """Newest report of each application, as an aggregate: no sort, no ranking."""
    newest = reports.groupBy("application_name").agg(
        F.max_by(
            F.struct(
                "batch_id",
                "num_input_rows",
                "input_rows_per_second",
                "processed_rows_per_second",
                "batch_duration_ms",
                "progress",
            ),
            F.struct("progress_timestamp", "recorded_at", "batch_id"),
        ).alias("newest")
    )
    return with_source_offsets(newest.select("application_name", "newest.*"))


def stream_health(names: DataFrame, status: DataFrame, reports: DataFrame) -> DataFrame:
    """Status and newest progress of each expected application, known or not."""
    state = status.select("application_name", "status", "last_progress_at")
    return (
        names.join(state, "application_name", "left")
        .join(latest_progress(reports), "application_name", "left")
        .orderBy("application_name")
    )


def latest_run(runs: DataFrame, as_of=None) -> DataFrame:
    """Newest batch run; one that has been running too long is stale."""
    limit = F.unix_micros(moment(as_of)) - F.lit(STALE_RUN_SECONDS * 1_000_000)
    stale = (F.col("status") == "running") & (F.unix_micros("started_at") < limit)
    note = F.coalesce("error_message", F.lit("Run did not reach a terminal state"))
    return (
        runs.orderBy(F.col("started_at").desc_nulls_first())
        .limit(1)
        .select(
            F.when(stale, F.lit("stale")).otherwise(F.col("status")).alias("status"),
            "started_at",
            "finished_at",
            "duration_seconds",
            F.when(stale, note).otherwise(F.col("error_message")).alias("error_message"),
        )
    )


def data_times(tables: Mapping[str, DataFrame], runs: DataFrame, as_of=None) -> DataFrame:
    """Latest event, latest successful build and time of reading."""
    latest = None
    for name in ("vehicle_positions", "trip_stop_updates", "service_alert_entities"):
        newest = tables[name].agg(F.max("event_timestamp").alias("event_at"))
        latest = newest if latest is None else latest.unionByName(newest)
    succeeded = F.when(F.col("status") == "success", F.col("finished_at"))
    entries = latest.select("event_at", F.lit(None).cast("timestamp").alias("built_at")).unionByName(
        runs.agg(F.max(succeeded).alias("built_at")).select(
            F.lit(None).cast("timestamp").alias("event_at"), "built_at"
        )
    )
    return entries.agg(
        F.max("event_at").alias("latest_event_at"),
        F.max("built_at").alias("latest_dbt_finished_at"),
    ).select("*", moment(as_of).alias("dashboard_read_at"))


def processed_offsets(health: DataFrame) -> DataFrame:
    """Processed offset per topic and partition over all applications.

    When several report one partition, the application that sorts last counts.
    """
    topics = health.select("application_name", F.explode("source_offsets").alias("topic", "parts"))
    partitions = topics.select(
        "application_name", "topic", F.explode("parts").alias("partition", "processed_offset")
    )
    return partitions.groupBy("topic", F.col("partition").cast("int").alias("partition")).agg(
        F.max_by("processed_offset", "application_name").alias("processed_offset")
    )


def backlog(watermarks: DataFrame, processed: DataFrame) -> DataFrame:
    """Messages not yet processed per partition; unknown where nothing was reported."""
    behind = F.col("high") - F.col("processed_offset")
    return watermarks.join(processed, ["topic", "partition"], "left").select(
        *watermarks.columns,
        "processed_offset",
        F.when(behind.isNotNull(), F.greatest(behind, F.lit(0))).alias("backlog"),
    )


def retained_records(watermarks: DataFrame, topic: str) -> DataFrame:
    """Messages a topic still holds; null for an unknown topic."""
    rows = watermarks.where(F.col("topic") == F.lit(topic))
    return rows.agg(F.sum(F.col("high") - F.col("low")).alias("retained_records"))


def display_status(
    status: Column, last_progress_at: Column, as_of=None, stale_after: int = STALE_PROGRESS_SECONDS
) -> Column:
    """Status to show: an end counts first, then how recent the progress is."""
    known = F.lower(status)
    return (
        F.when(F.coalesce(known, F.lit("")) == "", F.lit("Unknown"))
        .when(known == "failed", F.lit("Failed"))
        .when(known == "terminated", F.lit("Stopped"))
        .when(last_progress_at.isNull(), F.lit("Unknown"))
        .when(~within_seconds(last_progress_at, moment(as_of), stale_after), F.lit("Stale"))
        .when(known == "idle", F.lit("Idle"))
        .otherwise(F.lit("Running"))
    )


def progress_age(last_progress_at: Column, as_of=None) -> Column:
    """Whole seconds since the last progress."""
    return elapsed_seconds(moment(as_of), last_progress_at).cast("bigint")
