"""Checks of pipeline health."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import messages as m
from checks import oracle
from checks.projections import AS_OF, project
from checks.registry import check
from stopwise.plans import health
from stopwise.streaming import progress

LATER = "2024-01-31 12:00:00"


def log(t):
    return project(t.spark, t.folder, m.PROGRESS_LOG)


def watermarks(t):
    return project(t.spark, t.folder, m.WATERMARKS)


def reports(t):
    return progress.progress_rows(log(t))


def stored(t):
    return progress.retained_progress(progress.stored_progress(reports(t)))


def stream_health(t):
    names = health.applications(t.spark)
    return health.stream_health(names, progress.application_status(log(t)), stored(t))


def _figure(path: str, kind: str) -> str:
    return f"coalesce(cast(json_extract_string(progress, '$.{path}') as {kind}), 0)"


oracle.add_part(
    "reports",
    f"""
    SELECT application_name, json_extract_string(progress, '$.id') AS query_id,
        json_extract_string(progress, '$.runId') AS run_id,
        cast(replace(json_extract_string(progress, '$.timestamp'), 'Z', '') as timestamp)
            AS progress_timestamp,
        cast(json_extract_string(progress, '$.batchId') as bigint) AS batch_id,
        {_figure("numInputRows", "bigint")} AS num_input_rows,
        {_figure("inputRowsPerSecond", "double")} AS input_rows_per_second,
        {_figure("processedRowsPerSecond", "double")} AS processed_rows_per_second,
        {_figure("durationMs.triggerExecution", "bigint")} AS batch_duration_ms,
        cast(3 as bigint) AS late_rows, recorded_at, progress
    FROM fx_progress_log WHERE kind = 'progress'
    """,
)
oracle.add_part(
    "report_offsets",
    """
    SELECT application_name, batch_id, recorded_at, topic, partition, cast(end_offset as bigint)
        AS end_offset
    FROM (SELECT *, unnest(['transit.a', 'transit.a', 'transit.b']) AS topic,
        unnest([0, 1, 2]) AS partition,
        unnest([json_extract_string(progress, '$.sources[1].endOffset."transit.a"."0"'),
            json_extract_string(progress, '$.sources[1].endOffset."transit.a"."1"'),
            json_extract_string(progress, '$.sources[1].endOffset."transit.b"."2"')]) AS end_offset
        FROM reports) q
    """,
)
oracle.add_part(
    "kept_reports",
    """
    SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY application_name
        ORDER BY progress_timestamp DESC, recorded_at DESC, batch_id DESC) AS place
        FROM (SELECT * FROM reports QUALIFY row_number() OVER (
            PARTITION BY query_id, run_id, batch_id ORDER BY recorded_at DESC) = 1) r) q
    WHERE place <= 500
    """,
)
oracle.add_part(
    "newest_reports",
    """
    SELECT * FROM kept_reports QUALIFY row_number() OVER (PARTITION BY application_name
        ORDER BY progress_timestamp DESC, recorded_at DESC, batch_id DESC) = 1
    """,
)
oracle.add_part(
    "app_status",
    """
    SELECT l.application_name, l.query_id, l.run_id, CASE l.kind WHEN 'started' THEN 'running'
            WHEN 'progress' THEN 'running' WHEN 'idle' THEN 'idle'
            ELSE CASE WHEN l.error_message IS NULL THEN 'terminated' ELSE 'failed' END END AS status,
        p.progress_timestamp AS last_progress_at, p.batch_id AS last_batch_id,
        CASE WHEN l.kind <> 'progress' THEN l.error_message END AS error_message, s.started_at,
        CASE WHEN l.kind = 'terminated' THEN l.recorded_at END AS terminated_at,
        l.recorded_at AS updated_at
    FROM (SELECT * FROM fx_progress_log QUALIFY row_number() OVER (
        PARTITION BY application_name ORDER BY recorded_at DESC) = 1) l
    LEFT JOIN (SELECT * FROM reports QUALIFY row_number() OVER (
        PARTITION BY application_name ORDER BY recorded_at DESC) = 1) p
        ON p.application_name = l.application_name
    LEFT JOIN (SELECT application_name, min(recorded_at) AS started_at FROM fx_progress_log
        GROUP BY application_name) s ON s.application_name = l.application_name
    """,
)
oracle.add_part(
    "apps",
    """
    SELECT unnest(['vehicle-state', 'trip-update', 'service-alert']) AS application_name,
        unnest(['Vehicle positions', 'Trip updates', 'Service alerts']) AS display_name
    """,
)
_REPORT = """
application_name, query_id, run_id, progress_timestamp, batch_id, num_input_rows,
input_rows_per_second, processed_rows_per_second, batch_duration_ms, late_rows, recorded_at
"""


@check("progress_rows", "OPS1 STR10", f"SELECT {_REPORT} FROM reports")
def _(t):
    return reports(t).drop("progress", "source_offsets")


@check("progress_offsets", "OPS2", "SELECT * FROM report_offsets")
def _(t):
    return progress.offsets(progress.with_source_offsets(reports(t)))


@check("application_status", "OPS4", "SELECT * FROM app_status")
def _(t):
    return progress.application_status(log(t))


@check(
    "stored_progress",
    "OPS5",
    f"""
    SELECT {_REPORT} FROM reports QUALIFY row_number() OVER (
        PARTITION BY query_id, run_id, batch_id ORDER BY recorded_at DESC) = 1
    """,
)
def _(t):
    return progress.stored_progress(reports(t)).drop("progress", "source_offsets")


@check("retained_progress", "WIN7", f"SELECT {_REPORT} FROM kept_reports")
def _(t):
    return stored(t).drop("progress", "source_offsets")


@check(
    "stream_health",
    "OPS6 JN7",
    """
    SELECT a.application_name, a.display_name, s.status, s.last_progress_at, r.batch_id,
        r.num_input_rows, r.input_rows_per_second, r.processed_rows_per_second,
        r.batch_duration_ms
    FROM apps a LEFT JOIN app_status s ON s.application_name = a.application_name
    LEFT JOIN newest_reports r ON r.application_name = a.application_name
    """,
)
def _(t):
    return stream_health(t).drop("progress", "source_offsets")


@check(
    "latest_batch_run",
    "OPS7",
    f"""
    SELECT CASE WHEN status = 'running' AND started_at < TIMESTAMP '{LATER}' - interval '20' minute
            THEN 'stale' ELSE status END AS status, started_at, finished_at, duration_seconds,
        CASE WHEN status = 'running' AND started_at < TIMESTAMP '{LATER}' - interval '20' minute
            THEN coalesce(error_message, 'Run did not reach a terminal state')
            ELSE error_message END AS error_message
    FROM fx_batch_runs ORDER BY started_at DESC LIMIT 1
    """,
)
def _(t):
    return health.latest_run(project(t.spark, t.folder, m.BATCH_RUNS), LATER)


@check(
    "data_times",
    "OPS8 AGG14",
    f"""
    SELECT greatest((SELECT max(event_timestamp) FROM fx_vehicle_positions),
            (SELECT max(event_timestamp) FROM fx_trip_stop_updates),
            (SELECT max(event_timestamp) FROM fx_service_alert_entities)) AS latest_event_at,
        (SELECT max(finished_at) FROM fx_batch_runs WHERE status = 'success')
            AS latest_dbt_finished_at,
        {oracle.NOW} AS dashboard_read_at
    """,
)
def _(t):
    return health.data_times(t, project(t.spark, t.folder, m.BATCH_RUNS), AS_OF)


oracle.add_part(
    "processed",
    """
    SELECT o.topic, o.partition, arg_max(o.end_offset, o.application_name) AS processed_offset
    FROM report_offsets o JOIN newest_reports r ON r.application_name = o.application_name
        AND r.batch_id = o.batch_id AND r.recorded_at = o.recorded_at
    JOIN apps a ON a.application_name = o.application_name
    GROUP BY o.topic, o.partition
    """,
)


@check("processed_offsets", "OPS9", "SELECT * FROM processed")
def _(t):
    return health.processed_offsets(stream_health(t))


@check(
    "stream_backlog",
    "OPS10 JN12",
    """
    SELECT w.topic, w.partition, w.low, w.high, p.processed_offset,
        CASE WHEN p.processed_offset IS NOT NULL
            THEN greatest(w.high - p.processed_offset, 0) END AS backlog
    FROM fx_watermarks w LEFT JOIN processed p
        ON p.topic = w.topic AND p.partition = w.partition
    """,
)
def _(t):
    return health.backlog(watermarks(t), health.processed_offsets(stream_health(t)))


@check(
    "retained_records",
    "OPS11",
    """
    SELECT 'transit.dead' AS topic, cast(sum(high - low) as bigint) AS retained_records
    FROM fx_watermarks WHERE topic = 'transit.dead'
    """,
)
def _(t):
    return health.retained_records(watermarks(t), "transit.dead").select(
        F.lit("transit.dead").alias("topic"), "retained_records"
    )


@check(
    "display_status",
    "OPS12",
    f"""
    SELECT recorded_at, CASE WHEN kind = 'terminated' AND error_message IS NOT NULL THEN 'Failed'
        WHEN kind = 'terminated' THEN 'Stopped' WHEN kind = 'started' THEN 'Unknown'
        WHEN epoch_us({oracle.NOW}) - epoch_us(recorded_at) > 43200000000 THEN 'Stale'
        WHEN kind = 'idle' THEN 'Idle' ELSE 'Running' END AS display_status
    FROM fx_progress_log
    """,
)
def _(t):
    # Each log entry as if it were the last one heard of its application.
    status = (
        F.when(F.col("kind") == "idle", F.lit("idle"))
        .when(F.col("error_message").isNotNull(), F.lit("FAILED"))
        .when(F.col("kind") == "terminated", F.lit("terminated"))
        .otherwise(F.lit("running"))
    )
    heard = F.when(F.col("kind") != "started", F.col("recorded_at"))
    shown = health.display_status(status, heard, AS_OF, stale_after=12 * 3600)
    return log(t).select("recorded_at", shown.alias("display_status"))
