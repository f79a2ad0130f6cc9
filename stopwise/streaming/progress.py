"""Progress and status of the streaming jobs.

The listener only appends what it hears to a log. Tables are derived from the
log by queries, so "insert or update" becomes "newest entry per key".
"""

from __future__ import annotations

import logging
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from stopwise import schemas
from stopwise.functions.plan import computed_once
from stopwise.operators.latest import newest_per_key

LOGGER = logging.getLogger(__name__)
RETAINED_BATCHES = 500

STARTED, PROGRESS, IDLE, TERMINATED = "started", "progress", "idle", "terminated"


class ProgressLog(StreamingQueryListener):
    """Appends query events as JSON lines; a failed append never stops the query."""

    def __init__(self, spark: SparkSession, application_name: str, folder: str) -> None:
        super().__init__()
        self._spark, self._name, self._folder = spark, application_name, folder

    def _append(self, kind: str, event: Any, progress: str | None = None, error: str | None = None):
        now = datetime.now(UTC).replace(tzinfo=None)
        row = (self._name, kind, str(event.id), str(event.runId), now, progress, error)
        try:
            rows = self._spark.createDataFrame([row], schemas.APPLICATION_EVENT)
            rows.coalesce(1).write.mode("append").json(self._folder)
        except Exception as failure:  # noqa: BLE001 - metrics must not stop the stream
            LOGGER.warning("Could not log progress of %s: %s", self._name, failure)

    def onQueryStarted(self, event: Any) -> None:
        self._append(STARTED, event)

    def onQueryProgress(self, event: Any) -> None:
        self._append(PROGRESS, event.progress, progress=event.progress.json)

    def onQueryIdle(self, event: Any) -> None:
        self._append(IDLE, event)

    def onQueryTerminated(self, event: Any) -> None:
        error = getattr(event, "exception", None)
        self._append(TERMINATED, event, error=str(error) if error else None)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.APPLICATION_EVENT).json(folder)


_REPORT = (
    "id string, runId string, timestamp timestamp, batchId bigint, numInputRows bigint, "
    "inputRowsPerSecond double, processedRowsPerSecond double, "
    "durationMs struct<triggerExecution: bigint>, "
    "stateOperators array<struct<numRowsDroppedByWatermark: bigint>>"
)


_PARTITIONS = "map<string,bigint>"


def _topic_entries(source: Column) -> Column:
    """Topics of the end offset of a source, with their partitions.

    The end offset is an object, or the text of one; anything else (the offset
    of a file source, a malformed text) has no partitions.
    """
    end = F.try_variant_get(source, "$.endOffset", "variant")
    text = F.when(F.schema_of_variant(end) == "STRING", F.try_variant_get(end, "$", "string"))
    topics = F.try_variant_get(F.coalesce(F.try_parse_json(text), end), "$", "map<string,variant>")
    return F.transform(
        F.map_entries(topics),
        lambda entry: F.struct(
            entry["key"].alias("topic"),
            F.try_variant_get(entry["value"], "$", _PARTITIONS).alias("partitions"),
        ),
    )


def with_source_offsets(reports: DataFrame) -> DataFrame:
    """Add topic to partition to offset over all sources; a later source wins per topic.

    Reports are reduced to those of interest first: this is the costly part.
    """
    sources = F.try_variant_get(F.try_parse_json("progress"), "$.sources", "array<variant>")
    listed = F.flatten(F.array_compact(F.transform(sources, _topic_entries)))
    empty = F.create_map().cast(f"map<string,{_PARTITIONS}>")
    merged = F.reduce(
        F.filter(listed, lambda entry: entry["partitions"].isNotNull()),
        empty,
        lambda found, entry: F.map_concat(
            F.map_filter(found, lambda topic, _: topic != entry["topic"]),
            F.create_map(entry["topic"], entry["partitions"]),
        ),
    )
    return reports.withColumn("source_offsets", F.coalesce(merged, empty)).drop("progress")


def progress_rows(log: DataFrame) -> DataFrame:
    """Progress reports as columns; absent figures are zero."""
    entries = log.where(F.col("kind") == PROGRESS)
    rows = computed_once(entries, "report", F.from_json("progress", _REPORT))

    def figure(path: str, default: float) -> Column:
        return F.coalesce(f"report.{path}", F.lit(default))

    late = F.reduce(
        "report.stateOperators",
        F.lit(0).cast("bigint"),
        lambda total, item: total + F.coalesce(item["numRowsDroppedByWatermark"], F.lit(0)),
    )
    return rows.select(
        "application_name",
        F.col("report.id").alias("query_id"),
        F.col("report.runId").alias("run_id"),
        F.col("report.timestamp").alias("progress_timestamp"),
        F.col("report.batchId").alias("batch_id"),
        figure("numInputRows", 0).alias("num_input_rows"),
        figure("inputRowsPerSecond", 0.0).alias("input_rows_per_second"),
        figure("processedRowsPerSecond", 0.0).alias("processed_rows_per_second"),
        figure("durationMs.triggerExecution", 0).alias("batch_duration_ms"),
        F.coalesce(late, F.lit(0)).alias("late_rows"),
        "recorded_at",
        "progress",
    )


def offsets(progress: DataFrame) -> DataFrame:
    """One row per application, batch, topic and partition."""
    topics = progress.select(
        "application_name",
        "batch_id",
        "recorded_at",
        F.explode("source_offsets").alias("topic", "partitions"),
    )
    return topics.select(
        "application_name",
        "batch_id",
        "recorded_at",
        "topic",
        F.explode("partitions").alias("partition", "end_offset"),
    ).withColumn("partition", F.col("partition").cast("int"))


def stored_progress(progress: DataFrame) -> DataFrame:
    """One row per query run and batch: the report that came last."""
    newest = progress.groupBy("query_id", "run_id", "batch_id").agg(
        F.max_by(F.struct("*"), "recorded_at").alias("row")
    )
    return newest.select("row.*")


def retained_progress(progress: DataFrame, keep: int = RETAINED_BATCHES) -> DataFrame:
    """The newest reports of each application."""
    if keep < 1:
        raise ValueError("keep must be positive")
    names = ("progress_timestamp", "recorded_at", "batch_id")
    order = [F.col(name).desc_nulls_last() for name in names]
    return newest_per_key(progress, ["application_name"], order, keep)


def application_status(log: DataFrame) -> DataFrame:
    """Current state of each application, from its newest entries.

    Progress clears an earlier error or end; the last progress stays visible
    after the application has stopped.
    """
    is_progress = F.col("kind") == PROGRESS
    status = (
        F.when(F.col("kind").isin(STARTED, PROGRESS), F.lit("running"))
        .when(F.col("kind") == IDLE, F.lit("idle"))
        .when(F.col("error_message").isNotNull(), F.lit("failed"))
        .otherwise(F.lit("terminated"))
    )
    entry = F.struct(
        "query_id",
        "run_id",
        status.alias("status"),
        F.when(~is_progress, F.col("error_message")).alias("error_message"),
        F.when(F.col("kind") == TERMINATED, F.col("recorded_at")).alias("terminated_at"),
        F.col("recorded_at").alias("updated_at"),
    )
    newest = log.groupBy("application_name").agg(
        F.max_by(entry, "recorded_at").alias("entry"),
        F.max_by(
            F.when(is_progress, F.col("progress")), F.when(is_progress, F.col("recorded_at"))
        ).alias("progress"),
        F.min("recorded_at").alias("started_at"),
    )
    newest = computed_once(newest, "report", F.from_json("progress", _REPORT))
    return newest.select(
        "application_name",
        "entry.query_id",
        "entry.run_id",
        "entry.status",
        F.col("report.timestamp").alias("last_progress_at"),
        F.col("report.batchId").alias("last_batch_id"),
        "entry.error_message",
        "started_at",
        "entry.terminated_at",
        "entry.updated_at",
    )
