"""Envelope rows to parsed, deduplicated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise import schemas
from stopwise.functions.plan import computed_once
from stopwise.operators.quality import CORRUPT

WATERMARK = "2 minutes"
_LINEAGE = ("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp")


def envelope_columns(raw: DataFrame) -> DataFrame:
    """Key and value as text, the rest renamed as lineage."""
    return raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def _parsed(raw: DataFrame, schema: str, options: dict[str, str] | None = None) -> DataFrame:
    event = F.from_json("raw_value", schema, options or {})
    parsed = computed_once(envelope_columns(raw), "event", event)
    return parsed.select("event.*", *_LINEAGE, "raw_value")


def parse_vehicle_events(raw: DataFrame) -> DataFrame:
    return _parsed(raw, schemas.VEHICLE_EVENT)


def parse_trip_events(raw: DataFrame) -> DataFrame:
    return _parsed(raw, schemas.TRIP_EVENT)


def parse_alert_events(raw: DataFrame) -> DataFrame:
    """Alerts also keep what did not parse: a bad optional time invalidates an alert."""
    return _parsed(
        raw,
        f"{schemas.ALERT_EVENT}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def with_event_time(
    events: DataFrame, column: str = "source_timestamp", delay: str = WATERMARK
) -> DataFrame:
    """Watermark; a time without zone is read in the session's (UTC)."""
    if dict(events.dtypes)[column] == "timestamp_ntz":
        events = events.withColumn(column, F.col(column).cast("timestamp"))
    return events.withWatermark(column, delay)


def deduplicated(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event; on a stream, within the watermark."""
    if events.isStreaming:
        return events.dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])
