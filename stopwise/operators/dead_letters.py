"""Routing of messages that break their contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stopwise import settings
from stopwise.functions.times import moment
from stopwise.operators.contracts import (
    MEETS,
    VIOLATIONS,
    contract_of,
    with_verdict,
    with_violations,
)


def dead_letters(rejected: DataFrame, failed_at=None, stage: str = "schema_validation") -> DataFrame:
    """Dead-letter events of rejected messages.

    Needs ``key``, ``value``, ``topic`` and the violations; ``partition`` and
    ``offset`` are used when present. The id is derived from where the message
    stands, so a replay makes the same dead letter again.
    """
    document = F.try_parse_json(F.col("value").cast("string"))
    placed = "partition" in rejected.columns and "offset" in rejected.columns
    partition = F.col("partition") if placed else F.lit(None)
    offset = F.col("offset") if placed else F.lit(None)
    identity = (
        ["topic", "partition", "offset"] if placed else ["topic", "key", F.col("value").cast("string")]
    )
    _, version = contract_of(document)
    event_id = F.try_variant_get(document, "$.event_id", "variant")
    return rejected.select(
        F.sha2(F.concat_ws("|", *identity), 256).alias("event_id"),
        F.lit(settings.DEAD_LETTER_EVENT).alias("event_type"),
        F.lit(1).alias("schema_version"),
        moment(failed_at).alias("failed_at"),
        F.lit(stage).alias("failure_stage"),
        F.lit("EventValidationError").alias("error_type"),
        F.get(F.col(VIOLATIONS), F.lit(0)).alias("error_message"),
        F.col("topic").alias("original_topic"),
        partition.cast("int").alias("original_partition"),
        offset.cast("bigint").alias("original_offset"),
        F.col("key").cast("string").alias("original_key"),
        version.cast("int").alias("original_schema_version"),
        F.coalesce(document, F.col("value").cast("string").cast("variant")).alias("raw_payload"),
        F.when(
            F.schema_of_variant(event_id) == "STRING", F.try_variant_get(event_id, "$", "string")
        ).alias("correlation_id"),
    )


def _explained(rejected: DataFrame) -> DataFrame:
    """Rejected messages with their violations, which are worked out where they are read."""
    return with_violations(rejected.drop(MEETS), if_read=True)


def route(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages that meet their contract, and the others with their violations.

    The verdict alone decides; texts are made for rejected messages only. Filters on the violations
    belong on a generated copy, see ``with_violations``.
    """
    checked = with_verdict(messages)
    return checked.where(MEETS).drop(MEETS), _explained(checked.where(~F.col(MEETS)))


def route_counts(messages: DataFrame) -> DataFrame:
    """Published and rejected messages per topic."""
    good = F.col(MEETS)
    return (
        with_verdict(messages)
        .groupBy("topic")
        .agg(F.count_if(good).alias("published"), F.count_if(~good).alias("rejected"))
    )


def publish(
    messages: DataFrame,
    write_accepted: Callable[[DataFrame], None],
    write_rejected: Callable[[DataFrame], None],
    failed_at=None,
) -> tuple[int, int]:
    """Write both branches and return how many messages each received.

    The contract is checked once: both writes read the persisted result, and
    the counts are observed while it is first computed.
    """
    counts = Observation()
    good = F.col(MEETS)
    checked = with_verdict(messages).observe(
        counts, F.count_if(good).alias("published"), F.count_if(~good).alias("rejected")
    )
    checked = checked.persist()
    try:
        write_accepted(checked.where(good).drop(MEETS))
        write_rejected(dead_letters(_explained(checked.where(~good)), failed_at))
        return counts.get["published"], counts.get["rejected"]
    finally:
        checked.unpersist()
