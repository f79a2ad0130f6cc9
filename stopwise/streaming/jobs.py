"""The three streaming jobs: read, parse, check, deduplicate, flatten, store."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from stopwise import settings
from stopwise.operators import flatten, quality
from stopwise.session import build_session
from stopwise.sources.envelopes import read_kafka_stream
from stopwise.streaming import events, sinks
from stopwise.streaming.progress import ProgressLog


@dataclass(frozen=True)
class Job:
    """What differs between the jobs."""

    name: str
    title: str
    topic: str
    parse: Callable[[DataFrame], DataFrame]
    is_valid: Callable[[], Column]
    flatten: Callable[[DataFrame], DataFrame]
    table: str


JOBS = {
    job.name: job
    for job in (
        Job(
            "vehicle-state",
            "Vehicle positions",
            settings.VEHICLE_TOPIC,
            events.parse_vehicle_events,
            quality.vehicle_is_valid,
            flatten.vehicle_rows,
            "vehicle_positions",
        ),
        Job(
            "trip-update",
            "Trip updates",
            settings.TRIP_TOPIC,
            events.parse_trip_events,
            quality.trip_update_is_valid,
            flatten.stop_update_rows,
            "trip_stop_updates",
        ),
        Job(
            "service-alert",
            "Service alerts",
            settings.ALERT_TOPIC,
            events.parse_alert_events,
            quality.alert_is_valid,
            flatten.alert_entity_rows,
            "service_alert_entities",
        ),
    )
}


def checked_events(raw: DataFrame, job: Job) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid events of a raw stream or table."""
    return quality.split(quality.with_flag(job.parse(raw), job.is_valid()))


def table_rows(raw: DataFrame, job: Job) -> DataFrame:
    """Rows a job stores; the same plan on a stream and on a table."""
    valid, _ = checked_events(raw, job)
    if valid.isStreaming:
        valid = events.with_event_time(valid)
    return job.flatten(events.deduplicated(valid))


def start(
    raw: DataFrame,
    job: Job,
    *,
    target: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Start a job on a raw stream; target and checkpoint are per-job folders."""
    return sinks.start_keyed_sink(
        table_rows(raw, job),
        table=job.table,
        target=target,
        checkpoint=checkpoint,
        query_name=job.name,
        trigger=trigger,
    )


def run(arguments: argparse.Namespace) -> None:
    """Run one job until it ends, with its progress logged."""
    job = JOBS[arguments.job]
    spark = build_session(job.name)
    log = ProgressLog(spark, job.name, f"{arguments.store}/progress/{job.name}")
    query = None
    try:
        spark.streams.addListener(log)
        raw = read_kafka_stream(
            spark,
            arguments.bootstrap_servers,
            job.topic,
            arguments.starting_offsets,
            arguments.max_offsets,
        )
        query = start(
            raw,
            job,
            target=f"{arguments.store}/staged/{job.table}",
            checkpoint=f"{arguments.store}/checkpoints/{job.name}",
            trigger={"processingTime": arguments.interval},
        )
        query.awaitTermination()
    finally:
        if query is not None:
            query.stop()
        spark.streams.removeListener(log)
        spark.stop()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--bootstrap-servers", required=True)
    parser.add_argument("--store", required=True, help="folder shared by the cluster")
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--max-offsets", type=int)
    parser.add_argument("--interval", default="30 seconds")
    run(parser.parse_args(argv))


if __name__ == "__main__":
    main()
