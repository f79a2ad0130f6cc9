"""Row constraints of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCHEDULE_CLOCK = "'^[0-9]{1,3}:[0-5][0-9]:[0-5][0-9]$'"

# Columns every row must fill.
REQUIRED_COLUMNS = {
    "vehicle_positions": [
        "event_id",
        "vehicle_id",
        "event_timestamp",
        "feed_timestamp",
        "published_at",
        "ingested_at",
        "latitude",
        "longitude",
        "source",
        "schema_version",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
    ],
    "trip_stop_updates": [
        "event_id",
        "stop_update_index",
        "event_timestamp",
        "feed_timestamp",
        "ingested_at",
        "published_at",
        "trip_id",
        "source",
        "schema_version",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
    ],
    "service_alert_entities": [
        "event_id",
        "informed_entity_index",
        "alert_id",
        "event_timestamp",
        "feed_timestamp",
        "ingested_at",
        "published_at",
        "active_periods",
        "source",
        "schema_version",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
    ],
    "routes": ["route_id", "route_type"],
    "stops": ["stop_id"],
    "trips": ["trip_id", "route_id", "service_id"],
    "stop_times": ["trip_id", "stop_sequence", "stop_id"],
    "calendar": [
        "service_id",
        "monday",
        "tuesday",
        "wednesday",
        "thursday",
        "friday",
        "saturday",
        "sunday",
        "start_date",
        "end_date",
    ],
    "calendar_dates": ["service_id", "date", "exception_type"],
}

# Conditions a row must not contradict (null is no contradiction).
CONDITIONS = {
    "vehicle_positions": {
        "latitude in range": "latitude BETWEEN -90 AND 90",
        "longitude in range": "longitude BETWEEN -180 AND 180",
        "bearing in range": "bearing BETWEEN 0 AND 360",
        "odometer not negative": "odometer >= 0",
        "speed not negative": "speed_mps >= 0",
        "schema version positive": "schema_version > 0",
    },
    "trip_stop_updates": {
        "direction is 0 or 1": "direction_id IN (0, 1)",
        "stop id or sequence given": "stop_id IS NOT NULL OR stop_sequence IS NOT NULL",
        "stop sequence not negative": "stop_sequence >= 0",
        "start time is a clock time": "start_time RLIKE '^[0-9]{2,}:[0-5][0-9]:[0-5][0-9]$'",
    },
    "service_alert_entities": {
        "periods are a JSON array": "try_parse_json(active_periods) IS NOT NULL"
        " AND active_periods RLIKE '^\\\\s*[\\\\[]'",
        "direction is 0 or 1": "direction_id IN (0, 1)",
        "route type not negative": "route_type >= 0",
    },
    "routes": {
        "route id not blank": "trim(route_id) <> ''",
        "route type not negative": "route_type >= 0",
    },
    "stops": {
        "stop id not blank": "trim(stop_id) <> ''",
        "latitude in range": "stop_lat BETWEEN -90 AND 90",
        "longitude in range": "stop_lon BETWEEN -180 AND 180",
        "location type known": "location_type BETWEEN 0 AND 4",
        "wheelchair boarding known": "wheelchair_boarding BETWEEN 0 AND 2",
    },
    "trips": {
        "trip id not blank": "trim(trip_id) <> ''",
        "route id not blank": "trim(route_id) <> ''",
        "service id not blank": "trim(service_id) <> ''",
        "direction is 0 or 1": "direction_id IN (0, 1)",
        "wheelchair access known": "wheelchair_accessible BETWEEN 0 AND 2",
        "bikes allowed known": "bikes_allowed BETWEEN 0 AND 2",
    },
    "stop_times": {
        "trip id not blank": "trim(trip_id) <> ''",
        "stop id not blank": "trim(stop_id) <> ''",
        "stop sequence not negative": "stop_sequence >= 0",
        "arrival is a service time": f"arrival_time RLIKE {_SCHEDULE_CLOCK}",
        "departure is a service time": f"departure_time RLIKE {_SCHEDULE_CLOCK}",
        "pickup type known": "pickup_type BETWEEN 0 AND 3",
        "drop-off type known": "drop_off_type BETWEEN 0 AND 3",
        "timepoint is 0 or 1": "timepoint IN (0, 1)",
    },
    "calendar": {
        "service id not blank": "trim(service_id) <> ''",
        **{
            f"{day} is 0 or 1": f"{day} IN (0, 1)"
            for day in "monday tuesday wednesday thursday friday saturday sunday".split()
        },
        "dates in order": "end_date >= start_date",
    },
    "calendar_dates": {
        "service id not blank": "trim(service_id) <> ''",
        "exception type is 1 or 2": "exception_type IN (1, 2)",
    },
}

# Keys.
KEYS = {
    "vehicle_positions": ["event_id"],
    "trip_stop_updates": ["event_id", "stop_update_index"],
    "service_alert_entities": ["event_id", "informed_entity_index"],
    "routes": ["route_id"],
    "stops": ["stop_id"],
    "trips": ["trip_id"],
    "stop_times": ["trip_id", "stop_sequence"],
    "calendar": ["service_id"],
    "calendar_dates": ["service_id", "date"],
}


def broken(table: str, columns: list[str]) -> dict[str, Column]:
    """Constraint name to "this row breaks it"; absent optional columns are skipped."""
    checks = {f"{name} present": F.col(name).isNull() for name in REQUIRED_COLUMNS[table]}
    for name, condition in CONDITIONS[table].items():
        needed = [word for word in condition.replace("(", " ").replace(")", " ").split()]
        if any(column in needed for column in columns):
            checks[name] = ~F.coalesce(F.expr(condition), F.lit(True))
    return checks


def constraint_violations(rows: DataFrame, table: str) -> DataFrame:
    """Broken rows per constraint, in one pass over the table."""
    checks = broken(table, rows.columns)
    counts = rows.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])
    entries = [
        F.struct(F.lit(name).alias("name"), F.col(f"`{name}`").alias("n")) for name in checks
    ]
    return counts.select(F.explode(F.array(*entries)).alias("entry")).select(
        F.lit(table).alias("table_name"),
        F.col("entry.name").alias("constraint_name"),
        F.col("entry.n").alias("broken_rows"),
    )


def enforced(rows: DataFrame, table: str) -> DataFrame:
    """The same rows, failing the job that reads a broken one.

    The check travels with the rows, so nothing is read twice, and a write
    that meets a broken row commits nothing.
    """
    message = None
    for name, bad in broken(table, rows.columns).items():
        text = F.lit(f"{table}: {name}")
        message = F.when(bad, text) if message is None else message.when(bad, text)
    stop = F.when(message.isNotNull(), F.raise_error(message).isNull()).otherwise(F.lit(True))
    return rows.where(stop)
