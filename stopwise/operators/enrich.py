"""Joins against the static schedule.

Every join keeps all its left rows. Rows whose key is null cannot match, and
would otherwise all hash to one partition, so they are given throw-away keys
that spread them; the join condition still names them as unmatched. Hot keys
that are present are left to the runtime skew split, which may divide the left
side of these joins. No side is hinted as broadcast: the planner does that by
measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[Column, Column]],
    spread_by: Column,
) -> DataFrame:
    """Left join on equal keys; the first key must be text.

    ``spread_by`` is any column of the left side that varies between rows.
    """
    lefts = [key for key, _ in keys]
    complete = reduce(lambda a, b: a & b, [key.isNotNull() for key in lefts])
    filler = F.concat(F.lit("~"), F.xxhash64(spread_by).cast("string"))
    first = F.when(complete, lefts[0]).otherwise(filler)
    matches = [first == keys[0][1]] + [mine == other for mine, other in keys[1:]]
    return left.join(right, reduce(lambda a, b: a & b, [*matches, complete]), "left")


def trip_stop_schedule(
    stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame
) -> DataFrame:
    """Scheduled stops with their trip, route and stop attributes."""
    st, t, r, s = (
        stop_times.alias("st"),
        trips.alias("t"),
        routes.alias("r"),
        stops.alias("s"),
    )
    row = F.struct("st.trip_id", "st.stop_sequence")
    joined = left_join(st, t, [(F.col("st.trip_id"), F.col("t.trip_id"))], row)
    joined = left_join(joined, r, [(F.col("t.route_id"), F.col("r.route_id"))], row)
    joined = left_join(joined, s, [(F.col("st.stop_id"), F.col("s.stop_id"))], row)
    return joined.select(
        "st.trip_id",
        "st.stop_sequence",
        "st.stop_id",
        F.col("st.arrival_time").alias("scheduled_arrival_time"),
        F.col("st.departure_time").alias("scheduled_departure_time"),
        "st.stop_headsign",
        "st.pickup_type",
        "st.drop_off_type",
        "st.timepoint",
        "t.route_id",
        "t.service_id",
        "t.trip_headsign",
        "t.trip_short_name",
        "t.direction_id",
        "t.block_id",
        "t.shape_id",
        "t.wheelchair_accessible",
        "t.bikes_allowed",
        "r.agency_id",
        "r.route_short_name",
        "r.route_long_name",
        "r.route_type",
        "r.route_color",
        "r.route_text_color",
        "s.stop_code",
        "s.stop_name",
        "s.stop_lat",
        "s.stop_lon",
        "s.location_type",
        "s.parent_station",
        "s.wheelchair_boarding",
        "s.platform_code",
    )


def vehicle_positions(positions: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Positions with trip and route; the event's own route wins over the trip's."""
    v, t, r = positions.alias("v"), trips.alias("t"), routes.alias("r")
    row = F.col("v.event_id")
    resolved = F.coalesce("v.route_id", "t.route_id")
    joined = left_join(v, t, [(F.col("v.trip_id"), F.col("t.trip_id"))], row)
    joined = left_join(joined, r, [(resolved, F.col("r.route_id"))], row)
    return joined.select(
        "v.*",
        resolved.alias("resolved_route_id"),
        F.col("t.route_id").alias("gtfs_trip_route_id"),
        "t.service_id",
        "t.trip_headsign",
        F.col("t.direction_id").alias("gtfs_direction_id"),
        "r.route_short_name",
        "r.route_long_name",
        "r.route_type",
        "r.route_color",
        F.col("t.trip_id").isNotNull().alias("has_gtfs_trip_match"),
        F.col("r.route_id").isNotNull().alias("has_gtfs_route_match"),
    )


def stop_updates(
    updates: DataFrame, schedule: DataFrame, routes: DataFrame, stops: DataFrame
) -> DataFrame:
    """Stop updates with their scheduled stop; attributes fall back to the event's own ids."""
    u, sc, r, s = updates.alias("u"), schedule.alias("sc"), routes.alias("r"), stops.alias("s")
    row = F.struct("u.event_id", "u.stop_update_index")
    resolved = F.coalesce("u.route_id", "sc.route_id")
    joined = left_join(
        u,
        sc,
        [
            (F.col("u.trip_id"), F.col("sc.trip_id")),
            (F.col("u.stop_sequence"), F.col("sc.stop_sequence")),
        ],
        row,
    )
    joined = left_join(joined, r, [(resolved, F.col("r.route_id"))], row)
    joined = left_join(joined, s, [(F.col("u.stop_id"), F.col("s.stop_id"))], row)

    def either(second: str, *names: str) -> list[Column]:
        return [F.coalesce(f"sc.{name}", f"{second}.{name}").alias(name) for name in names]

    return joined.select(
        "u.*",
        resolved.alias("resolved_route_id"),
        F.col("sc.stop_id").alias("scheduled_stop_id"),
        "sc.scheduled_arrival_time",
        "sc.scheduled_departure_time",
        "sc.service_id",
        "sc.trip_headsign",
        F.col("sc.direction_id").alias("scheduled_direction_id"),
        *either("r", "route_short_name", "route_long_name", "route_type", "route_color"),
        *either("s", "stop_name", "stop_lat", "stop_lon", "parent_station", "platform_code"),
        F.col("sc.trip_id").isNotNull().alias("has_gtfs_schedule_match"),
        F.col("s.stop_id").isNotNull().alias("has_gtfs_stop_match"),
        (F.col("r.route_id").isNotNull() | F.col("sc.route_id").isNotNull()).alias(
            "has_gtfs_route_match"
        ),
    )


def alert_entities(
    alerts: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame
) -> DataFrame:
    """Informed entities with trip, route and stop."""
    a, t, r, s = alerts.alias("a"), trips.alias("t"), routes.alias("r"), stops.alias("s")
    row = F.struct("a.event_id", "a.informed_entity_index")
    resolved = F.coalesce("a.route_id", "t.route_id")
    joined = left_join(a, t, [(F.col("a.trip_id"), F.col("t.trip_id"))], row)
    joined = left_join(joined, r, [(resolved, F.col("r.route_id"))], row)
    joined = left_join(joined, s, [(F.col("a.stop_id"), F.col("s.stop_id"))], row)
    return joined.select(
        "a.*",
        resolved.alias("resolved_route_id"),
        "t.service_id",
        "t.trip_headsign",
        "r.route_short_name",
        "r.route_long_name",
        "r.route_color",
        "s.stop_name",
        "s.stop_lat",
        "s.stop_lon",
        "s.parent_station",
        "s.platform_code",
        F.col("t.trip_id").isNotNull().alias("has_gtfs_trip_match"),
        F.col("r.route_id").isNotNull().alias("has_gtfs_route_match"),
        F.col("s.stop_id").isNotNull().alias("has_gtfs_stop_match"),
    )
