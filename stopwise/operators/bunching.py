"""Bus bunching: vehicles of a route that follow each other too closely.

A headway is the time between a vehicle at a stop and the one before it there, on the same route and
direction. It is short if it is below the threshold. A pair of vehicles is bunched
where so many of its headways in a row, at whatever stops, are short; one long headway of the pair
ends the run.

Stops are cut by time: only whether a headway is short matters, so a slice needs the visits of
the threshold's length before it and a busy stop is many groups.

Defined cases: visits without a stop, vehicle or time are left out; a null route or direction is a
value of its own; a visit told several times counts once; a vehicle that follows itself is no
headway; visits at the same instant are taken in the order of vehicle ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopwise.operators.slices import HALO, SLICE, seconds, sliced

# Limits of the rule.
HEADWAY_SECONDS = 120
CONFIRMATIONS = 2

_LINE = ("route_id", "direction_id")
_PAIR = (*_LINE, "leader_id", "vehicle_id")


def headways(visits: DataFrame, threshold: int = HEADWAY_SECONDS, width: int = 3600) -> DataFrame:
    """Of visits (route_id, direction_id, stop_id, vehicle_id, observed_at): each with the vehicle before it
    and whether it follows within ``threshold`` seconds. Those without one before it in
    reach have no leader and are left out, as are vehicles that follow themselves."""
    known = visits.where(
        "stop_id IS NOT NULL AND vehicle_id IS NOT NULL AND observed_at IS NOT NULL"
    ).select(*_LINE, "stop_id", "vehicle_id", "observed_at").distinct()
    # A pair's long headways matter too, so a slice looks back for a whole one.
    cut = sliced(known, "observed_at", width, width)
    order = Window.partitionBy(*_LINE, "stop_id", SLICE).orderBy("observed_at", "vehicle_id")
    return (
        cut.withColumn("leader_id", F.lag("vehicle_id").over(order))
        .withColumn("leader_at", F.lag("observed_at").over(order))
        .where(~F.col(HALO) & F.col("leader_id").isNotNull() & (F.col("leader_id") != F.col("vehicle_id")))
        .withColumn("headway_seconds", F.round(seconds("observed_at") - seconds("leader_at"), 3))
        .where(F.col("headway_seconds") <= width)
        .withColumn("short", F.col("headway_seconds") < threshold)
        .drop(HALO, SLICE, "leader_at")
    )


def bunched(
    visits: DataFrame,
    threshold: int = HEADWAY_SECONDS,
    confirmations: int = CONFIRMATIONS,
    width: int = 3600,
) -> DataFrame:
    """Runs of at least ``confirmations`` short headways of a pair: route_id, direction_id, leader_id,
    vehicle_id, first_at, last_at, observations, least_headway_seconds."""
    order = ("observed_at", "stop_id")
    of_pair = Window.partitionBy(*_PAIR).orderBy(*order)
    alike = Window.partitionBy(*_PAIR, "short").orderBy(*order)
    # Numbers among all of the pair and among those alike differ by a constant within a run.
    runs = headways(visits, threshold, width).withColumn(
        "run", F.row_number().over(of_pair) - F.row_number().over(alike)
    )
    return (
        runs.where("short")
        .groupBy(*_PAIR, "run")
        .agg(
            F.min("observed_at").alias("first_at"),
            F.max("observed_at").alias("last_at"),
            F.count("*").alias("observations"),
            F.min("headway_seconds").alias("least_headway_seconds"),
        )
        .where(F.col("observations") >= confirmations)
        .drop("run")
    )
