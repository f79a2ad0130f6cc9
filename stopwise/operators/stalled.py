"""Vehicles that do not move although they are on a trip.

The movement within a time is the diagonal of the box around all positions in it, in metres on
a local plane. A vehicle is stalled at an observation if it has been seen for the whole window up to
it and moved no further than the limit. The four sides of the box are running extremes, so
nothing is joined with itself. Stalled observations without another one between them are an episode.

Tracks are cut by time with the window as overlap, so a vehicle with very many
observations is many groups.

Defined cases: rows without vehicle, time or a coordinate, and rows without a trip where one is asked
for, are left out; rows of the same instant are in each other's window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopwise.operators.slices import HALO, SLICE, sliced

# Limits of the rule.
MOVEMENT_METRES = 50.0
WINDOW_SECONDS = 600

# Metres of a degree of latitude, and of longitude at the equator.
LATITUDE_METRES, LONGITUDE_METRES = 110_574.0, 111_320.0


def movements(
    positions: DataFrame, window: int = WINDOW_SECONDS, *, on_trip: bool = True, width: int = 21_600
) -> DataFrame:
    """Per observation: vehicle_id, event_timestamp, trip_id, observed_seconds (how far back the window
    has observations), moved_metres."""
    known = positions.where(
        "vehicle_id IS NOT NULL AND event_timestamp IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"
    )
    if on_trip:
        known = known.where("trip_id IS NOT NULL")
    cut = sliced(
        known.select("vehicle_id", "trip_id", "event_timestamp", "latitude", "longitude"),
        "event_timestamp",
        width,
        window,
    ).withColumn("at", F.unix_micros("event_timestamp"))
    back = (
        Window.partitionBy("vehicle_id", SLICE).orderBy("at").rangeBetween(-window * 1_000_000, 0)
    )
    low, high = (f("latitude").over(back) for f in (F.min, F.max))
    west, east = (f("longitude").over(back) for f in (F.min, F.max))
    north = (high - low) * LATITUDE_METRES
    across = (east - west) * LONGITUDE_METRES * F.cos(F.radians((low + high) / 2))
    return cut.select(
        "vehicle_id",
        "trip_id",
        "event_timestamp",
        ((F.col("at") - F.min("at").over(back)) / 1_000_000).alias("observed_seconds"),
        F.sqrt(north * north + across * across).alias("moved_metres"),
        HALO,
    ).where(~F.col(HALO)).drop(HALO)


def stalled(
    positions: DataFrame,
    metres: float = MOVEMENT_METRES,
    window: int = WINDOW_SECONDS,
    *,
    seen: float = 0.9,
    on_trip: bool = True,
    width: int = 21_600,
) -> DataFrame:
    """Episodes: vehicle_id, first_at, last_at, observations, most_metres. ``seen`` is the part of the
    window that observations must reach back for."""
    found = movements(positions, window, on_trip=on_trip, width=width).withColumn(
        "still", (F.col("moved_metres") <= metres) & (F.col("observed_seconds") >= seen * window)
    )
    track = Window.partitionBy("vehicle_id").orderBy("event_timestamp", "moved_metres")
    alike = Window.partitionBy("vehicle_id", "still").orderBy("event_timestamp", "moved_metres")
    runs = found.withColumn("run", F.row_number().over(track) - F.row_number().over(alike))
    return (
        runs.where("still")
        .groupBy("vehicle_id", "run")
        .agg(
            F.min("event_timestamp").alias("first_at"),
            F.max("event_timestamp").alias("last_at"),
            F.count("*").alias("observations"),
            F.max("moved_metres").alias("most_metres"),
        )
        .drop("run")
    )
