"""Instants, local times and service-day times (session time zone: UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: buckets are counted from 2000-01-01 00:00 UTC.
BUCKET_ORIGIN_EPOCH = 946_684_800
DAY_SECONDS = 86_400
_MICROS = 1_000_000


def to_local(instant: Column, zone: str) -> Column:
    """Wall clock of an instant."""
    return F.from_utc_timestamp(instant, zone)


def local_date(instant: Column, zone: str) -> Column:
    return F.to_date(to_local(instant, zone))


def to_instant(local: Column, zone: str) -> Column:
    """Instant of a wall clock; an hour that occurs twice means the later one.

    ``to_utc_timestamp`` picks the earlier of the two, so the instant one hour
    on is taken when it shows the same wall clock.
    """
    early = F.to_utc_timestamp(local, zone)
    late = early + F.expr("INTERVAL 1 HOUR")
    return F.when(to_local(late, zone) == local, late).otherwise(early)


def bucket_start(instant: Column, minutes: int) -> Column:
    """Start of the fixed-width bucket an instant falls into."""
    seconds = F.unix_seconds(instant)
    return F.timestamp_seconds(
        seconds - F.pmod(seconds - F.lit(BUCKET_ORIGIN_EPOCH), F.lit(minutes * 60))
    )


def service_seconds(clock: Column) -> Column:
    """Seconds of ``HH:MM:SS``, whose hours may pass 24."""
    parts = F.split(clock, ":")

    def part(position: int) -> Column:
        return F.get(parts, F.lit(position)).cast("int")

    return part(0) * 3600 + part(1) * 60 + part(2)


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds between two instants, halves away from zero."""
    return F.round((F.unix_micros(later) - F.unix_micros(earlier)) / _MICROS)


def nearest_service_instant(prediction: Column, seconds_of_service_day: Column, zone: str) -> Column:
    """Scheduled instant closest to a prediction.

    The schedule gives only a time of day, so it is placed on the local day of
    the prediction and moved by one day when that brings it closer. Of two instants that
    are equally close, half a day before and after, the earlier is meant.
    """
    wall_clock = to_local(prediction, zone)
    same_day = F.unix_seconds(F.date_trunc("day", wall_clock)) + seconds_of_service_day % DAY_SECONDS
    gap_days = (F.unix_micros(wall_clock) - same_day * _MICROS) / (DAY_SECONDS * _MICROS)
    shifted = same_day + F.ceil(gap_days - 0.5) * DAY_SECONDS
    return to_instant(F.timestamp_seconds(shifted), zone)


def age_seconds(instant: Column, now: Column) -> Column:
    """Whole seconds since an instant, never negative."""
    age = elapsed_seconds(now, instant)
    return F.when(age.isNotNull(), F.greatest(age, F.lit(0.0))).cast("bigint")


def within_seconds(instant: Column, now: Column, seconds: float) -> Column:
    """True when the instant is at most this old."""
    return F.unix_micros(instant) >= F.unix_micros(now) - F.lit(int(seconds * _MICROS))


def moment(value) -> Column:
    """Evaluation time: a datetime, a text, a column, or now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")
