"""Ratios and rounded statistics.

Rates are rounded half up on integers, so no result depends on how a decimal
fraction happens to be stored. All operands are counts or clamped at zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0).cast("bigint")))


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole``; null when there is nothing to divide by."""
    part, whole, scale = part.cast("bigint"), whole.cast("bigint"), 10**digits
    return _div(part * (200 * scale) + whole, whole * 2) / F.lit(float(scale))


def minutes_of_mean(total_seconds: Column, count: Column, digits: int = 2) -> Column:
    """Mean in minutes from a sum of seconds."""
    total_seconds, count, scale = total_seconds.cast("bigint"), count.cast("bigint"), 10**digits
    return _div(total_seconds * (2 * scale) + count * 60, count * 120) / F.lit(float(scale))


def minutes_of_decile(seconds: Column, digits: int) -> Column:
    """Minutes from an interpolated decile of whole seconds (a multiple of 0.1 s)."""
    tenths, scale = F.round(seconds * 10).cast("bigint"), 10**digits
    return _div(tenths * (2 * scale) + 600, F.lit(1200).cast("bigint")) / F.lit(float(scale))


def nearest_tenth(value: Column) -> Column:
    """A non-negative double rounded to one decimal, judged by its exact binary value.

    This is how display figures are rounded: 6.25 is a true tie and goes to
    the even 6.2, while 0.15 is stored slightly low and becomes 0.1. Splitting
    the value makes its product with 20 exact, which tells the cases apart.
    """
    doubled = value * 20
    scaled = value * 134_217_729.0
    high = scaled - (scaled - value)
    rest = (high * 20 - doubled) + (value - high) * 20
    tenths = F.floor(doubled / 2)
    on_half = (doubled == F.floor(doubled)) & (doubled % 2 == 1)
    up = F.when(on_half, (rest > 0) | ((rest == 0) & (tenths % 2 == 1))).otherwise(
        doubled / 2 - tenths >= 0.5
    )
    return (tenths + up.cast("int")) / F.lit(10.0)
