"""Active periods of alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def active_at(periods: Column, now: Column) -> Column:
    """No period at all means always active; ends are inclusive and may be open."""
    covering = F.exists(
        periods,
        lambda period: F.coalesce(period["start"] <= now, F.lit(True))
        & F.coalesce(period["end"] >= now, F.lit(True)),
    )
    return (
        F.when(periods.isNull() | (F.size(periods) == 0), F.lit(True))
        .otherwise(F.coalesce(covering, F.lit(False)))
    )
