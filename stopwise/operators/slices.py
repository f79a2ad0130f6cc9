"""Cutting long tracks by time, so that a hot key is many groups and not one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"
HALO = "_halo"


def seconds(time: str) -> Column:
    return F.unix_micros(time) / F.lit(1_000_000)


def sliced(rows: DataFrame, time: str, width: int, reach: int) -> DataFrame:
    """The rows with ``_slice``, the slice of ``width`` seconds that they lie in, and once more, marked
    ``_halo``, for the next slice where they lie in its last ``reach`` seconds.

    A window of at most ``reach`` seconds back is then complete within a slice; results of
    halo rows are to be dropped, as they belong to the slice before. ``reach`` may not exceed ``width``.
    """
    if not 0 <= reach <= width:
        raise ValueError("reach must lie between 0 and the width of a slice")
    here = F.floor(seconds(time) / width).cast("long")
    left = (here + 1) * width - seconds(time)
    copies = F.when(left <= reach, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return rows.withColumn(HALO, F.explode(copies)).withColumn(
        SLICE, here + F.col(HALO).cast("long")
    )
