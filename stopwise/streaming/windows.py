"""Figures of 60, 300 and 900 seconds from one pass over a stream, and their limits.

The stream is counted once, in append mode, into mergeable rows: per minute and class of
latency the records, and how many of them were invalid, dead letters or without a route. A
minute is written when the watermark has passed it, and is final then. Longer windows are
sums of those rows, so nothing reads the records again, and days counted apart and put
together give what one count over both gives.

Classes of latency are whole milliseconds up to 127; above, the first seven binary digits. A
class is named by its largest value, so a quantile is never understated and overstated by less than
a 64th. There are a few thousand classes at most, whatever the number of records, and records
are counted map-side, so a busy minute is no hot group.

Defined cases: records without a time are left out; those without an arrival are counted, but
not in the latency; one that arrives before its time has a latency of 0; a null mark is
false; late rows, behind the watermark, are dropped and counted by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limits of operation.
WATERMARK = "180 seconds"
WINDOWS = {"realtime": 60, "operational": 300, "trend": 900}
MAX_INVALID_RATIO = 0.01
MAX_DEAD_LETTER_RATIO = 0.005
WARN_MISSING_ROUTE_RATIO = 0.02
TARGET_P95_LATENCY_SECONDS = 60
WARN_LAG, CRITICAL_LAG = 10_000, 100_000

DIGITS = 7
_COUNTS = ("records", "invalid", "dead_letters", "missing_route")


def latency_class(millis: Column) -> Column:
    """The largest number with the same leading binary digits."""
    whole = F.when(millis < 0, 0).otherwise(millis).cast("long")  # greatest() would pass over a null
    rest = F.greatest(F.length(F.bin(whole)) - DIGITS, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), rest)
    return whole + (step - 1) - F.pmod(whole, step)


def minutes(records: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Counts of records (event_at, arrived_at, is_valid, is_dead_letter, route_id) by minute
    and class of latency; of a stream or of a finished table."""
    known = records.where("event_at IS NOT NULL")
    if known.isStreaming:
        known = known.withWatermark("event_at", watermark)
    millis = F.floor((F.unix_micros("arrived_at") - F.unix_micros("event_at")) / F.lit(1000))
    rows = known.select(
        "event_at",
        latency_class(millis).alias("latency_ms"),
        F.when(F.col("is_valid"), 0).otherwise(1).alias("invalid"),
        F.when(F.col("is_dead_letter"), 1).otherwise(0).alias("dead_letters"),
        F.isnull("route_id").cast("int").alias("missing_route"),
    )
    counted = rows.groupBy(F.window("event_at", f"{WINDOWS['realtime']} seconds"), "latency_ms").agg(
        F.count("*").alias("records"), *(F.sum(x).cast("long").alias(x) for x in _COUNTS[1:])
    )
    return counted.select(F.col("window.start").alias("window_start"), "latency_ms", *_COUNTS)


def rolled(counts: DataFrame, seconds: int) -> DataFrame:
    """The same rows for longer windows, a whole number of minutes each."""
    if seconds % WINDOWS["realtime"]:
        raise ValueError("a window must be a whole number of minutes")
    start = F.col("window_start").cast("long")
    return (
        counts.withColumn("window_start", F.timestamp_seconds(start - F.pmod(start, F.lit(seconds))))
        .groupBy("window_start", "latency_ms")
        .agg(*(F.sum(x).alias(x) for x in _COUNTS))
    )


def lag_status(lag: Column) -> Column:
    """State of the messages a consumer is behind by; null where that is unknown."""
    return (
        F.when(lag >= CRITICAL_LAG, "critical").when(lag >= WARN_LAG, "warning").when(lag >= 0, "ok")
    )


def figures(counts: DataFrame, share: float = 0.95) -> DataFrame:
    """Per window of such rows: records, ratios, a quantile of the latency, and the state.

    ``critical``: a largest ratio is exceeded; ``warning``: one to warn of is, or the latency
    is over its target. The sums before each class are running ones over the classes of
    a window, whose number is bounded.
    """
    order = Window.partitionBy("window_start").orderBy("latency_ms")
    whole = Window.partitionBy("window_start")
    timed = F.when(F.col("latency_ms").isNotNull(), F.col("records")).otherwise(0)
    merged = counts.groupBy("window_start", "latency_ms").agg(*(F.sum(x).alias(x) for x in _COUNTS))
    ranked = merged.withColumn("upto", F.sum(timed).over(order)).withColumn(
        "wanted", F.ceil(F.sum(timed).over(whole) * F.lit(share))
    )
    enough = (F.col("upto") >= F.col("wanted")) & F.col("latency_ms").isNotNull()
    found = ranked.groupBy("window_start").agg(
        *(F.sum(x).cast("long").alias(x) for x in _COUNTS),
        F.min(F.when(enough, F.col("latency_ms"))).alias("p95_latency_ms"),
    )
    ratios = found.select(
        "window_start",
        "records",
        *((F.col(x) / F.col("records")).alias(f"{x}_ratio") for x in _COUNTS[1:]),
        "p95_latency_ms",
    )
    critical = (F.col("invalid_ratio") > MAX_INVALID_RATIO) | (
        F.col("dead_letters_ratio") > MAX_DEAD_LETTER_RATIO
    )
    warning = (F.col("missing_route_ratio") > WARN_MISSING_ROUTE_RATIO) | F.coalesce(
        F.col("p95_latency_ms") > TARGET_P95_LATENCY_SECONDS * 1000, F.lit(False)
    )
    return ratios.withColumn(
        "status", F.when(critical, "critical").when(warning, "warning").otherwise("ok")
    )


def all_windows(counts: DataFrame) -> DataFrame:
    """Figures of every size, told apart by ``window_seconds``."""
    sizes = [
        figures(rolled(counts, seconds)).withColumn("window_seconds", F.lit(seconds))
        for seconds in WINDOWS.values()
    ]
    found = sizes[0]
    for one in sizes[1:]:
        found = found.unionByName(one)
    return found
