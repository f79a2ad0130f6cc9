"""Life of operational alerts: from detections to one active and one resolved event.

Detections of the same thing have the same fingerprint. A detection within the cooldown after the
one before it belongs to the same alert; one that comes later begins a new one. An alert
becomes active when the watermark has passed its first detection, so that its beginning
is final, and is resolved when the watermark has passed its last one by the cooldown. So the events do
not depend on how detections were dealt to micro-batches, nor on their order
within the watermark.

The state of a fingerprint is its open alerts, a few numbers each, however many detections they
have; it is dropped with the last of them. Detections of one fingerprint meet in one task, a
row at a time.

Defined cases: detections without a time or type are left out; null route, direction, trip or vehicles
are values of their own; detections behind the watermark are dropped and counted by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stopwise.session import use_rocksdb

# Limits of the rule, and the kinds and states of an alert.
COOLDOWN_SECONDS = 600
WATERMARK = "180 seconds"
KINDS = ("bus_bunching", "stale_vehicle", "possible_stalled_vehicle", "excessive_delay")
ACTIVE, RESOLVED = "active", "resolved"

EVENTS = (
    "alert_fingerprint string, status string, first_detected_at timestamp, "
    "last_detected_at timestamp, detections long, observed_value double"
)
_US = 1_000_000


def fingerprint(*parts: str) -> Column:
    """The same for the same parts; a missing part differs from every text."""
    named = [F.coalesce(F.concat(F.lit("="), F.col(x).cast("string")), F.lit("-")) for x in parts]
    return F.sha2(F.concat_ws("\u001f", *named), 256)


def _micros(time: Column | str) -> Column:
    return F.unix_micros(time)


class _Life(StatefulProcessor):
    """Open alerts of one fingerprint, as intervals that are apart by more than the cooldown."""

    def __init__(self, cooldown: int) -> None:
        self._cooldown = cooldown * _US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getListState(
            "open", "first long, last long, detections long, observed double, told boolean"
        )

    def _wake(self, spans: list[tuple]) -> None:
        """A timer for what is next of each alert. One that is out of date finds nothing to do."""
        for first, last, _, _, told in spans:
            # Timers are in milliseconds and fire when the watermark is past them.
            at = last + self._cooldown if told else first
            self._handle.registerTimer(at // 1000 + 1)

    def _keep(self, spans: list[tuple]) -> None:
        if spans:
            self._open.put([tuple(x) for x in spans])
        else:
            self._open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spans = [tuple(x) for x in self._open.get()]
        spans += [(r.first, r.last, r.detections, r.observed, False) for r in rows]
        merged: list[tuple] = []
        for span in sorted(spans):
            if merged and span[0] - merged[-1][1] <= self._cooldown:
                a, b = merged[-1], span
                values = [x for x in (a[3], b[3]) if x is not None]
                merged[-1] = (a[0], max(a[1], b[1]), a[2] + b[2], max(values, default=None), a[4] or b[4])
            else:
                merged.append(span)
        self._keep(merged)
        self._wake(merged)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        left, out = [], []
        for first, last, detections, observed, told in sorted(tuple(x) for x in self._open.get()):
            if not told and first < now:
                out.append((key[0], ACTIVE, first, first, None, None))
                told = True
            if told and last + self._cooldown < now:
                out.append((key[0], RESOLVED, first, last, detections, observed))
            else:
                left.append((first, last, detections, observed, told))
        self._keep(left)
        self._wake([x for x in left if x[4]])
        for row in out:
            yield Row(alert_fingerprint=row[0], status=row[1], first=row[2], last=row[3], detections=row[4], observed=row[5])


_OUT = (
    "alert_fingerprint string, status string, first long, last long, detections long, observed double"
)


def lifecycle(
    detections: DataFrame, cooldown: int = COOLDOWN_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """Events of alerts of a stream of detections (alert_fingerprint, detected_at, observed_value).

    The session gets the RocksDB state store, as no other keeps a list and timers for one key.
    """
    use_rocksdb(detections.sparkSession)
    known = detections.where("alert_fingerprint IS NOT NULL AND detected_at IS NOT NULL")
    rows = known.withWatermark("detected_at", watermark).select(
        "alert_fingerprint",
        "detected_at",
        _micros("detected_at").alias("first"),
        _micros("detected_at").alias("last"),
        F.lit(1).cast("long").alias("detections"),
        F.col("observed_value").cast("double").alias("observed"),
    )
    found = rows.groupBy("alert_fingerprint").transformWithState(
        statefulProcessor=_Life(cooldown), outputStructType=_OUT, outputMode="Append", timeMode="EventTime"
    )
    return found.select(
        "alert_fingerprint",
        "status",
        F.timestamp_micros("first").alias("first_detected_at"),
        F.timestamp_micros("last").alias("last_detected_at"),
        "detections",
        F.col("observed").alias("observed_value"),
    )


def alerts_of(detections: DataFrame, cooldown: int = COOLDOWN_SECONDS) -> DataFrame:
    """The same events of a finished set of detections, by islands: the batch form, for
    history and for corrections."""
    from pyspark.sql import Window

    order = Window.partitionBy("alert_fingerprint").orderBy("at")
    rows = detections.where("alert_fingerprint IS NOT NULL AND detected_at IS NOT NULL").withColumn(
        "at", _micros("detected_at")
    )
    begins = F.coalesce(F.col("at") - F.lag("at").over(order) > cooldown * _US, F.lit(True))
    islands = (
        rows.withColumn("begins", begins.cast("int"))
        .withColumn("island", F.sum("begins").over(order))
        .groupBy("alert_fingerprint", "island")
        .agg(
            F.min("detected_at").alias("first_detected_at"),
            F.max("detected_at").alias("last_detected_at"),
            F.count("*").alias("detections"),
            F.max(F.col("observed_value").cast("double")).alias("observed_value"),
        )
    )
    none = F.lit(None)
    active = islands.select(
        "alert_fingerprint",
        F.lit(ACTIVE).alias("status"),
        "first_detected_at",
        F.col("first_detected_at").alias("last_detected_at"),
        none.cast("long").alias("detections"),
        none.cast("double").alias("observed_value"),
    )
    return active.unionByName(islands.withColumn("status", F.lit(RESOLVED)).drop("island"))
