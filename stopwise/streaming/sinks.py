"""Sinks.

The keyed sink makes at-least-once delivery effectively once. Its table is
partitioned by a function of the key, the slot, so all copies of a key meet in one
slot whatever times they carry. A micro-batch owns one folder per slot, which
a replay overwrites, and rows whose key is already stored elsewhere in their
slot are left out. Only the slots of the batch are opened, in one read, and files
carry the range of their days. There are 64 slots whatever the ids, and small
folders of a slot are merged, so the files that a batch opens do not grow
with the number of batches.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stopwise.operators.constraints import KEYS, enforced
from stopwise.sources import files

DAY = "event_date"
SLOT = "slot"
SLOTS = 64
FOLDERS = 16  # batch folders of a slot that are merged when there are more
MERGED = "merged"
_PLACE = f"{SLOT} int, run string, batch_id bigint"


def slot_of(event_id: str = "event_id") -> Column:
    """One of 64 slots: by the UTC day in an event id that ends in epoch seconds, so that
    a batch of new events meets few slots, else by hash."""
    seconds = F.try_to_number(F.regexp_extract(event_id, r":([0-9]{9,10})$", 1), F.lit("9999999999"))
    day = F.floor(seconds.cast("long") / 86_400)
    return F.pmod(F.coalesce(day, F.xxhash64(event_id)), F.lit(SLOTS)).cast("int")


def stored_rows(
    spark: SparkSession, target: str, columns: str, slots: Iterable[int]
) -> DataFrame | None:
    """Rows of some slots of a keyed table, with their place, in one read; None where there are none."""
    folders = files.existing(spark, [f"{target}/{SLOT}={slot}" for slot in sorted(slots)])
    if not folders:
        return None
    wanted = f"{columns}, {_PLACE}"
    return spark.read.schema(wanted).option("basePath", target).parquet(*folders)


def read_keyed(spark: SparkSession, target: str, *, with_day: bool = False) -> DataFrame:
    """A keyed table without its place columns; its day, for filters, if asked for."""
    rows = spark.read.parquet(target).drop(SLOT, "run", "batch_id")
    return rows if with_day else rows.drop(DAY)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)


def append_keyed(
    batch: DataFrame,
    batch_id: int,
    *,
    target: str,
    run: str,
    keys: list[str],
    time_column: str = "event_timestamp",
    table: str | None = None,
) -> None:
    """Append the rows of a micro-batch whose key is not stored yet."""
    spark = batch.sparkSession
    rows = batch if table is None else enforced(batch, table)
    rows = rows.dropDuplicates(keys).withColumns(
        {
            SLOT: slot_of(keys[0]),
            "run": F.lit(run),
            "batch_id": F.lit(batch_id).cast("bigint"),
            DAY: F.to_date(time_column),
        }
    )
    finish_merges(spark, target)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most 64, however large the batch.
        slots = [row[SLOT] for row in rows.select(SLOT).distinct().collect()]
        opened = stored_rows(spark, target, _ddl(batch), slots)
        new = rows
        if opened is not None:
            own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
            new = _without(rows, opened.where(~own).select(SLOT, *keys), keys)
        # A file per slot, and more only where a slot is large. A replay makes
        # the same slots, and exactly those are replaced.
        (
            new.hint("rebalance", SLOT)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(SLOT, "run", "batch_id")
            .parquet(target)
        )
        merge_folders(spark, target, slots, keys)
    finally:
        rows.unpersist()


def _without(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored in their slot.

    The stored keys the batch repeats are found first: there the batch is the
    side that may be broadcast, so stored keys are scanned but not shuffled as
    long as the batch is measured as small.
    """
    place = [SLOT, *keys]
    repeated = stored.join(rows.select(*place), place, "left_semi").select(*place)
    return rows.join(repeated, place, "left_anti")


def _hidden(target: str, what: str) -> str:
    """Folders that begin with an underscore are no part of the table."""
    return f"{target}/_{what}"


def merge_folders(
    spark: SparkSession, target: str, slots: Iterable[int], keys: list[str], most: int = FOLDERS
) -> list[int]:
    """Rewrite the folders of slots that have more than ``most`` as one each, sorted by key.

    The writer calls this after a batch, so nothing else writes. The merged rows are complete in a hidden
    folder before the small folders make way for them by renames; a crash in between is
    made good by ``finish_merges`` before the next batch.
    """
    done = []
    for slot in slots:
        folder = f"{target}/{SLOT}={slot}"
        batches = [x for run in files.children(spark, folder) for x in files.children(spark, run)]
        if len(batches) <= most:
            continue
        rows = spark.read.parquet(*batches)
        staged = _hidden(target, f"merge/{slot}")
        # One task or a few, by size; files hold ranges of keys.
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(
            f"{staged}/run={MERGED}/batch_id=0"
        )
        files.rename(spark, folder, _hidden(target, f"old/{slot}"))
        files.rename(spark, staged, folder)
        files.delete(spark, _hidden(target, f"old/{slot}"))
        done.append(slot)
    return done


def finish_merges(spark: SparkSession, target: str) -> None:
    """Bring a merge that was cut off to its end, or drop it if it had not replaced anything."""
    for old in files.children(spark, _hidden(target, "old")):
        slot = old.rsplit("/", 1)[1]
        staged, folder = _hidden(target, f"merge/{slot}"), f"{target}/{SLOT}={slot}"
        if files.existing(spark, [staged]) and not files.existing(spark, [folder]):
            files.rename(spark, staged, folder)
        files.delete(spark, old)
    files.delete(spark, _hidden(target, "merge"))


def append_jdbc(
    batch: DataFrame, *, url: str, table: str, options: dict[str, str], writers: int = 4
) -> None:
    """Append to a database table; its key constraint decides about duplicates."""
    # A shuffle limits the connections without limiting the tasks before it.
    (
        batch.repartition(writers)
        .write.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .mode("append")
        .save()
    )


def start_keyed_sink(
    rows: DataFrame,
    *,
    table: str,
    target: str,
    checkpoint: str,
    query_name: str,
    trigger: dict[str, object] | None = None,
    time_column: str = "event_timestamp",
) -> StreamingQuery:
    """Named query into a keyed table; every 30 seconds unless told otherwise."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # The id of a query is stored in its checkpoint, so a restart keeps it.
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_keyed(
            batch,
            batch_id,
            target=target,
            run=run,
            keys=KEYS[table],
            time_column=time_column,
            table=table,
        )

    return (
        rows.writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .foreachBatch(write)
        .start()
    )


def start_console_sink(
    rows: DataFrame,
    checkpoint: str,
    query_name: str,
    interval: str = "10 seconds",
    num_rows: int = 20,
) -> StreamingQuery:
    """Print new rows in full."""
    return (
        rows.writeStream.format("console")
        .queryName(query_name)
        .outputMode("append")
        .options(checkpointLocation=checkpoint, truncate=False, numRows=num_rows)
        .trigger(processingTime=interval)
        .start()
    )


def start_memory_sink(
    rows: DataFrame, query_name: str, checkpoint: str | None = None, output_mode: str = "append"
) -> StreamingQuery:
    """Keep new rows as a temporary table, for tests."""
    writer = rows.writeStream.format("memory").queryName(query_name).outputMode(output_mode)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()
