"""Spark helpers the operators have in common."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_base(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="stopwise-llm-")
    return base.rstrip("/")


_SCRATCH: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder below that one, or below the innermost ``scratch``."""
    return f"{_SCRATCH[-1] if _SCRATCH else shared_base(spark)}/llm-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Within it, operators write their tables to one folder, which is deleted at its end.

    Their results read those tables, so use or store them inside, with a path taken outside.
    """
    folder = shared_folder(spark)
    _SCRATCH.append(folder)
    try:
        yield folder
    finally:
        _SCRATCH.remove(folder)
        delete(spark, folder)


def stored(rows: DataFrame, codec: str = "zstd") -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends here."""
    spark = rows.sparkSession
    path = shared_folder(spark)
    rows.write.option("compression", codec).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def stored_until(rows: DataFrame, path: str | None = None) -> tuple[DataFrame, str]:
    """As ``stored``, and the folder, for ``delete`` once nothing reads it any more."""
    spark = rows.sparkSession
    path = path or shared_folder(spark)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored_until`` named, wherever the shared folder is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def reclaim(spark: SparkSession) -> None:
    """Let Spark's cleaner find shuffle files and checkpoints that no frame refers to any
    more, so that rounds of an iteration do not pile up. Call it once per round.

    Python's references reach the JVM a moment after they are dropped, and the cleaner
    works in a thread of its own, hence the pauses.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.2)
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def held_packed(rows: DataFrame) -> DataFrame:
    """Rows of packed values as a checkpoint, for a table that only one operator reads.

    Where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, Spark deletes it as
    soon as nothing refers to it, so steps that follow find the disk free. Values are not
    compressed and columns not pruned, hence only for what is packed and read whole.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(rows.sparkSession))
    return rows.checkpoint()


def held_dealt(rows: DataFrame, count: int, key: str) -> DataFrame:
    """As ``held_packed``, dealt to partitions by a key, so that joins on it move the other side only.

    Under adaptive execution a checkpoint does not know how it is dealt, so that is off
    while this one is written.
    """
    conf = rows.sparkSession.conf
    name = "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return held_packed(rows.repartition(count, key))
    finally:
        conf.set(name, before)


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed."""
    root = str(Path(__file__).resolve().parents[2])
    settings = spark.sparkContext.environment
    known = [x for x in settings.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        settings["PYTHONPATH"] = os.pathsep.join([*known, root])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo the divisor; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))
