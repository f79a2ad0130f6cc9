"""Spark session with the settings the plans rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Local-time arithmetic in the plans assumes a UTC session.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

# Big left sides are joined to schedule tables whose keys can be hot, so the
# runtime is allowed to split a hot partition even at the cost of a shuffle.
BATCH_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.streaming.stopGracefullyOnShutdown": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "false",
}


def build_session(
    app_name: str, *, master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """Create (or reuse) a session; ``extra`` wins over the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**BATCH_CONF, **STREAM_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Give a session made elsewhere the time zone the plans rely on."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)


def use_rocksdb(spark: SparkSession) -> None:
    """Give a session made elsewhere the state store that state with timers needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key) != STREAM_CONF[key]:
        spark.conf.set(key, STREAM_CONF[key])


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    Only a local session without the setting falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="stopwise-")
