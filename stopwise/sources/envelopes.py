"""Event streams: Kafka, or files that carry the same envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stopwise import schemas


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source; the starting point counts only without a checkpoint."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of a topic; needs the Kafka connector on the class path."""
    options = kafka_options(bootstrap_servers, topic, starting_offsets, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def read_envelope_stream(
    spark: SparkSession, folder: str, file_format: str = "json", max_files_per_trigger: int = 1000
) -> DataFrame:
    """Stream of envelope files."""
    return (
        spark.readStream.format(file_format)
        .schema(schemas.ENVELOPE_TEXT)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(folder)
    )


def read_envelopes(spark: SparkSession, folder: str, file_format: str = "json") -> DataFrame:
    """The same files as a table, for back-fills."""
    return spark.read.format(file_format).schema(schemas.ENVELOPE_TEXT).load(folder)


def write_envelopes(messages: DataFrame, folder: str) -> None:
    """Write messages as envelope files, times to the microsecond."""
    columns = "key value topic partition offset timestamp".split()
    (
        messages.select(*columns)
        .write.mode("overwrite")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .json(folder)
    )
