"""The message source, as a batch and as a stream.

``kafka`` needs Spark's Kafka connector on the class path; ``parquet`` reads files
that hold the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import MESSAGE

OFFSETS = ("earliest", "latest")


def kafka_options(brokers: str, topic: str, starting_offsets: str) -> dict[str, str]:
    """Connector options; a gap in the topic is tolerated."""
    if starting_offsets not in OFFSETS:
        raise ValueError(f"starting_offsets must be one of {OFFSETS}, not {starting_offsets!r}")
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    *,
    brokers: str | None = None,
    topic: str | None = None,
) -> DataFrame:
    """All messages of a topic, or of a directory of message files."""
    if path is not None:
        return spark.read.schema(MESSAGE).parquet(path)
    if not (brokers and topic):
        raise ValueError("give path, or brokers and topic")
    options = kafka_options(brokers, topic, "earliest")
    return spark.read.format("kafka").options(**options).load()


def read_messages_stream(
    spark: SparkSession,
    path: str | None = None,
    *,
    brokers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "latest",
    files_per_trigger: int | None = None,
    offsets_per_trigger: int | None = None,
) -> DataFrame:
    """The stream of messages of a topic, or of the files added to a directory.

    A directory is always read from its first file.  A backlog is taken in
    micro-batches of at most ``files_per_trigger`` files, or ``offsets_per_trigger``
    messages of a topic; without a limit all of it is one.
    """
    if path is not None:
        reader = spark.readStream.schema(MESSAGE)
        if files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(path)
    if not (brokers and topic):
        raise ValueError("give path, or brokers and topic")
    options = kafka_options(brokers, topic, starting_offsets)
    if offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()
