"""Streams of log lines: Kafka topics or text files."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .logs import file_position


def kafka_options(
    servers: str,
    topics: Iterable[str],
    reset: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``reset`` holds for the first start only (``smallest`` / ``largest`` are
    understood); afterwards the checkpoint's offsets count. Offsets that expired
    on the broker move on to the earliest available one instead of failing.
    """
    start = {"smallest": "earliest", "largest": "latest"}.get(reset, reset)
    if start not in ("earliest", "latest"):
        raise ValueError(f"reset must be earliest or latest, not {reset!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_lines(spark: SparkSession, servers: str, topics: Iterable[str], **options) -> DataFrame:
    """Message values as text, with their place; needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options))
    return message_lines(source.load())


def message_lines(messages: DataFrame) -> DataFrame:
    """Lines of Kafka messages: time stamp, topic and partition, and offset say which of two copies came last."""
    return messages.select(
        F.col("value").cast("string").alias("value"), F.unix_millis("timestamp").alias("src_time"),
        F.concat_ws("-", "topic", F.lpad(F.col("partition").cast("string"), 10, "0")).alias("src_name"),
        F.col("offset").alias("src_pos"))


def text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files that come into a folder, with their place."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select("value", *file_position())


def union_streams(streams: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, streams)
