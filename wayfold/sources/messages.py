"""Keyed JSON messages: the wire form of waypoints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.schemas import WAYPOINT, WAYPOINT_COLUMNS


def message_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic as a stream, from its end on, tolerating lost offsets. Progress lives in the checkpoint.

    `max_per_trigger` bounds a micro-batch and with it the rows one vehicle can
    have in one. Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
    return reader.options(**(options or {})).load()


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files as a stream, in order of modification."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def parse_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Message bytes or text to waypoint columns. A malformed record has nulls throughout."""
    parsed = F.from_json(F.col("value").cast("string"), WAYPOINT).alias("d")
    return messages.select(*keep, parsed).select(*keep, "d.*")


def to_messages(waypoints: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Waypoints as (key, value): the vehicle, and the record as JSON."""
    return waypoints.select(
        *keep,
        F.col("vehicle").cast("string").alias("key"),
        F.to_json(F.struct(*WAYPOINT_COLUMNS)).alias("value"),
    )


def write_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of messages. Needs Spark's Kafka connector."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
