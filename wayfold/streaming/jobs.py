"""The two streaming jobs, from any source of waypoints to their sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wayfold.config import DEFAULTS, Settings
from wayfold.operators import clean, tracking
from wayfold.session import ROCKSDB
from wayfold.streaming.trajectory import trajectory_labels


@contextmanager
def stream_settings(
    spark: SparkSession, partitions: int | None = None, available_now: bool = False
) -> Iterator[None]:
    """Session settings a keyed stream needs while it starts, put back afterwards.

    A stream's state keeps the number of partitions of its first start, and each
    costs a store: choose `partitions` for the largest cluster the checkpoint is
    to serve. Without it the session's number counts.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    if available_now:
        # A stream that only drains what is there needs no empty batches; others need them for their timers.
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def congestion_labels(
    waypoints: DataFrame, settings: Settings = DEFAULTS, arrival: str | None = None, packed: bool = False
) -> DataFrame:
    """Raw waypoints to labelled points, on a stream. Totals are in its progress."""
    counted = clean.with_counts(waypoints)
    return trajectory_labels(clean.with_grid(clean.clean(counted), settings), settings, arrival, packed=packed)


def tracked_positions(
    waypoints: DataFrame, routes: DataFrame, arrival: str, fallback: Column | None = None
) -> DataFrame:
    """Raw waypoints to positions with routes: a stream joined to a static table. Totals are in its progress."""
    return tracking.vehicle_positions(clean.with_counts(waypoints), routes, fallback, keep=(arrival,))


def start(
    rows: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Run `sink` on each micro-batch, in append mode, with progress kept in `checkpoint`.

    A stream takes a copy of the session's settings when it starts; `partitions` as in `stream_settings`.
    """
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    with stream_settings(rows.sparkSession, partitions, available_now):
        return writer.start()
