"""Stored totals of a stream: what its batches observed, one small file a batch.

Counting costs no pass of its own (`clean.with_counts`), and a batch's file is replaced when the batch is repeated, so a
restart counts nothing twice. Spark reports a batch after it is committed: the driver's end in between loses that one
report, which shows as a gap in the batch ids of `batches`.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wayfold.operators.clean import REASONS, reason_counter
from wayfold.sources.tables import path_exists, write_text

_STORED = "query string, batch_id long, name string, counts map<string, long>"


class TotalsListener(StreamingQueryListener):
    """Write the observed counts of each batch of all streams started after it was added."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.running: set[str] = set()
        self.idle = threading.Event()
        self.idle.set()
        self.error: Exception | None = None

    def onQueryStarted(self, event) -> None:
        self.running.add(str(event.runId))
        self.idle.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, counts in progress.observedMetrics.items():
            row = {"query": str(progress.id), "batch_id": progress.batchId, "name": name, "counts": counts.asDict()}
            # A trigger without data reports the batch to come, with nothing observed.
            if not any(row["counts"].values()):
                continue
            try:
                write_text(self.spark, f"{self.path}/{progress.id}-{name}-{progress.batchId}.json", json.dumps(row))
            except Exception as error:  # Spark drops what a listener raises, so it is kept for the end.
                self.error = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.running.discard(str(event.runId))
        if not self.running:
            self.idle.set()


@contextmanager
def recorded(spark: SparkSession, path: str, wait_s: float = 60) -> Iterator[TotalsListener]:
    """Store the totals of the streams that run inside. The end waits for their last reports, and raises if a report
    could not be stored."""
    listener = TotalsListener(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
        if not listener.idle.wait(wait_s):
            raise TimeoutError("streams are still running")
    finally:
        spark.streams.removeListener(listener)
    if listener.error is not None:
        raise listener.error


def batches(spark: SparkSession, path: str) -> DataFrame:
    """One row a batch: query, batch_id, name of the observation, counts. Empty before the first."""
    if not path_exists(spark, f"{path}/*.json"):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).json(path)


def skip_totals(spark: SparkSession, path: str, name: str = "intake") -> DataFrame:
    """`clean.skip_counts` of all rows that went through the recorded streams."""
    counts = batches(spark, path).filter(F.col("name") == name).select("counts")
    kinds = [
        F.struct(F.lit(tracked).alias("tracked"), F.lit(reason).alias("reason"), F.col("counts")[reason_counter(reason)].alias("n"))
        for reason, tracked in REASONS.items()
    ]
    return (
        counts.select(F.inline(F.array(*kinds)))
        .groupBy("tracked", "reason")
        .agg(F.sum("n").alias("n"))
        .filter("n > 0")
    )
