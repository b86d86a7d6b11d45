"""Historical waypoints cut into consecutive slices of time.

Every row gets its slice number in one pass; nothing loops over slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.functions.time import tumbling_id, usable_epoch
from wayfold.operators.clean import with_seconds


def time_span(waypoints: DataFrame) -> DataFrame:
    """First and last time: one row."""
    return waypoints.agg(F.min("datetime").alias("min_t"), F.max("datetime").alias("max_t"))


def replay_start(waypoints: DataFrame, head_s: int | None = None) -> Column:
    """Where replay begins: the first time, or, if `head_s` is given, that long before the last if that is later.

    A scalar subquery, so the value never leaves the cluster.
    """
    if head_s is None:
        return waypoints.agg(F.min("datetime").alias("start_t")).scalar()
    return waypoints.agg(F.greatest(F.min("datetime"), F.max("datetime") - head_s).alias("start_t")).scalar()


def sliced(
    waypoints: DataFrame,
    settings: Settings = DEFAULTS,
    head_s: int | None = None,
    start: int | None = None,
) -> DataFrame:
    """Add `window_id` and `window_start`; rows without a usable time are left out.

    All rows take part unless `head_s` (see `replay_start`, for example
    `settings.replay_head_s`) or `start` says otherwise; earlier rows are left
    out. With `start`, in epoch seconds, the rows are read once and may be a
    stream.
    """
    if start is not None and head_s is not None:
        raise ValueError("give start or head_s, not both")
    rows = with_seconds(waypoints.filter(usable_epoch(F.col("datetime"))))
    begin = replay_start(rows, head_s) if start is None else F.lit(start).cast("long")
    return (
        rows.withColumn("start_t", begin)
        .filter(F.col("datetime") >= F.col("start_t"))
        .withColumn("window_id", tumbling_id(F.col("datetime"), F.col("start_t"), settings.slice_s))
        .withColumn("window_start", F.col("start_t") + F.col("window_id") * settings.slice_s)
        .drop("start_t")
    )


def slice_counts(slices: DataFrame) -> DataFrame:
    """Rows per non-empty slice."""
    return slices.groupBy("window_id", "window_start").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("datetime").alias("first_t"),
        F.max("datetime").alias("last_t"),
    )
