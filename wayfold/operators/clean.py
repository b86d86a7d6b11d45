"""Cleaning of raw waypoints, and the count of what was dropped and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.functions.geo import grid_id, on_earth
from wayfold.functions.time import epoch_seconds, event_time, usable_epoch

REQUIRED = ["vehicle", "x", "y", "datetime"]

# Speeds beyond this, in km/h, are no measurements.
MAX_SPEED_KMH = 1_000_000.0


def in_service() -> Column:
    """Working with the ignition on; a missing flag counts as on.

    Spelled with null tests, not `coalesce`, because those reach a Parquet scan.
    """
    working, ignition = F.col("working"), F.col("ignition")
    return (working.isNull() | working) & (ignition.isNull() | ignition)


def doors_closed() -> Column:
    """A missing flag counts as closed."""
    up, down = F.col("door_up"), F.col("door_down")
    return (up.isNull() | ~up) & (down.isNull() | ~down)


def complete() -> Column:
    """All required fields are present and usable."""
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in REQUIRED])
    return present & on_earth(F.col("x"), F.col("y")) & usable_epoch(F.col("datetime"))


def usable_speed() -> Column:
    """The speed; 0 where it is missing, not finite or out of range."""
    speed = F.col("speed").cast("double")
    return F.when(speed.between(-MAX_SPEED_KMH, MAX_SPEED_KMH), speed).otherwise(F.lit(0.0))


def with_seconds(waypoints: DataFrame) -> DataFrame:
    """Bring `datetime` to seconds, once, before anything reads it as a time."""
    return waypoints.withColumn("datetime", epoch_seconds(F.col("datetime")))


def clean(waypoints: DataFrame) -> DataFrame:
    """Waypoints in service with doors closed, with all required fields in range and a speed.

    Row-wise only, so it works on batch tables and on streams alike, and the
    null tests and flags reach a Parquet scan.
    """
    return (
        with_seconds(waypoints.filter(complete() & in_service() & doors_closed()))
        .withColumn("speed", usable_speed())
        .withColumn("event_time", event_time(F.col("datetime")))
    )


def with_grid(waypoints: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return waypoints.withColumn("grid_id", grid_id(F.col("x"), F.col("y"), settings))


# What `skip_reason` gives, and whether position tracking takes such rows.
REASONS = {
    "no vehicle": False,
    "no position": False,
    "bad position": False,
    "no time": True,
    "bad time": True,
    "out of service": True,
    "door open": True,
    "kept": True,
}


def skip_reason() -> Column:
    """Why `clean` drops a row, or 'kept'. The first reason that applies counts."""
    return (
        F.when(F.col("vehicle").isNull(), "no vehicle")
        .when(F.col("x").isNull() | F.col("y").isNull(), "no position")
        .when(~on_earth(F.col("x"), F.col("y")), "bad position")
        .when(F.col("datetime").isNull(), "no time")
        .when(~usable_epoch(F.col("datetime")), "bad time")
        .when(~in_service(), "out of service")
        .when(~doors_closed(), "door open")
        .otherwise("kept")
    )


def is_trackable() -> Column:
    """Position tracking needs only a vehicle and a position; a bad time gets the fallback."""
    present = F.col("vehicle").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
    return present & on_earth(F.col("x"), F.col("y"))


def skip_counts(waypoints: DataFrame) -> DataFrame:
    """Totals of tracked, skipped and cleaned-away rows in one pass."""
    return (
        waypoints.select(is_trackable().alias("tracked"), skip_reason().alias("reason"))
        .groupBy("tracked", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def reason_counter(reason: str) -> str:
    """The name under which `with_counts` counts a reason."""
    return reason.replace(" ", "_")


def with_counts(waypoints: DataFrame, name: str = "intake") -> DataFrame:
    """Count rows, trackable rows, clean rows and rows skipped by reason while they pass, without a pass of their own.

    The totals are in a stream's progress, or in the query execution of a batch.
    """
    return waypoints.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_trackable()).alias("tracked"),
        *[F.count_if(skip_reason() == reason).alias(reason_counter(reason)) for reason in REASONS],
    )
