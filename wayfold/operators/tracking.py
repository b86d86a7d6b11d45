"""Position payloads, route enrichment and the latest position per vehicle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions.time import position_time, usable_seconds
from wayfold.operators.clean import is_trackable, usable_speed, with_seconds
from wayfold.schemas import POSITION_COLUMNS


def to_positions(waypoints: DataFrame, fallback: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trackable waypoints as position payloads, without routes."""
    return with_seconds(waypoints.filter(is_trackable())).select(
        *keep,
        F.col("vehicle").cast("string").alias("bus_id"),
        F.col("y").cast("double").alias("lat"),
        F.col("x").cast("double").alias("lng"),
        usable_speed().alias("speed"),
        position_time(F.col("datetime"), fallback).alias("timestamp"),
    )


def with_routes(positions: DataFrame, routes: DataFrame) -> DataFrame:
    """Left join to the route table; a vehicle without a route keeps nulls.

    No hint: Spark broadcasts the routes while they are below its own size
    threshold and otherwise joins by shuffle, where adaptive execution splits a
    busy vehicle.
    """
    named = routes.select(F.col("vehicle").alias("bus_id"), "route_id", "route_no")
    return positions.join(named, "bus_id", "left")


def vehicle_positions(
    waypoints: DataFrame, routes: DataFrame, fallback: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    return with_routes(to_positions(waypoints, fallback, keep), routes).select(*keep, *POSITION_COLUMNS)


def latest_waypoints(waypoints: DataFrame, arrival: str, by: str = "arrival") -> DataFrame:
    """The newest trackable waypoint of each vehicle, by arrival or by event time.

    `arrival` must be unique per vehicle. By arrival this is a hash aggregation
    over numbers; each task sends one row per vehicle. By event time the later
    arrival wins among equal times.
    """
    if by not in ("arrival", "event_time"):
        raise ValueError("by is 'arrival' or 'event_time'")
    trackable = with_seconds(waypoints.filter(is_trackable()))
    timed = F.when(usable_seconds(F.col("datetime")), F.col("datetime"))
    newest = F.col(arrival) if by == "arrival" else F.struct(timed, arrival)
    return trackable.groupBy("vehicle").agg(
        F.max_by(arrival, newest).alias(arrival),
        *[F.max_by(c, newest).alias(c) for c in ("x", "y", "speed", "datetime")],
    )


def latest_positions(
    waypoints: DataFrame,
    routes: DataFrame,
    arrival: str,
    fallback: Column | None = None,
    by: str = "arrival",
) -> DataFrame:
    """Latest position per vehicle. Routes and text are added after the aggregation, once per vehicle."""
    return vehicle_positions(latest_waypoints(waypoints, arrival, by), routes, fallback)


def position_feed(positions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Positions as JSON text keyed by vehicle, nulls kept."""
    return positions.select(
        *keep,
        F.col("bus_id").alias("key"),
        F.to_json(F.struct(*POSITION_COLUMNS), {"ignoreNullFields": "false"}).alias("value"),
    )
