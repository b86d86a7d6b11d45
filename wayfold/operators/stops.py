"""Slow points near a stop (optional filter, off by default)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.functions.geo import grid_index, planar_metres


def _cells_around(centre: Column, reach: float, settings: Settings) -> Column:
    return F.sequence(grid_index(centre - reach, settings), grid_index(centre + reach, settings))


def stop_cells(stops: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Each distinct stop with every cell its radius can reach (one to four, as a rule)."""
    ns = settings.stop_radius_m / settings.metres_per_degree
    ew = ns / settings.cos_latitude
    # A little more than the radius, so that rounding at a cell border loses nothing.
    slack = 1.001
    return (
        stops.dropna()
        .distinct()
        .withColumn("gx", F.explode(_cells_around(F.col("stop_x"), ew * slack, settings)))
        .withColumn("gy", F.explode(_cells_around(F.col("stop_y"), ns * slack, settings)))
    )


def without_stop_dwell(waypoints: DataFrame, stops: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Drop points slower than the limit within the radius of any stop.

    Only slow points take part in the join; the others are passed on where they
    lie. An anti join on the cell, then the exact distance: work grows with the
    stops near a point, not with all stops. The join is left to Spark: broadcast
    while the stop cells are small, else by shuffle with skewed cells split.
    """
    near = stop_cells(stops, settings)
    slow = F.coalesce(F.col("speed") < settings.stop_speed_kmh, F.lit(False))
    points = waypoints.filter(slow).withColumn("gx", grid_index(F.col("x"), settings)).withColumn(
        "gy", grid_index(F.col("y"), settings)
    )
    distance = planar_metres(
        points["x"] - near["stop_x"], points["y"] - near["stop_y"], settings.cos_latitude, settings
    )
    dwelling = (
        (points["gx"] == near["gx"])
        & (points["gy"] == near["gy"])
        & (distance < settings.stop_radius_m)
    )
    return waypoints.filter(~slow).unionByName(points.join(near, dwelling, "left_anti").drop("gx", "gy"))
