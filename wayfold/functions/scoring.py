"""Travel-time index, density, severity and status of a labelled point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.functions.numbers import round_even

# The status names in stored tables and feeds.
CONGESTED = "Congested"
DWELLING = "Dwelling"
SMOOTH = "Smooth"
WARMING_UP = "Warming Up"


def travel_time_index(speed: Column, settings: Settings = DEFAULTS) -> Column:
    """Free-flow speed over actual speed; standstill counts as 1 km/h."""
    return round_even(F.lit(settings.free_flow_speed_kmh) / F.greatest(speed, F.lit(1.0)), 3)


def density_factor(cluster_points: Column, settings: Settings = DEFAULTS) -> Column:
    """Points of the cluster in units of the smallest cluster, kept within 1 to 5."""
    return F.least(F.greatest(cluster_points / F.lit(float(settings.min_samples)), F.lit(1.0)), F.lit(5.0))


def severity(cluster_id: Column, cluster_points: Column, tti: Column, settings: Settings = DEFAULTS) -> Column:
    """0 for noise, else density times half the travel-time index, at most 25."""
    slowness = F.least(F.greatest(tti / 2.0, F.lit(0.0)), F.lit(5.0))
    return F.when(
        cluster_id >= 0, round_even(density_factor(cluster_points, settings) * slowness, 2)
    ).otherwise(F.lit(0.0))


def is_dwelling(max_speed: Column, diagonal_m: Column, settings: Settings = DEFAULTS) -> Column:
    """Both limits are strict."""
    return (max_speed < settings.dwell_max_speed_kmh) & (diagonal_m < settings.dwell_max_diagonal_m)


def congestion_status(
    cluster_id: Column,
    frame_size: Column,
    max_speed: Column,
    diagonal_m: Column,
    settings: Settings = DEFAULTS,
) -> Column:
    return (
        F.when((cluster_id >= 0) & is_dwelling(max_speed, diagonal_m, settings), DWELLING)
        .when(cluster_id >= 0, CONGESTED)
        .when(frame_size < settings.frame_points, WARMING_UP)
        .otherwise(SMOOTH)
    )


def severity_band(value: Column) -> Column:
    return F.when(value >= 5, "heavy").when(value >= 2, "moderate").otherwise("mild")
