"""Grid cells and planar distances in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.functions.numbers import is_finite, round_even


def grid_index(degrees: Column, settings: Settings = DEFAULTS) -> Column:
    """Row or column number of the cell a coordinate falls in."""
    return F.floor(degrees / F.lit(settings.grid_resolution)).cast("long")


def on_earth(x: Column, y: Column) -> Column:
    """Whether a position is a longitude and a latitude. Plain comparisons, which reach a scan; NaN fails them."""
    return x.between(-180.0, 180.0) & y.between(-90.0, 90.0)


def grid_id(x: Column, y: Column, settings: Settings = DEFAULTS) -> Column:
    """One number per cell, null off the earth. Cells one degree of latitude apart may share it; `grid_index`
    never does."""
    return F.when(on_earth(x, y), grid_index(x, settings) * 1000 + grid_index(y, settings))


def planar_metres(dx: Column, dy: Column, cos_latitude: float, settings: Settings = DEFAULTS) -> Column:
    """Length in metres of a small offset in degrees."""
    ew = dx * F.lit(settings.metres_per_degree) * F.lit(cos_latitude)
    ns = dy * F.lit(settings.metres_per_degree)
    return F.sqrt(ew * ew + ns * ns)


def valid_position(lat: Column, lon: Column) -> Column:
    return is_finite(lat) & is_finite(lon)


def cell_key(cell: Column, lat: Column, lon: Column) -> Column:
    """The cell number as text, or rounded coordinates where there is none."""
    return F.coalesce(
        cell.cast("string"),
        F.format_string("%.5f_%.5f", round_even(lat, 5), round_even(lon, 5)),
    )
