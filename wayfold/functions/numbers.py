"""Rounding and means that do not depend on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


LOW_BITS = 20


def round_even(value: Column, digits: int) -> Column:
    """Half-even rounding of a double: scale, round to the nearest even integer, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def stable_mean(value: Column, digits: int) -> Column:
    """Mean of `value` taken in units of 10^-digits.

    The units are whole numbers. Their high and low bits are summed apart as
    longs, so the sum is exact for up to 2^43 rows whatever the partitioning,
    and a retried task cannot change the result. `value` must be finite, and
    below 2^63 in its units.
    """
    scale = float(10**digits)
    units = F.rint(value * scale).cast("long")
    high = F.sum(F.shiftright(units, LOW_BITS))
    low = F.sum(units.bitwiseAND(F.lit(2**LOW_BITS - 1).cast("long")))
    total = high.cast("decimal(20,0)") * F.lit(2**LOW_BITS) + low.cast("decimal(20,0)")
    return total.cast("double") / F.nullif(F.count(units), F.lit(0).cast("long")) / scale


def number_or_zero(text: Column, as_type: str = "double") -> Column:
    """Typed read of untrusted text: missing, blank or malformed becomes 0."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")).try_cast(as_type), F.lit(0).cast(as_type))


def fixed_text(value: Column, digits: int) -> Column:
    """Decimal text with a fixed number of digits, rounded half to even."""
    return F.format_string(f"%.{digits}f", round_even(value, digits))


def is_finite(value: Column) -> Column:
    """True for a present, ordinary number (neither NaN nor infinite)."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False))
