"""Epoch handling. Text forms do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: epoch values above this are milliseconds.
MILLIS_ABOVE = 20_000_000_000

# Years 1 to 9999, which have a timestamp and a text form everywhere.
FIRST_S = -62_135_596_800
LAST_S = 253_402_300_799


def epoch_seconds(value: Column) -> Column:
    """Seconds from an epoch value given in seconds or in milliseconds."""
    return F.when(value > MILLIS_ABOVE, F.floor(value / F.lit(1000)).cast("long")).otherwise(value)


def usable_epoch(value: Column) -> Column:
    """Whether a raw epoch value, in either unit, lies in years 1 to 9999. Plain comparisons, which reach a scan."""
    return (value >= FIRST_S) & (value <= LAST_S * 1000 + 999)


def usable_seconds(seconds: Column) -> Column:
    return (seconds >= FIRST_S) & (seconds <= LAST_S)


def event_time(seconds: Column) -> Column:
    """Null outside years 1 to 9999."""
    return F.when(usable_seconds(seconds), F.timestamp_seconds(seconds))


def utc_text(seconds: Column) -> Column:
    """ISO-8601 text with offset, such as 2024-01-01T00:00:07+00:00; null outside years 1 to 9999."""
    # A timestamp without zone, counted from the epoch, shows UTC in every session.
    moment = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + seconds * F.expr("INTERVAL '1' SECOND")
    return F.when(
        usable_seconds(seconds), F.concat(F.translate(moment.cast("string"), " ", "T"), F.lit("+00:00"))
    )


def position_time(seconds: Column, fallback: Column | None = None) -> Column:
    """`utc_text`, with a fallback (now, unless given) for a missing, non-positive or far-off epoch."""
    if fallback is None:
        fallback = F.unix_timestamp(F.current_timestamp())
    return utc_text(F.when((seconds > 0) & (seconds <= LAST_S), seconds).otherwise(fallback.cast("long")))


def tumbling_id(seconds: Column, origin: Column, width: int) -> Column:
    """Number of the half-open window [origin + k*width, origin + (k+1)*width) holding `seconds`."""
    return F.floor((seconds - origin) / F.lit(width)).cast("long")
