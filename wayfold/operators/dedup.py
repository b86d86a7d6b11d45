"""One row per key, chosen by arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], arrival: str, extreme, value_at_extreme) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != arrival]
    return (
        df.groupBy(*keys)
        .agg(
            extreme(arrival).alias(arrival),
            *[value_at_extreme(c, arrival).alias(c) for c in rest],
        )
        .select(*df.columns)
    )


def first_arrival(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """Keep the row of each key that arrived first. `arrival` must be unique within a key.

    An aggregate rather than a ranking window: copies are merged before the
    shuffle, so a key with very many copies costs one row per task. Numbers,
    times and flags stay in hash aggregation; text columns would force a sort.
    """
    return _pick(df, keys, arrival, F.min, F.min_by)


def last_arrival(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """Keep the row of each key that arrived last."""
    return _pick(df, keys, arrival, F.max, F.max_by)
