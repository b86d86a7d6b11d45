"""Aggregates per grid cell, ranking, expiry and episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfold.config import DEFAULTS, Settings
from wayfold.functions import scoring
from wayfold.functions.geo import cell_key, valid_position
from wayfold.functions.numbers import fixed_text, number_or_zero, round_even, stable_mean
from wayfold.functions.time import utc_text

CELL_COLUMNS = ["congested_count", "cx", "cy", "avg_speed", "avg_tti", "severity", "point_count", "vehicles"]

# Digits kept when averaging: 1e-7 degree is about a centimetre.
POSITION_DIGITS = 7
SPEED_DIGITS = 6
TTI_DIGITS = 3


def cell_activity(waypoints: DataFrame) -> DataFrame:
    """Points, vehicles and mean speed per cell, before any labelling."""
    return waypoints.groupBy("grid_id").agg(
        F.count(F.lit(1)).alias("point_count"),
        F.countDistinct("vehicle").alias("vehicles"),
        stable_mean(F.col("speed"), SPEED_DIGITS).alias("avg_speed"),
        F.max("speed").alias("max_speed"),
    )


def cell_congestion(labelled: DataFrame, *by: str) -> DataFrame:
    """Congestion per cell (and per `by`): position and counts over all points, speed, index and
    severity over congested points only (null where there are none).

    The distinct count makes Spark aggregate by (cell, vehicle) first, so a cell
    with very many points is combined in many tasks before it reaches one.
    """
    congested = F.col("congestion_status") == scoring.CONGESTED
    return labelled.groupBy("grid_id", *by).agg(
        F.sum(F.when(congested, 1).otherwise(0)).alias("congested_count"),
        stable_mean(F.col("x"), POSITION_DIGITS).alias("cx"),
        stable_mean(F.col("y"), POSITION_DIGITS).alias("cy"),
        stable_mean(F.when(congested, F.col("speed")), SPEED_DIGITS).alias("avg_speed"),
        stable_mean(F.when(congested, F.col("tti")), TTI_DIGITS).alias("avg_tti"),
        F.max(F.when(congested, F.col("severity"))).alias("severity"),
        F.count(F.lit(1)).alias("point_count"),
        F.countDistinct("vehicle").alias("vehicles"),
    )


def worst_first() -> list[Column]:
    """Highest severity first; equal severities by cell number as text, descending."""
    return [F.desc("severity"), F.desc(F.col("grid_id").cast("string"))]


def top_cells(cells: DataFrame, n: int) -> DataFrame:
    """The `n` worst cells: each task keeps its own `n`, and only those are merged."""
    return cells.orderBy(*worst_first()).limit(n)


def ranked(cells: DataFrame, n: int) -> DataFrame:
    """`top_cells` with a rank. The window sees the at most `n` rows left by the limit."""
    return top_cells(cells, n).withColumn("rank", F.row_number().over(W.orderBy(*worst_first())))


def hot_cells(cells: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The report: worst congested cells with a usable position, ranked, with a severity band."""
    congested = cells.filter((F.col("congested_count") > 0) & valid_position(F.col("cy"), F.col("cx")))
    return ranked(congested, settings.top_cells).select(
        "rank",
        "grid_id",
        cell_key(F.col("grid_id"), F.col("cy"), F.col("cx")).alias("cell_key"),
        scoring.severity_band(F.col("severity")).alias("band"),
        *CELL_COLUMNS,
    )


def latest_cells(batches: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The newest aggregate of each cell over all batches. All columns are numbers, so this is one
    hash aggregation with a partial result per task."""
    values = [c for c in batches.columns if c not in ("grid_id", batch)]
    return batches.groupBy("grid_id").agg(
        F.max(batch).alias(batch), *[F.max_by(c, batch).alias(c) for c in values]
    )


def still_congested(cells: DataFrame) -> DataFrame:
    """A cell whose newest batch has no congested point is gone at once."""
    return cells.filter(F.col("congested_count") > 0)


def not_expired(cells: DataFrame, as_of: int | Column, settings: Settings = DEFAULTS) -> DataFrame:
    """A cell not refreshed within the time to live is gone. `updated_at` is in epoch seconds."""
    limit = (F.lit(as_of) if isinstance(as_of, int) else as_of) - settings.live_ttl_s
    return cells.filter(F.col("updated_at") > limit)


def cell_details(cells: DataFrame, *keep: str) -> DataFrame:
    """The live record of a cell, as text with fixed decimals."""
    return cells.select(
        "grid_id",
        *keep,
        F.lit(scoring.CONGESTED).alias("status"),
        fixed_text(F.col("avg_speed"), 2).alias("avg_speed"),
        fixed_text(F.col("avg_tti"), 2).alias("avg_tti"),
        fixed_text(F.col("severity"), 2).alias("severity"),
        F.col("point_count").cast("string").alias("point_count"),
        F.col("vehicles").cast("string").alias("vehicles"),
        fixed_text(F.col("cy"), 6).alias("centroid_lat"),
        fixed_text(F.col("cx"), 6).alias("centroid_lon"),
        utc_text(F.col("updated_at")).alias("updated_at"),
        F.col("batch_id").cast("string").alias("batch_id"),
    )


def served(details: DataFrame) -> DataFrame:
    """Ranked detail records read back as numbers, with defaults for missing or malformed text."""
    return details.select(
        "rank",
        F.col("grid_id").cast("string").alias("grid_id"),
        F.coalesce("status", F.lit(scoring.CONGESTED)).alias("status"),
        *[
            number_or_zero(F.col(c)).alias(c)
            for c in ("avg_speed", "avg_tti", "severity", "centroid_lat", "centroid_lon")
        ],
        *[number_or_zero(F.col(c), "bigint").alias(c) for c in ("point_count", "vehicles")],
        F.coalesce("updated_at", F.lit("")).alias("updated_at"),
        F.coalesce("batch_id", F.lit("")).alias("batch_id"),
    )


def cell_snapshot(index: DataFrame, details: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The served list from two stored tables: the severity index (cut to `top_cells` rows, hence safe
    to broadcast) joined to the details. An indexed cell without details is skipped. Expire the index
    before; an expired cell would take a place in the list."""
    worst = ranked(index.select("grid_id", "severity"), settings.top_cells).select("grid_id", "rank")
    return served(details.join(F.broadcast(worst), "grid_id"))


def live_cells(batches: DataFrame, as_of: int | Column, settings: Settings = DEFAULTS) -> DataFrame:
    """The served list after a history of per-batch aggregates.

    Expired cells go before the ranking, so they take no place in the list.
    Index and details come from the same rows here; the history is read once.
    """
    fresh = not_expired(still_congested(latest_cells(batches)), as_of, settings)
    return served(cell_details(ranked(fresh, settings.top_cells), "rank"))


def cell_feed(batches: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The change feed of a history of per-batch aggregates.

    A cell was live before a batch if its aggregate before had a congested point
    and had not expired. A window by cell holds one row per batch.
    """
    history = W.partitionBy("grid_id").orderBy("batch_id")
    was_live = (F.lag("congested_count").over(history) > 0) & (
        F.lag("updated_at").over(history) > F.col("updated_at") - settings.live_ttl_s
    )
    return feed_events(batches.withColumn("was_live", was_live))


def feed_events(changed: DataFrame) -> DataFrame:
    """One event per changed cell and batch: the new values, or a deletion of a cell that was live.

    `was_live` (null counts as false) says whether the cell was in the table
    before. A cell without congestion that was not in it is no change.
    """
    changed = changed.filter((F.col("congested_count") > 0) | F.col("was_live"))
    gone = F.col("congested_count") == 0

    def value(column: Column, digits: int) -> Column:
        return F.when(~gone, round_even(column, digits))

    return changed.select(
        "batch_id",
        F.col("grid_id").cast("string").alias("grid_id"),
        F.when(gone, "delete").otherwise("upsert").alias("op"),
        F.when(~gone, scoring.CONGESTED).alias("status"),
        value(F.col("avg_speed"), 2).alias("avg_speed"),
        value(F.col("avg_tti"), 2).alias("avg_tti"),
        value(F.col("severity"), 2).alias("severity"),
        F.when(~gone, F.col("point_count")).alias("point_count"),
        F.when(~gone, F.col("vehicles")).alias("vehicles"),
        F.when(~gone, F.col("cx")).alias("centroid_lon"),
        F.when(~gone, F.col("cy")).alias("centroid_lat"),
        utc_text(F.col("updated_at")).alias("updated_at"),
    )


def feed_text(feed: DataFrame) -> DataFrame:
    """Feed rows as JSON text with nulls kept."""
    return feed.select(
        F.col("grid_id").alias("key"),
        F.to_json(F.struct(*feed.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def episodes(updates: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Runs of updates of a cell with no pause longer than the gap.

    `updates` has `grid_id` and `updated_at` (epoch seconds). Equal times are
    merged first, so a run is as long as its time span, not as its row count.
    """
    times = updates.select("grid_id", "updated_at").distinct()
    return (
        times.withColumn("at", F.timestamp_seconds("updated_at"))
        .groupBy("grid_id", F.session_window("at", f"{settings.episode_gap_s} seconds"))
        .agg(
            F.min("updated_at").alias("started_at"),
            F.max("updated_at").alias("last_update"),
            F.count(F.lit(1)).alias("updates"),
        )
        .select(
            "grid_id",
            "started_at",
            "last_update",
            (F.col("last_update") + settings.episode_gap_s).alias("ends_at"),
            "updates",
        )
    )
