"""Rolling frames over each vehicle's history, without one task per vehicle.

A frame is a row with the `frame_points` rows before it. A plain window by
vehicle would put a vehicle's whole history in one task. Instead the history is
cut into blocks, each block is given the last rows of the blocks before it as
context, and every later step is grouped by (vehicle, block).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfold.config import DEFAULTS, Settings

GROUP = ["vehicle", "block"]


def time_block(settings: Settings = DEFAULTS) -> Column:
    return F.floor(F.col("datetime") / F.lit(settings.block_s)).cast("long")


def with_context(
    rows: DataFrame, block: Column, context: int, before: DataFrame | None = None, packed: bool = False
) -> DataFrame:
    """Add `block`, `is_context` and `pos` (1, 2, ... by time within vehicle and block).

    Every block also gets up to `context` rows that directly precede it, marked
    `is_context`. `block` must grow with time within a vehicle and
    (vehicle, datetime) must be unique. Rows that only precede others can be
    given packed: `before` has one row per vehicle, with `points`, an array of
    structs in the order of time, all earlier than the vehicle's rows; columns
    that the structs lack are null in context rows. With `packed`, a block's
    context is one row ahead of the others, with the structs in `tail`, which is
    null in these; `pos` counts it as one.

    Cost: the rows are shuffled once by (vehicle, block). The search for the
    preceding rows reads the same shuffle (one exchange, reused) and then moves
    at most `context` rows per block, packed in one; the union keeps the
    partitioning, so the numbering below needs no further exchange. The window
    by vehicle sees one row per block of a vehicle, not one per point.
    """
    blocks = rows.withColumn("block", block).repartition(*GROUP)

    newest = W.partitionBy(*GROUP).orderBy(F.desc("datetime"))
    if before is None:
        payload = ["datetime", *[c for c in rows.columns if c not in ("vehicle", "datetime")]]
    else:
        payload = before.schema["points"].dataType.elementType.names
    tails = (
        blocks.withColumn("from_end", F.row_number().over(newest))
        .filter(F.col("from_end") <= context)
        .groupBy(*GROUP)
        .agg(F.sort_array(F.collect_list(F.struct(*payload))).alias("tail"))
    )
    if before is not None:
        # A block ahead of all others: null is the first in the order below.
        none = F.lit(None).cast(tails.schema["block"].dataType)
        tails = tails.unionByName(before.select("vehicle", none.alias("block"), F.col("points").alias("tail")))
    # Each block holds at least one row, so `context` blocks back is far enough.
    before = W.partitionBy("vehicle").orderBy("block").rowsBetween(-context, -1)
    earlier = tails.select(*GROUP, F.flatten(F.collect_list("tail").over(before)).alias("p"))
    preceding = (
        earlier.filter((F.size("p") > 0) & F.col("block").isNotNull())
        .withColumn("p", F.slice("p", F.greatest(F.size("p") - (context - 1), F.lit(1)), context))
        .repartition(*GROUP)
    )
    if packed:
        preceding = preceding.withColumnRenamed("p", "tail")
    else:
        preceding = preceding.select(*GROUP, F.inline("p"))
    return (
        blocks.withColumn("is_context", F.lit(False))
        .unionByName(preceding.withColumn("is_context", F.lit(True)), allowMissingColumns=True)
        .withColumn("pos", F.row_number().over(W.partitionBy(*GROUP).orderBy("datetime")))
    )


def rolling_frames(
    rows: DataFrame,
    aggregates: Sequence[Column],
    settings: Settings = DEFAULTS,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Add aggregates over each row's frame, plus `buffer_size` and `warming_up`.

    `rows` needs `vehicle` and `datetime`, unique together.
    """
    names = names or [f"frame_{i}" for i in range(len(aggregates))]
    frame = W.partitionBy(*GROUP).orderBy("datetime").rowsBetween(-settings.frame_points, 0)
    out = with_context(rows, time_block(settings), settings.frame_points)
    for name, aggregate in zip(names, aggregates, strict=True):
        out = out.withColumn(name, aggregate.over(frame))
    return (
        out.withColumn("buffer_size", F.count(F.lit(1)).over(frame).cast("int"))
        .filter(~F.col("is_context"))
        .withColumn("warming_up", F.col("buffer_size") < settings.frame_points)
        .drop("block", "is_context", "pos")
    )


def newest_points(rows: DataFrame, n: int) -> DataFrame:
    """The last `n` rows of each vehicle by time.

    The rank is limited in each task before the shuffle (a partial top-n per
    vehicle), so a busy vehicle sends `n` rows per task.
    """
    newest = W.partitionBy("vehicle").orderBy(F.desc("datetime"))
    return rows.withColumn("from_end", F.row_number().over(newest)).filter(F.col("from_end") <= n)
