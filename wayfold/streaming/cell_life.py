"""What becomes of a cell as time passes without news of it: it expires, and its episode ends.

Both take the per-batch aggregates of cells as a stream, with `updated_at` in epoch seconds. Time is the
watermark, so nothing happens late by the clock of one machine and a replay gives the same rows. A cell may be
silent for good; rows without `grid_id` are no cell and only carry the time on, so a source sends one (a heartbeat)
with every batch, whether or not it has cells.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wayfold.config import DEFAULTS, Settings
from wayfold.operators import cells

_LIVE = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("until", T.LongType())])


class CellLife(StatefulProcessor):
    """Hand on a cell's aggregates, each with whether the cell was live before, and add one when it expires.

    The added row has no congested point, as one that says the cell is smooth, and the time of expiry.
    """

    def __init__(self, columns: list[str], ttl_s: int):
        self.columns = columns
        self.ttl_s = ttl_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("live", _LIVE)
        self.row = Row(*self.columns, "was_live")

    def _expired(self, grid_id: int, batch_id: int, until: int) -> Row:
        known = {"grid_id": grid_id, "batch_id": batch_id, "updated_at": until, "congested_count": 0}
        return self.row(*[known.get(c) for c in self.columns], True)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:
            return
        stored = self.state.get()
        before = live = None if stored is None else (stored[0], stored[1])
        # One row a batch, so a call has as many as batches are read at once.
        for row in sorted(rows, key=lambda r: (r.updated_at, r.batch_id)):
            if live is not None and live[1] <= row.updated_at:
                yield self._expired(key[0], *live)
                live = None
            yield self.row(*[row[c] for c in self.columns], live is not None)
            live = (row.batch_id, row.updated_at + self.ttl_s) if row.congested_count > 0 else None
        if before is not None and live != before:
            self.handle.deleteTimer(before[1] * 1000)
        if live is None:
            self.state.clear()
        elif live != before:
            self.state.update(live)
            self.handle.registerTimer(live[1] * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.state.get()
        if stored is not None and stored[1] * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._expired(key[0], stored[0], stored[1])
            self.state.clear()

    def close(self) -> None:
        pass


def _timed(batches: DataFrame, late_s: int) -> DataFrame:
    return batches.withColumn("at", F.timestamp_seconds("updated_at")).withWatermark("at", f"{late_s} seconds")


def live_feed(batches: DataFrame, settings: Settings = DEFAULTS, late_s: int = 0) -> DataFrame:
    """The change feed of a stream of per-batch cell aggregates, in the columns of `cells.cell_feed`.

    Besides the events of a batch there is a `delete` for each cell that stays without news for the time to live,
    as soon as the watermark passes that time; its `batch_id` is that of the last news. A cell's batches must come
    in order of time up to `late_s` seconds. Needs the RocksDB state store; the state is two numbers a live cell.
    """
    columns = ["grid_id", "batch_id", "updated_at", *cells.CELL_COLUMNS]
    # The time column stays in, since the state's timers need it.
    rows = _timed(batches.select(*columns), late_s)
    kept = [f for f in rows.schema.fields if f.name != "at"]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in kept] + [T.StructField("was_live", T.BooleanType())])
    changed = rows.groupBy("grid_id").transformWithState(
        statefulProcessor=CellLife(columns, settings.live_ttl_s),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
    )
    return cells.feed_events(changed)


def ended_episodes(batches: DataFrame, settings: Settings = DEFAULTS, late_s: int = 0) -> DataFrame:
    """`cells.episodes` on a stream: a run of congested batches is emitted once it can't go on any more.

    Copies of a cell's time are dropped within the watermark, so their state is bounded as that of the runs.
    """
    # Not a filter by cell: time must pass with any row, smooth or a heartbeat, so these are a group of their own.
    cell = F.when(F.col("congested_count") > 0, F.col("grid_id"))
    marked = _timed(batches.select(cell.alias("grid_id"), "updated_at"), late_s)
    gap = settings.episode_gap_s
    runs = (
        marked.dropDuplicates(["grid_id", "at"])
        .groupBy("grid_id", F.session_window("at", f"{gap} seconds"))
        .agg(F.min("updated_at").alias("started_at"), F.max("updated_at").alias("last_update"), F.count(F.lit(1)).alias("updates"))
    )
    # The condition holds a result of the aggregation, so that it is not decided below the watermark.
    a_cell = F.when(F.col("last_update").isNotNull(), F.col("grid_id").isNotNull())
    return runs.filter(a_cell).select(
        "grid_id", "started_at", "last_update", (F.col("last_update") + gap).alias("ends_at"), "updates"
    )
