"""Keyed trajectory state: each vehicle's recent points, carried from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wayfold.config import DEFAULTS, Settings
from wayfold.operators.labels import CLUSTER_FIELDS, cluster_one_frame, with_scores
from wayfold.schemas import LABELLED_COLUMNS
from wayfold.streaming.packed import PackedTrajectory

# One typed row per vehicle, so a batch costs one read and one write of state.
STATE = T.StructType(
    [
        T.StructField("x", T.ArrayType(T.DoubleType())),
        T.StructField("y", T.ArrayType(T.DoubleType())),
        T.StructField("speed", T.ArrayType(T.DoubleType())),
        T.StructField("datetime", T.ArrayType(T.LongType())),
        # Seconds already emitted that a not yet late copy could repeat.
        T.StructField("seen", T.ArrayType(T.LongType())),
        # What the idle timer is measured from, in milliseconds.
        T.StructField("active_ms", T.LongType()),
    ]
)

POINT_FIELDS = [
    T.StructField("vehicle", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("datetime", T.LongType()),
    T.StructField("grid_id", T.LongType()),
]
OUTPUT = T.StructType(POINT_FIELDS + CLUSTER_FIELDS)


OutputRow = Row(*OUTPUT.fieldNames())

# Points are (x, y, speed, grid_id) by second; the cell of a stored point is not needed again.
Points = dict[int, tuple]


def label_new_points(vehicle: str, history: Points, new: Points, settings: Settings) -> tuple[list[Row], Points]:
    """Rows for the new points, labelled in a frame of history and new points, and the points to keep.

    A new point replaces a stored one of the same second.
    """
    frame = {**history, **new}
    seconds = sorted(frame)
    points = [frame[t] for t in seconds]
    x, y, speed = (np.array([p[k] for p in points], float) for k in range(3))
    wanted = np.array([t in new for t in seconds])
    stats = cluster_one_frame(x, y, np.array(seconds, np.int64), speed, wanted, settings)
    at = np.flatnonzero(wanted)
    columns = [values.to_pylist() for values in stats.arrays(at)]
    rows = [
        OutputRow(vehicle, *points[i][:3], seconds[i], points[i][3], *described)
        for i, *described in zip(at.tolist(), *columns)
    ]
    return rows, {t: frame[t] for t in seconds[-settings.frame_points :]}


class TrajectoryProcessor(StatefulProcessor):
    """Merge a vehicle's new points with its last ones, label the new ones, keep the last ones.

    With `event_time`, copies of a second are resolved here by arrival (the
    first one wins) and a vehicle is forgotten once the watermark is `idle`
    past its last point. Otherwise copies were removed before (a later one
    would win) and the idle time runs on the clock.
    """

    def __init__(self, settings: Settings, event_time: bool, arrival: str | None):
        self.settings = settings
        self.event_time = event_time
        self.arrival = arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("trajectory", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.state.get()
        x, y, speed, seconds, seen, _ = stored or ([], [], [], [], [], 0)
        history = dict(zip(seconds, zip(x, y, speed)))

        # Copies go as they are read, so memory is bounded by the seconds in the batch.
        new: Points = {}
        arrived: dict[int, int] = {}
        emitted = set(seen)
        for row in rows:
            t = row.datetime
            if self.event_time:
                order = row[self.arrival]
                if t in emitted or (t in arrived and arrived[t] <= order):
                    continue
                arrived[t] = order
            new[t] = (row.x, row.y, row.speed, row.grid_id)
        if not new:
            return
        labelled, kept = label_new_points(key[0], history, new, self.settings)
        yield from labelled

        idle_ms = self.settings.idle_timeout_s * 1000
        if self.event_time:
            passed = timerValues.getCurrentWatermarkInMs() // 1000
            seen = [t for t in [*seen, *new] if t > passed]
            active = max(kept) * 1000
        else:
            active = timerValues.getCurrentProcessingTimeInMs()
        if stored is None:
            # One timer per vehicle; when it is due it is set anew if the vehicle moved on.
            self.handle.registerTimer(active + idle_ms)
        columns = [[p[k] for p in kept.values()] for k in range(3)]
        self.state.update((*columns, list(kept), list(seen), active))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.state.get()
        if stored is not None:
            due = stored[-1] + self.settings.idle_timeout_s * 1000
            if due > expiredTimerInfo.getExpiryTimeInMs():
                self.handle.registerTimer(due)
            else:
                self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def with_watermark(waypoints: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return waypoints.withWatermark("event_time", f"{settings.watermark_s} seconds")


def drop_repeats(waypoints: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Late rows and copies of (vehicle, event time) dropped; the keys hold the time, so state is bounded."""
    return with_watermark(waypoints, settings).dropDuplicates(["vehicle", "event_time"])


def trajectory_labels(
    waypoints: DataFrame,
    settings: Settings = DEFAULTS,
    arrival: str | None = None,
    density_scope: str = "emitted",
    packed: bool = False,
) -> DataFrame:
    """Labelled points of a stream of clean waypoints with `grid_id` and `event_time`.

    With `arrival` (a column that orders the copies of a second), late rows,
    copies, frames and idle vehicles are all handled in one keyed operator: one
    shuffle by vehicle and one state store. Without it, copies are dropped by
    `drop_repeats` first, which costs a second shuffle and store and keeps
    whichever copy of a batch is met first; vehicles then go idle by the clock.
    Needs the RocksDB state store.

    `packed` handles a vehicle's points as arrays instead of rows; a checkpoint
    belongs to the form it was started with.
    """
    by_event = arrival is not None
    rows = with_watermark(waypoints, settings) if by_event else drop_repeats(waypoints, settings)
    wanted = [f.name for f in POINT_FIELDS] + ["event_time"] + ([arrival] if by_event else [])
    keyed = rows.select(*wanted).groupBy("vehicle")
    run = keyed.transformWithStateInPandas if packed else keyed.transformWithState
    processor = PackedTrajectory if packed else TrajectoryProcessor
    points = run(
        statefulProcessor=processor(settings, by_event, arrival),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="EventTime" if by_event else "ProcessingTime",
    )
    return with_scores(points, settings, density_scope).select(*LABELLED_COLUMNS)
