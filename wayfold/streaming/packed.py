"""Trajectory state in arrays: a vehicle's points of a batch are handled at once, and its state is one binary value.

The same results as `trajectory.TrajectoryProcessor`, which goes row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wayfold.config import Settings
from wayfold.operators.labels import cluster_one_frame

STATE = T.StructType([T.StructField("packed", T.BinaryType())])

_FLOATS = ("x", "y", "speed")


def pack(active_ms: int, points: dict[str, np.ndarray], seen: np.ndarray) -> bytes:
    """Time of activity, the last points column by column, and the emitted seconds a copy could still repeat."""
    head = np.array([active_ms, len(points["datetime"]), len(seen)], np.int64)
    columns = [points["datetime"].astype(np.int64), *(points[c].astype(np.float64) for c in _FLOATS), seen.astype(np.int64)]
    return b"".join(c.tobytes() for c in (head, *columns))


def unpack(packed: bytes) -> tuple[int, dict[str, np.ndarray], np.ndarray]:
    words = np.frombuffer(packed, np.int64)
    active_ms, n, _ = words[:3].tolist()
    points = {"datetime": words[3 : 3 + n]}
    for k, c in enumerate(_FLOATS, 1):
        points[c] = words[3 + k * n : 3 + (k + 1) * n].view(np.float64)
    return active_ms, points, words[3 + 4 * n :]


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _taken(points: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {c: v[rows] for c, v in points.items()}


def one_per_second(points: dict[str, np.ndarray], first: bool) -> dict[str, np.ndarray]:
    """Points by rising second, of each second the one with the first (or last) `order`."""
    points = _taken(points, np.lexsort((points["order"], points["datetime"])))
    t = points["datetime"]
    edge = np.flatnonzero(t[1:] != t[:-1])
    return _taken(points, np.append(0, edge + 1) if first else np.append(edge, len(t) - 1))


class PackedTrajectory(StatefulProcessor):
    """As `trajectory.TrajectoryProcessor`, on frames of points."""

    def __init__(self, settings: Settings, event_time: bool, arrival: str | None):
        self.settings = settings
        self.event_time = event_time
        self.arrival = arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("trajectory", STATE)

    def _new_points(self, frames: Iterator[pd.DataFrame], seen: np.ndarray) -> dict[str, np.ndarray] | None:
        """The batch's points, one a second; copies go frame by frame, so memory is bounded by the seconds."""
        new, met = None, 0
        for frame in frames:
            part = {c: frame[c].to_numpy(np.float64) for c in _FLOATS}
            part["datetime"] = frame["datetime"].to_numpy(np.int64)
            part["grid_id"] = frame["grid_id"].to_numpy(np.int64)
            part["order"] = frame[self.arrival].to_numpy() if self.event_time else np.arange(met, met + len(frame))
            met += len(frame)
            if len(seen):
                part = _taken(part, ~np.isin(part["datetime"], seen))
            if len(part["datetime"]):
                new = one_per_second(part if new is None else _joined([new, part]), self.event_time)
        return new

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = self.state.get()
        history, seen = None, np.zeros(0, np.int64)
        if stored is not None:
            _, history, seen = unpack(stored[0])
        new = self._new_points(rows, seen)
        if new is None:
            return
        frame = {c: new[c] for c in ("datetime", *_FLOATS)}
        wanted = np.ones(len(new["datetime"]), bool)
        if history is not None:
            # A new point replaces a stored one of its second.
            old = _taken(history, ~np.isin(history["datetime"], new["datetime"]))
            frame = _joined([old, frame])
            wanted = np.append(np.zeros(len(old["datetime"]), bool), wanted)
            order = np.argsort(frame["datetime"], kind="stable")
            frame, wanted = _taken(frame, order), wanted[order]
        stats = cluster_one_frame(
            frame["x"], frame["y"], frame["datetime"], frame["speed"], wanted, self.settings
        )
        yield self._labelled(key[0], new, stats, np.flatnonzero(wanted))

        kept = _taken(frame, np.s_[-self.settings.frame_points :])
        idle_ms = self.settings.idle_timeout_s * 1000
        if self.event_time:
            passed = timerValues.getCurrentWatermarkInMs() // 1000
            seen = np.append(seen, new["datetime"])
            seen = seen[seen > passed]
            active = int(kept["datetime"][-1]) * 1000
        else:
            active = timerValues.getCurrentProcessingTimeInMs()
        if stored is None:
            # One timer per vehicle; when it is due it is set anew if the vehicle moved on.
            self.handle.registerTimer(active + idle_ms)
        self.state.update((pack(active, kept, seen),))

    def _labelled(self, vehicle: str, new: dict[str, np.ndarray], stats, at: np.ndarray) -> pd.DataFrame:
        noise = stats.cluster_id[at] < 0
        whole = lambda values: pd.arrays.IntegerArray(values[at], noise)
        return pd.DataFrame(
            {
                "vehicle": np.full(len(at), vehicle, object),
                "x": new["x"],
                "y": new["y"],
                "speed": new["speed"],
                "datetime": new["datetime"],
                "grid_id": new["grid_id"],
                "cluster_id": stats.cluster_id[at],
                "buffer_size": stats.buffer_size[at],
                "cluster_points": whole(stats.cluster_points),
                "cluster_new": whole(stats.cluster_new),
                "cluster_max_speed": np.where(noise, np.nan, stats.max_speed[at]),
                "cluster_diagonal_m": np.where(noise, np.nan, stats.diagonal[at]),
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored = self.state.get()
        if stored is not None:
            due = unpack(stored[0])[0] + self.settings.idle_timeout_s * 1000
            if due > expiredTimerInfo.getExpiryTimeInMs():
                self.handle.registerTimer(due)
            else:
                self.state.clear()
        return iter(())

    def close(self) -> None:
        pass
