"""Label every new point by clustering it with its vehicle's recent points.

Spark sorts the rows by (vehicle, block, time) and a vectorised Arrow function
slides over each sorted partition. It keeps the last few rows between Arrow
batches, so neither a vehicle nor a block is ever held whole. Only the cluster
numbers come from Python; scores and status are columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfold.config import DEFAULTS, Settings
from wayfold.functions import scoring
from wayfold.operators.dbscan import DENSE_WIDTH, Band, label_frames, label_long_frame, labels_from_near
from wayfold.operators.frames import time_block, with_context
from wayfold.schemas import LABELLED_COLUMNS

_CELLS_AT_ONCE = 1 << 19

# What the Arrow function adds. The last four describe the point's cluster and are null for noise.
CLUSTER_FIELDS = [
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("buffer_size", T.IntegerType()),
    T.StructField("cluster_points", T.IntegerType()),
    T.StructField("cluster_new", T.IntegerType()),
    T.StructField("cluster_max_speed", T.DoubleType()),
    T.StructField("cluster_diagonal_m", T.DoubleType()),
]
_HELPERS = ["block", "is_context", "pos", "tail"]


class FrameStats:
    """Cluster number and cluster description of each row of a buffer, filled frame by frame."""

    def __init__(self, rows: int):
        self.cluster_id = np.full(rows, -1, np.int32)
        self.buffer_size = np.zeros(rows, np.int32)
        self.cluster_points = np.zeros(rows, np.int32)
        self.cluster_new = np.zeros(rows, np.int32)
        self.max_speed = np.full(rows, np.nan)
        self.diagonal = np.full(rows, np.nan)

    def arrays(self, keep: np.ndarray) -> list[pa.Array]:
        noise = self.cluster_id[keep] < 0
        return [
            pa.array(self.cluster_id[keep]),
            pa.array(self.buffer_size[keep]),
            pa.array(self.cluster_points[keep], mask=noise),
            pa.array(self.cluster_new[keep], mask=noise),
            pa.array(self.max_speed[keep], mask=noise),
            pa.array(self.diagonal[keep], mask=noise),
        ]


def _params(settings: Settings) -> dict[str, float]:
    return {"eps": settings.eps, "min_samples": settings.min_samples, "time_scale": settings.time_scale_s}


def _diagonal(x_span, y_span, settings: Settings):
    ew = x_span * settings.metres_per_degree * settings.dwell_cos_latitude
    ns = y_span * settings.metres_per_degree
    return np.sqrt(ew * ew + ns * ns)


def cluster_frames(x, y, t, speed, low, new, last, settings: Settings) -> FrameStats:
    """Cluster frames of a time-ordered buffer.

    Frame k covers rows low[k]..last[k]; its rows from new[k] on get the results.
    """
    stats = FrameStats(len(x))
    size = last - low + 1
    emitted = last - new + 1
    rows = np.repeat(new, emitted) + np.arange(emitted.sum()) - np.repeat(np.cumsum(emitted) - emitted, emitted)
    stats.buffer_size[rows] = np.repeat(size, emitted)

    params = _params(settings)
    full = np.flatnonzero(size >= max(settings.frame_points, settings.min_samples))
    full = full[np.argsort(size[full], kind="stable")]
    dense = full[size[full] <= DENSE_WIDTH]
    if dense.size:
        width = int(size[dense[-1]])
        band = Band(x, y, t, width, eps=settings.eps, time_scale=settings.time_scale_s)
        unsure = np.concatenate([[0], np.cumsum(band.unsure)])
        doubtful = unsure[last[dense] + 1] > unsure[low[dense]]
        many = max(1, _CELLS_AT_ONCE // width**2)
        for settled in (True, False):
            chosen = dense[doubtful != settled]
            for at in range(0, chosen.size, many):
                take = chosen[at : at + many]
                _dense(stats, x, y, t, speed, low[take], new[take], last[take], band, settled, params, settings)
    for k in full[dense.size :]:
        span = slice(int(low[k]), int(last[k]) + 1)
        _long(stats, x, y, t, speed, span, np.arange(span.start, span.stop) >= new[k], params, settings)
    return stats


def _dense(stats, x, y, t, speed, low, new, last, band, settled, params, settings):
    # All frames of a call are equally wide; rows before `low` or after `last` are padding.
    begin = np.maximum(last - (band.width - 1), 0)
    index = begin[:, None] + np.arange(band.width)
    inside = (index >= low[:, None]) & (index <= last[:, None])
    wanted = inside & (index >= new[:, None])
    index = np.minimum(index, len(x) - 1)
    fx, fy = x[index], y[index]
    if settled:
        labels = labels_from_near(band.near_pairs(begin), inside, wanted, params["min_samples"])
    else:
        labels = label_frames(fx, fy, t[index], inside, wanted, **params)

    frame, place = np.nonzero(wanted & (labels >= 0))
    if frame.size == 0:
        return
    row, cluster = index[frame, place], labels[frame, place]
    member = labels[frame] == cluster[:, None]
    high, lowest = -np.inf, np.inf
    px, py = fx[frame], fy[frame]
    stats.cluster_id[row] = cluster
    stats.cluster_points[row] = np.count_nonzero(member, axis=1)
    stats.cluster_new[row] = np.count_nonzero(member & wanted[frame], axis=1)
    stats.max_speed[row] = np.where(member, speed[index[frame]], high).max(axis=1)
    stats.diagonal[row] = _diagonal(
        np.where(member, px, high).max(axis=1) - np.where(member, px, lowest).min(axis=1),
        np.where(member, py, high).max(axis=1) - np.where(member, py, lowest).min(axis=1),
        settings,
    )


def cluster_one_frame(x, y, t, speed, wanted, settings: Settings) -> FrameStats:
    """Cluster one frame of any length; `wanted` marks the rows that get the results."""
    stats = FrameStats(len(x))
    stats.buffer_size[:] = len(x)
    if len(x) >= max(settings.frame_points, settings.min_samples):
        _long(stats, x, y, t, speed, slice(0, len(x)), wanted, _params(settings), settings)
    return stats


def _long(stats, x, y, t, speed, span, wanted, params, settings):
    fx, fy, ft = x[span], y[span], t[span]
    if ft.size <= DENSE_WIDTH:
        everywhere = np.ones((1, ft.size), bool)
        labels = label_frames(fx[None], fy[None], ft[None], everywhere, wanted[None], **params)[0]
    else:
        labels = label_long_frame(fx, fy, ft, **params)
    clustered = np.flatnonzero(labels >= 0)
    if clustered.size == 0:
        return
    cluster = labels[clustered]
    k = int(cluster.max()) + 1
    speed_top = np.full(k, -np.inf)
    np.maximum.at(speed_top, cluster, speed[span][clustered])
    spans = []
    for value in (fx[clustered], fy[clustered]):
        top, bottom = np.full(k, -np.inf), np.full(k, np.inf)
        np.maximum.at(top, cluster, value)
        np.minimum.at(bottom, cluster, value)
        spans.append(top - bottom)
    diagonal = _diagonal(*spans, settings)
    points = np.bincount(cluster, minlength=k)

    fresh = clustered[wanted[clustered]]
    cluster, row = labels[fresh], fresh + span.start
    stats.cluster_id[row] = cluster
    stats.cluster_points[row] = points[cluster]
    stats.cluster_new[row] = np.bincount(cluster, minlength=k)[cluster]
    stats.max_speed[row] = speed_top[cluster]
    stats.diagonal[row] = diagonal[cluster]


def _step_bounds(step, pos, fresh):
    """First and last row of each run of fresh rows that belong to the same group and step."""
    change = np.ones(fresh.size, bool)
    change[1:] = (np.diff(step[fresh]) != 0) | (np.diff(pos[fresh]) != 1)
    first = np.flatnonzero(change)
    return fresh[first], fresh[np.append(first[1:], fresh.size) - 1]


def _unpacked(batch: pa.RecordBatch, shift: int) -> tuple[pa.Table, int]:
    """A batch with the points of each `tail` as rows of their own, and `pos` counting them.

    `shift` is what the tail of the batch's first group, if it came earlier, added to `pos`.
    """
    n, tail = batch.num_rows, batch.column("tail")
    pos = batch.column("pos").to_numpy().astype(np.int64)
    is_tail = tail.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(is_tail, tail.value_lengths().fill_null(0).to_numpy(), 1).astype(np.int64)
    starts = pos == 1
    added = np.append(shift, (lengths - 1)[starts])[np.cumsum(starts)]

    row = np.repeat(np.arange(n), lengths)
    within = np.arange(row.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    of_tail = is_tail[row]
    number = np.where(of_tail, within + 1, pos[row] + added[row])
    points = tail.flatten()
    at = np.where(of_tail, n + np.cumsum(of_tail) - 1, row)
    index, own = pa.array(at), pa.array(row, mask=of_tail)
    columns = {}
    for name in batch.schema.names:
        if name == "tail" or name == "block":
            continue
        column = batch.column(name)
        if points.type.get_field_index(name) >= 0:
            flat = points.field(name)
            columns[name] = pa.concat_arrays([column, flat]).take(index)
        else:
            columns[name] = column.take(own)
    columns["is_context"], columns["pos"] = pa.array(of_tail), pa.array(number)
    return pa.table(columns), int(added[-1])


def _sorted_frames(
    settings: Settings, step: str | None, only: str | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function run over each sorted partition."""
    context = settings.frame_points

    def label(table: pa.Table, done: int, at_end: bool) -> tuple[pa.RecordBatch | None, pa.Table, int]:
        n = table.num_rows

        def numpy(name):
            return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)

        pos = numpy("pos").astype(np.int64)
        if not np.all((pos[1:] == 1) | (pos[1:] == pos[:-1] + 1)):
            raise ValueError("rows are not sorted by vehicle, block and time")
        fresh = done + np.flatnonzero(~numpy("is_context")[done:])
        if only is not None:
            fresh = fresh[table.column(only).fill_null(False).to_numpy()[fresh]]
        until = n
        if step is None:
            new = last = fresh
        else:
            new, last = _step_bounds(numpy(step), pos, fresh)
            if not at_end and new.size:
                # The next batch may continue the last step.
                until = int(new[-1])
                new, last = new[:-1], last[:-1]
                fresh = fresh[fresh < until]
        group = np.maximum(np.arange(n) - pos + 1, 0)
        low = np.maximum(group[new], new - context)
        stats = cluster_frames(
            numpy("x"), numpy("y"), numpy("datetime"), numpy("speed"), low, new, last, settings
        )
        out = None
        if fresh.size:
            kept = table.drop_columns([c for c in table.column_names if c in _HELPERS]).take(pa.array(fresh)).combine_chunks()
            arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in kept.columns]
            out = pa.RecordBatch.from_arrays(
                arrays + stats.arrays(fresh), names=kept.column_names + [f.name for f in CLUSTER_FIELDS]
            )
        begin = max(0, until - context)
        return out, table.slice(begin), until - begin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, shift = None, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table, shift = _unpacked(batch, shift)
            if held is not None:
                table = pa.concat_tables([held, table])
            out, held, done = label(table, done, at_end=False)
            if out is not None:
                yield out
        if held is not None and done < held.num_rows:
            out, _, _ = label(held, done, at_end=True)
            if out is not None:
                yield out

    return run


def cluster_points(
    rows: DataFrame,
    settings: Settings = DEFAULTS,
    step: str | None = None,
    block: Column | None = None,
    only: str | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Add the `CLUSTER_FIELDS` to every row.

    `rows` needs `vehicle, x, y, speed, datetime`, with (vehicle, datetime) unique.
    Without `step`, each point is one step: its frame is the point and the rows
    before it. With `step` (a column that grows with time), the rows of a vehicle
    with the same step are labelled together, in a frame of the rows before the
    step and the step itself; `block` must then keep each step in one block.
    With `only` (a boolean column, without `step`), rows where it is false stand in
    the frames of others, but get no frame of their own and are left out.
    """
    if only is not None and step is not None:
        raise ValueError("steps are labelled whole")
    if block is None:
        if step is not None:
            raise ValueError("steps need a block expression that does not cut them")
        block = time_block(settings)
    framed = with_context(rows, block, settings.frame_points, before, packed=True)
    schema = T.StructType([f for f in framed.schema.fields if f.name not in _HELPERS] + CLUSTER_FIELDS)
    return framed.mapInArrow(_sorted_frames(settings, step, only), schema)


def with_scores(points: DataFrame, settings: Settings = DEFAULTS, density_scope: str = "emitted") -> DataFrame:
    """Turn cluster descriptions into travel-time index, severity and status.

    `density_scope` counts a cluster's points among the new rows only
    ('emitted') or in the whole frame ('frame').
    """
    if density_scope not in ("emitted", "frame"):
        raise ValueError("density_scope is 'emitted' or 'frame'")
    counted = F.col("cluster_new" if density_scope == "emitted" else "cluster_points")
    return (
        points.withColumn("tti", scoring.travel_time_index(F.col("speed"), settings))
        .withColumn("severity", scoring.severity(F.col("cluster_id"), counted, F.col("tti"), settings))
        .withColumn(
            "congestion_status",
            scoring.congestion_status(
                F.col("cluster_id"),
                F.col("buffer_size"),
                F.col("cluster_max_speed"),
                F.col("cluster_diagonal_m"),
                settings,
            ),
        )
        .withColumnRenamed("datetime", "event_ts")
    )


def label_points(
    rows: DataFrame,
    settings: Settings = DEFAULTS,
    step: str | None = None,
    block: Column | None = None,
    density_scope: str = "emitted",
    keep: Sequence[str] = (),
    only: str | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Labelled points in the declared layout, followed by `step` (if there is one) and `keep`; `only` and `before` as in
    `cluster_points`."""
    needed = ["vehicle", "x", "y", "speed", "datetime", "grid_id"]
    extra = ([step] if step else []) + list(keep)
    chosen = [only] if only and only not in extra else []
    labelled = cluster_points(rows.select(*needed, *extra, *chosen), settings, step, block, only, before)
    return with_scores(labelled, settings, density_scope).select(*LABELLED_COLUMNS, *extra)


def cluster_summary(points: DataFrame, step: str) -> DataFrame:
    """One row per cluster that has new points: size, speed and extent over its frame."""
    described = ["cluster_points", "cluster_new", "cluster_max_speed", "cluster_diagonal_m"]
    return (
        points.filter(F.col("cluster_id") >= 0)
        .groupBy("vehicle", step, "cluster_id")
        .agg(*[F.max(c).alias(c) for c in described])
        .withColumn("density", scoring.density_factor(F.col("cluster_new")))
    )
