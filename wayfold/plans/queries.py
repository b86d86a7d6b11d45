"""One query per operator, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS
from wayfold.functions.time import epoch_seconds, utc_text
from wayfold.operators import cells, clean, dedup, frames, labels, replay, stops, tracking
from wayfold.plans import fixtures as X
from wayfold.schemas import WAYPOINT_COLUMNS, WRAPPER
from wayfold.session import shared_folder
from wayfold.sources import archive, dimensions, keyed, log, messages
from wayfold.streaming import blocks, cell_life, jobs, sinks, totals, trajectory

KEY = ["vehicle", "datetime"]
CLEAN_COLUMNS = ["event_id", "vehicle", "x", "y", "speed", "datetime", "grid_id"]


def _clean_all(waypoints: DataFrame, *extra: str) -> DataFrame:
    return clean.with_grid(clean.clean(waypoints)).select(*CLEAN_COLUMNS, *extra)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.first_arrival(_clean_all(X.gps(spark, folder)), KEY, "event_id")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_points(_clean(spark, folder))


def slice_block(step: str):
    """Whole slices per block."""
    return F.floor(F.col(step) / F.lit(DEFAULTS.block_s // DEFAULTS.slice_s)).cast("long")


def _sliced(spark: SparkSession, folder: str) -> DataFrame:
    slices = replay.sliced(X.gps(spark, folder))
    return dedup.first_arrival(_clean_all(slices, "window_id", "window_start"), KEY, "event_id")


def _labelled_slices(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return labels.label_points(
        _sliced(spark, folder), step="window_id", block=slice_block("window_id"), keep=keep
    )


def _batches(spark: SparkSession, folder: str) -> DataFrame:
    """Per-slice cell aggregates: what a stream with one slice per micro-batch would produce."""
    slices = cells.cell_congestion(
        _labelled_slices(spark, folder, "window_start"), "window_id", "window_start"
    )
    return slices.withColumnsRenamed({"window_id": "batch_id", "window_start": "updated_at"})


def _routes(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.clean_routes(X.routes(spark, folder))


def gps_fixture(spark: SparkSession, folder: str) -> DataFrame:
    return X.gps(spark, folder)


def clean_waypoints(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder)


def frame_dedup_last(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.last_arrival(_clean_all(X.gps(spark, folder)), KEY, "event_id")


def skip_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return clean.skip_counts(X.gps(spark, folder))


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return messages.parse_messages(X.gps_messages(spark, folder), keep=["event_id"])


def wrapped_records(spark: SparkSession, folder: str) -> DataFrame:
    return archive.unwrap(X.gps_records(spark, folder), keep=("event_id",))


def array_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records written as objects over many lines, and read back in splits that end anywhere."""
    path = shared_folder(spark, "arrays")
    records = X.gps_records(spark, folder).select(F.to_json(F.struct(WRAPPER, *WAYPOINT_COLUMNS), {"pretty": "true"}))
    records.write.option("lineSep", ",\n").text(path)
    return archive.read_waypoints(spark, path, split=True)


def epoch_units(spark: SparkSession, folder: str) -> DataFrame:
    mixed = X.gps_mixed_units(spark, folder).select("event_id", F.col("datetime").alias("datetime_raw"))
    return mixed.withColumn("datetime", epoch_seconds(F.col("datetime_raw"))).withColumn(
        "event_time", utc_text(F.col("datetime"))
    )


def cell_activity(spark: SparkSession, folder: str) -> DataFrame:
    return cells.cell_activity(_clean(spark, folder))


def route_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return _routes(spark, folder)


def routes_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The route lines written as CSV, with the columns in another order and one more, and read back."""
    path = shared_folder(spark, "routes")
    lines = X.routes(spark, folder).coalesce(1).sortWithinPartitions("ordinal")
    lines.select("ordinal", "route_no", "vehicle", "route_id").write.csv(path, header=True)
    return dimensions.read_routes(spark, path)


def vehicle_positions(spark: SparkSession, folder: str) -> DataFrame:
    return tracking.vehicle_positions(
        X.gps(spark, folder), _routes(spark, folder), F.lit(X.FALLBACK_S), keep=("event_id",)
    )


def latest_positions(spark: SparkSession, folder: str) -> DataFrame:
    return tracking.latest_positions(
        X.gps(spark, folder), _routes(spark, folder), "event_id", F.lit(X.FALLBACK_S)
    )


def position_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The feed read back: its fields, and whether nulls were written too."""
    feed = tracking.position_feed(vehicle_positions(spark, folder), keep=("event_id",))
    fields = "lat double, lng double, speed double, timestamp string, route_id string, route_no string"
    return feed.select(
        "event_id",
        "key",
        F.from_json("value", fields).alias("p"),
        (F.size(F.json_object_keys("value")) == 7).alias("has_all_keys"),
    ).select("event_id", "key", "p.*", "has_all_keys")


def stop_dwell_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return stops.without_stop_dwell(_clean(spark, folder), X.stops(spark, folder))


def replay_windows(spark: SparkSession, folder: str) -> DataFrame:
    return replay.slice_counts(replay.sliced(X.gps(spark, folder), head_s=X.REPLAY_HEAD_S))


def rolling_frames(spark: SparkSession, folder: str) -> DataFrame:
    rows = _clean(spark, folder).select("vehicle", "datetime", "speed")
    return frames.rolling_frames(
        rows,
        [F.min("datetime"), F.max("speed")],
        X.split_settings(),
        names=["frame_start", "frame_max_speed"],
    ).drop("speed")


def newest_points(spark: SparkSession, folder: str) -> DataFrame:
    rows = _clean(spark, folder).select("vehicle", "datetime", "x", "y", "speed")
    return frames.newest_points(rows, DEFAULTS.frame_points)


def clustered_flag(spark: SparkSession, folder: str) -> DataFrame:
    return labels.cluster_points(_clean(spark, folder), X.split_settings()).select(
        "vehicle", F.col("datetime").alias("event_ts"), (F.col("cluster_id") >= 0).alias("clustered")
    )


def labelled_points(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder)


def labelled_points_10s(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled_slices(spark, folder)


def cluster_stats(spark: SparkSession, folder: str) -> DataFrame:
    points = labels.cluster_points(
        _sliced(spark, folder).select("vehicle", "x", "y", "speed", "datetime", "window_id"),
        step="window_id",
        block=slice_block("window_id"),
    )
    return labels.cluster_summary(points, "window_id")


def cell_congestion(spark: SparkSession, folder: str) -> DataFrame:
    return cells.cell_congestion(_labelled(spark, folder))


def hot_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cells.hot_cells(cells.cell_congestion(_labelled(spark, folder)))


def archive_by_status(spark: SparkSession, folder: str) -> DataFrame:
    """The archive written and read back."""
    path = shared_folder(spark, "archive")
    archive.write_archive(_labelled(spark, folder), path, batch_id=0)
    return (
        archive.read_archive(spark, path)
        .groupBy("congestion_status")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("vehicle").alias("vehicles"),
            F.max("severity").alias("max_severity"),
        )
    )


def archive_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The archive of three batches, the day compacted and cleaned after the second, read back."""
    path = shared_folder(spark, "compacted")
    _labelled(spark, folder).write.parquet(f"{path}/points")
    points = spark.read.parquet(f"{path}/points")
    for batch in range(3):
        since = (F.col("event_ts") - X.BASE_S) / X.ARCHIVE_STEP_S
        # The last batch has all the rest.
        of_batch = F.least(F.greatest(F.floor(since), F.lit(0)), F.lit(2)) == batch
        archive.write_archive(points.filter(of_batch), f"{path}/archive", batch)
        if batch == 1:
            archive.compact_archive(spark, f"{path}/archive", "9999-12-31", upto=1)
            archive.clean_archive(spark, f"{path}/archive")
    return (
        archive.read_archive(spark, f"{path}/archive")
        .groupBy("batch_id", "congestion_status")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("vehicle").alias("vehicles"),
            F.max("severity").alias("max_severity"),
        )
    )


def cell_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _batches(spark, folder)


def live_cells(spark: SparkSession, folder: str) -> DataFrame:
    settings = X.live_settings()
    return cells.live_cells(_batches(spark, folder), X.AS_OF, settings)


def cell_feed(spark: SparkSession, folder: str) -> DataFrame:
    return cells.cell_feed(_batches(spark, folder), X.live_settings())


def congestion_episodes(spark: SparkSession, folder: str) -> DataFrame:
    return cells.episodes(cells.still_congested(_batches(spark, folder)))


def _publish(spark: SparkSession, folder: str, path: str) -> Iterator[int]:
    """Write the events to a stream's input folder in `STREAM_BATCHES` parts, by arrival, one per step."""
    events = X.table(spark, folder, "events")
    end = events.agg(F.max("event_id") + 1).first()[0]
    bounds = [-(-end * b // X.STREAM_BATCHES) for b in range(X.STREAM_BATCHES + 1)]
    for b, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = events.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.write.mode("append").parquet(path)
        yield b


def _run_stream(spark: SparkSession, folder: str, name: str, transform, make_sink) -> str:
    """Feed the events part by part through a stream that is stopped and resumed in between."""
    path = shared_folder(spark, name)
    schema = X.table(spark, folder, "events").schema
    for _ in _publish(spark, folder, f"{path}/input"):
        waypoints = X.gps_from_events(messages.file_stream(spark, f"{path}/input", schema))
        query = jobs.start(
            transform(waypoints),
            make_sink(path),
            f"{path}/checkpoint",
            available_now=True,
            partitions=X.stream_partitions(spark),
        )
        query.awaitTermination()
    return path


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Watermark and duplicate removal on a stream."""

    def transform(waypoints: DataFrame) -> DataFrame:
        return trajectory.drop_repeats(clean.clean(waypoints)).select(*KEY)

    def make_sink(path: str):
        return lambda batch, batch_id: sinks.write_batch(batch, f"{path}/rows", batch_id)

    path = _run_stream(spark, folder, "stream-dedup", transform, make_sink)
    return spark.read.parquet(f"{path}/rows").select(*KEY)


def stream_skip_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Totals by reason, stored batch by batch while a stream runs, read back."""
    stored = shared_folder(spark, "totals")

    def make_sink(path: str):
        return lambda batch, batch_id: sinks.write_batch(batch, f"{path}/rows", batch_id)

    with totals.recorded(spark, stored):
        _run_stream(spark, folder, "stream-totals", lambda w: clean.with_counts(w).select("event_id"), make_sink)
    return totals.skip_totals(spark, stored)


def _stream_labels(waypoints: DataFrame) -> DataFrame:
    return jobs.congestion_labels(waypoints, arrival="event_id")


def stream_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Trajectory state on a stream: labels depend on what earlier micro-batches left behind."""

    def make_sink(path: str):
        return lambda batch, batch_id: sinks.write_batch(batch, f"{path}/rows", batch_id)

    path = _run_stream(spark, folder, "stream-labels", _stream_labels, make_sink)
    return spark.read.parquet(f"{path}/rows").drop("batch_id")


def stream_point_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of a stream from the message log, in micro-batches of bounded rows, dealt to tasks by vehicle and block."""
    path = shared_folder(spark, "stream-points")
    events = X.table(spark, folder, "events")
    segment_rows, batch_rows = X.log_rows(events.count())
    messages_of = log.SegmentLog(spark, f"{path}/log", events.schema, segment_rows)
    sink = blocks.BlockLabels(
        spark,
        f"{path}/state",
        "offset",
        lambda labels, batch_id: sinks.write_batch(labels, f"{path}/rows", batch_id),
        X.split_settings(),
        buckets=X.BUCKETS,
    )
    messages_of.append(events, "event_id", 0)
    rows = messages_of.stream(batch_rows)
    waypoints = clean.with_grid(clean.clean(X.gps_from_events(rows, keep=["offset"])))
    query = jobs.start(
        waypoints, sink, f"{path}/checkpoint", available_now=True, partitions=X.stream_partitions(spark)
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch_id")


def stream_live_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The served list after all micro-batches went through the congestion sinks.

    Batches are `STREAM_STEP_S` apart, so that some cells have expired by the last one.
    """

    def make_sink(path: str) -> sinks.CongestionSink:
        updated_at = F.col("batch_id") * X.STREAM_STEP_S + X.BASE_S
        return sinks.CongestionSink(spark, path, X.live_settings(), updated_at, buckets=X.BUCKETS, spare=X.SPARE)

    path = _run_stream(spark, folder, "stream-cells", _stream_labels, make_sink)
    return make_sink(path).snapshot(X.BASE_S + X.STREAM_BATCHES * X.STREAM_STEP_S)


def stream_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Latest positions after a tracking stream, joined to the static routes."""
    routes = _routes(spark, folder)

    def transform(waypoints: DataFrame) -> DataFrame:
        return jobs.tracked_positions(waypoints, routes, "event_id", F.lit(X.FALLBACK_S))

    def make_sink(path: str) -> sinks.TrackingSink:
        return sinks.TrackingSink(spark, path, "event_id", buckets=X.BUCKETS)

    path = _run_stream(spark, folder, "stream-positions", transform, make_sink)
    return make_sink(path).snapshot().drop("event_id")


def keyed_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Positions of a stream that its tasks write to a keyed folder by themselves; the latest of each vehicle read back."""
    path = shared_folder(spark, "keyed")
    keyed.register(spark)
    schema = X.table(spark, folder, "events").schema
    routes = _routes(spark, folder)
    for _ in _publish(spark, folder, f"{path}/input"):
        waypoints = X.gps_from_events(messages.file_stream(spark, f"{path}/input", schema))
        positions = jobs.tracked_positions(waypoints, routes, "event_id", F.lit(X.FALLBACK_S))
        writer = positions.writeStream.format(keyed.FORMAT).option("path", f"{path}/positions")
        query = writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    return keyed.read_latest(spark, f"{path}/positions", positions.schema, "bus_id", "event_id").drop("event_id")


def _run_cell_stream(spark: SparkSession, folder: str, name: str, transform) -> DataFrame:
    """Feed the per-batch aggregates part by part, each with a heartbeat, through a stream resumed in between.

    Two more heartbeats come long after the last batch: the first carries the time on, in the second all is over.
    """
    path = shared_folder(spark, name)
    _batches(spark, folder).write.parquet(f"{path}/batches")
    batches = spark.read.parquet(f"{path}/batches")
    end, last = batches.agg(F.max("batch_id") + 1, F.max("updated_at")).first()
    if end is None:
        end, last = 0, X.BASE_S
    bounds = [-(-end * b // X.STREAM_BATCHES) for b in range(X.STREAM_BATCHES + 1)]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        parts.append(batches.filter((F.col("batch_id") >= low) & (F.col("batch_id") < high)))
    for late in (1, 2):
        beat = spark.createDataFrame([(None, last + late * X.HEARTBEAT_S)], "grid_id long, updated_at long")
        parts.append(batches.limit(0).unionByName(beat, allowMissingColumns=True))
    for part in parts:
        part.write.mode("append").parquet(f"{path}/input")
        rows = transform(messages.file_stream(spark, f"{path}/input", batches.schema))
        query = jobs.start(
            rows,
            lambda batch, batch_id: sinks.write_batch(batch.withColumnsRenamed({"batch_id": "of_batch"}), f"{path}/rows", batch_id),
            f"{path}/checkpoint",
            available_now=True,
            partitions=X.stream_partitions(spark),
        )
        query.awaitTermination()
    found = spark.read.parquet(f"{path}/rows").drop("batch_id")
    return found.withColumnsRenamed({"of_batch": "batch_id"})


def stream_cell_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The change feed of a stream of batches, with a deletion for each cell that goes silent."""
    return _run_cell_stream(spark, folder, "stream-feed", lambda b: cell_life.live_feed(b, X.live_settings()))


def stream_episodes(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes of a stream of batches, each emitted once when it is over."""
    return _run_cell_stream(spark, folder, "stream-episodes", cell_life.ended_episodes)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        gps_fixture,
        clean_waypoints,
        frame_dedup_last,
        skip_reasons,
        json_roundtrip,
        wrapped_records,
        array_archive,
        epoch_units,
        cell_activity,
        route_dimension,
        routes_from_csv,
        vehicle_positions,
        latest_positions,
        position_feed,
        stop_dwell_filtered,
        replay_windows,
        rolling_frames,
        newest_points,
        clustered_flag,
        labelled_points,
        labelled_points_10s,
        cluster_stats,
        cell_congestion,
        hot_cells,
        archive_by_status,
        archive_compacted,
        cell_batches,
        live_cells,
        cell_feed,
        congestion_episodes,
        stream_dedup,
        stream_skip_reasons,
        stream_labels,
        stream_point_labels,
        stream_live_cells,
        stream_positions,
        keyed_positions,
        stream_cell_feed,
        stream_episodes,
    )
}
