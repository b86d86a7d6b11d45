"""Streams give what the batch forms give, whatever the interruptions."""

from dataclasses import replace
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tests import brute
from wayfold.config import DEFAULTS
from wayfold.operators import cells, clean, dedup, labels, tracking
from wayfold.plans import fixtures as X
from wayfold.sources import dimensions, messages
from wayfold.streaming import jobs, sinks, trajectory

SCHEMA = "n long, vehicle string, speed double, datetime long, x double, y double, working boolean, ignition boolean, door_up boolean, door_down boolean"
BASE = 1_704_067_200


class Feed:
    """An input folder, a stream over it, and the rows each batch wrote."""

    def __init__(self, spark, path, transform, name="rows"):
        self.spark, self.path, self.transform, self.name = spark, str(path), transform, name

    def send(self, rows):
        part = rows if hasattr(rows, "write") else self.spark.createDataFrame(rows, SCHEMA)
        part.select(*[f.split()[0] for f in SCHEMA.split(", ")]).coalesce(1).write.mode("append").parquet(
            f"{self.path}/input"
        )

    def run(self, sink=None):
        waypoints = messages.file_stream(self.spark, f"{self.path}/input", SCHEMA, max_files=1)
        write = sink or (lambda b, i: sinks.write_batch(b, f"{self.path}/{self.name}", i))
        with jobs.stream_settings(self.spark):
            query = jobs.start(
                self.transform(waypoints), write, f"{self.path}/checkpoint-{self.name}", available_now=True
            )
            query.awaitTermination()

    def rows(self):
        return self.spark.read.parquet(f"{self.path}/{self.name}")


def point(n, vehicle, t, x=106.6, y=10.7, speed=0.0):
    return (n, vehicle, speed, BASE + t, x, y, True, True, False, False)


def keys(df):
    return sorted((r.vehicle, r.event_ts - BASE) for r in df.collect())


def by_arrival(waypoints):
    return jobs.congestion_labels(waypoints, arrival="n")


def by_clock(waypoints):
    return jobs.congestion_labels(waypoints)


def packed_by_arrival(waypoints):
    return jobs.congestion_labels(waypoints, arrival="n", packed=True)


def packed_by_clock(waypoints):
    return jobs.congestion_labels(waypoints, packed=True)


def brute_rows(parts):
    """Expected labels of (vehicle, batches of points) after removal of copies, first arrival first."""
    seen, steps = set(), {}
    for k, part in enumerate(parts):
        for n, vehicle, speed, t, x, y, *_ in sorted(part):
            if (vehicle, t) not in seen:
                seen.add((vehicle, t))
                steps.setdefault(vehicle, {}).setdefault(k, []).append((x, y, speed, t))
    return {
        (vehicle, *line)
        for vehicle, batches in steps.items()
        for line in brute.label_steps([batches[k] for k in sorted(batches)])
    }


def got_rows(df):
    columns = ["vehicle", "event_ts", "cluster_id", "congestion_status", "tti", "severity", "buffer_size"]
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def walk(vehicle, count, start, step, n0, drift=0.0, speed=0.0):
    return [
        point(n0 + i, vehicle, start + i * step, 106.6 + i * drift, 10.7 + (i * 7 % 5) * 1e-5, speed + i % 3)
        for i in range(count)
    ]


@pytest.fixture(scope="module")
def parts():
    """Out of order within the watermark, copies within and across batches, one catch-up batch of 150 points."""
    a, b, c = walk("a", 60, 0, 10, 0), walk("b", 200, 0, 3, 1000, 0.00002, 1.0), walk("c", 40, 5, 15, 3000, 0.0009, 30.0)
    first = a[:12] + b[:20] + c[:5] + [point(5000, "a", 50, 106.7)]
    second = a[14:33] + b[20:170] + c[5:30]
    third = a[12:14] + [point(5001, "a", 320, 106.7)] + a[33:60] + b[170:] + c[30:]
    return [first, second, third]


@pytest.mark.parametrize("transform", [by_arrival, by_clock, packed_by_arrival, packed_by_clock])
def test_stream_equals_frame_model(spark, tmp_path, parts, transform):
    feed = Feed(spark, tmp_path, transform)
    for part in parts:
        feed.send(part)
    feed.run()
    assert got_rows(feed.rows()) == brute_rows(parts)


@pytest.mark.parametrize("transform", [by_arrival, packed_by_arrival])
def test_restart_equals_uninterrupted_and_small_arrow_batches(spark, tmp_path, parts, transform):
    feed = Feed(spark, tmp_path, transform)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for part in parts:
            feed.send(part)
            feed.run()
        feed.run()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got_rows(feed.rows()) == brute_rows(parts)


def test_state_is_spread_over_partitions(spark, tmp_path, parts):
    feed = Feed(spark, tmp_path, by_arrival)
    feed.send(parts[0])
    feed.run()
    stores = [p for p in (tmp_path / "checkpoint-rows" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(stores) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("transform", [by_arrival, by_clock, packed_by_arrival])
def test_late_rows_and_copies_are_dropped(spark, tmp_path, transform):
    feed = Feed(spark, tmp_path, transform)
    feed.send([point(1, "a", 0), point(2, "a", 10)])
    feed.send([point(3, "a", 1000), point(4, "a", 10)])
    feed.send([point(5, "a", 1010), point(6, "a", 1000)])
    # Older than 1000 - 300 s, and unseen. (Spark tests lateness against the watermark of the batch before.)
    feed.send([point(7, "a", 20), point(8, "a", 1020), point(9, "a", 700)])
    feed.run()
    assert keys(feed.rows()) == [("a", t) for t in (0, 10, 1000, 1010, 1020)]


@pytest.mark.parametrize("transform", [by_arrival, packed_by_arrival])
def test_idle_vehicles_are_forgotten_by_event_time(spark, tmp_path, transform):
    feed = Feed(spark, tmp_path, transform)
    feed.send(walk("gone", 25, 0, 10, 0) + walk("stays", 25, 0, 10, 100))
    feed.send(walk("stays", 2, 1500, 10, 200))
    # Half an hour and five minutes after the last point of "gone" the watermark passes its timer.
    feed.send([point(300, "stays", 3000)])
    feed.send([point(301, "stays", 3010)])
    feed.send([point(302, "gone", 3020), point(303, "stays", 3020)])
    feed.run()
    size = {(r.vehicle, r.event_ts - BASE): r.buffer_size for r in feed.rows().collect()}
    assert size["gone", 3020] == 1
    assert size["stays", 3020] == 30


def test_idle_vehicles_are_forgotten_by_the_clock(spark, tmp_path):
    quick = replace(DEFAULTS, idle_timeout_s=1)
    feed = Feed(spark, tmp_path, lambda w: jobs.congestion_labels(w, quick))
    feed.send(walk("a", 25, 0, 10, 0))
    feed.run()
    import time

    time.sleep(1.5)
    feed.send([point(100, "b", 300)])
    feed.run()
    feed.send([point(101, "a", 310)])
    feed.run()
    size = {(r.vehicle, r.event_ts - BASE): r.buffer_size for r in feed.rows().collect()}
    assert size["a", 310] == 1


def test_stream_batch_equivalence_on_the_fixture(spark, small, tmp_path):
    """Thirteen files by arrival, the third sent twice: equal to the batch form with the same steps."""
    rows = X.gps(spark, small).withColumnRenamed("event_id", "n").cache()
    width = (rows.count() + 12) // 13
    feed = Feed(spark, tmp_path, by_arrival)
    for k in range(13):
        part = rows.filter(f"n >= {k * width} and n < {(k + 1) * width}")
        feed.send(part)
        if k == 2:
            feed.send(part)
    feed.run()
    cleaned = clean.with_grid(clean.clean(rows)).select("n", "vehicle", "x", "y", "speed", "datetime", "grid_id")
    stepped = dedup.first_arrival(cleaned, ["vehicle", "datetime"], "n").withColumn("step", F.floor(F.col("n") / width))
    expected = labels.label_points(stepped, step="step", block=F.lit(0)).drop("step")
    assert got_rows(feed.rows()) == got_rows(expected)


def test_congestion_sink_keeps_removes_and_repeats(spark, tmp_path):
    settings = replace(DEFAULTS, live_ttl_s=100)
    sink = sinks.CongestionSink(spark, str(tmp_path), settings, F.col("batch_id") * 30 + 1000)

    def labelled(rows):
        columns = "vehicle string, x double, y double, speed double, event_ts long, grid_id long, cluster_id int, congestion_status string, tti double, severity double, buffer_size int"
        return spark.createDataFrame(
            [(v, 106.6, 10.7, 5.0, 1, g, 0, status, 8.0, sev, 31) for v, g, status, sev in rows], columns
        )

    first = labelled([("a", 1, "Congested", 4.0), ("b", 2, "Congested", 6.0), ("c", 3, "Smooth", 0.0), ("d", 4, "Dwelling", 1.0)])
    second = labelled([("a", 1, "Smooth", 0.0), ("e", 5, "Congested", 4.0)])
    sink(first, 0)
    sink(labelled([]), 1)
    sink(second, 2)

    def live():
        return {r.grid_id: r.batch_id for r in sink.live.read().collect()}

    def feed():
        rows = spark.read.parquet(sink.feed).collect()
        return sorted((r.batch_id, r.grid_id, r.op) for r in rows)

    once = live(), feed(), spark.read.parquet(sink.archive).count()
    assert once[0] == {2: 0, 5: 2}
    assert once[1] == [(0, "1", "upsert"), (0, "2", "upsert"), (2, "1", "delete"), (2, "5", "upsert")]
    assert once[2] == 5
    sink(second, 2)
    assert (live(), feed(), spark.read.parquet(sink.archive).count()) == once

    assert [(r["rank"], r.grid_id) for r in sink.snapshot(1099).orderBy("rank").collect()] == [(1, "2"), (2, "5")]
    assert [(r["rank"], r.grid_id) for r in sink.snapshot(1100).collect()] == [(1, "5")]
    text = cells.feed_text(cells.cell_feed(sink.live.read())).first()
    assert '"op":"upsert"' in text.value and text.key in ("2", "5")


def test_live_table_stays_small_and_feeds_changes(spark, tmp_path):
    """Expired cells leave the table, old versions go, and the batch form gives the same events."""
    settings = replace(DEFAULTS, live_ttl_s=100)
    updated_at = F.col("batch_id") * 30 + 1000
    sink = sinks.CongestionSink(spark, str(tmp_path), settings, updated_at, keep_versions=2)
    columns = "vehicle string, x double, y double, speed double, event_ts long, grid_id long, cluster_id int, congestion_status string, tti double, severity double, buffer_size int"
    # Per batch: cells with and without congestion. Cell 9 expires before it turns smooth, cell 7 was never live.
    history = [([1, 9], [7]), ([1], []), ([2], [1]), ([3], [1]), ([3], []), ([3], [9, 2]), ([4], [3])]
    parts = []
    for number, (busy, smooth) in enumerate(history):
        marks = [(g, "Congested") for g in busy] + [(g, "Smooth") for g in smooth]
        part = spark.createDataFrame(
            [("a", 106.6, 10.7, 5.0, 1, g, 0, status, 8.0, 4.0, 31) for g, status in marks], columns
        )
        sink(part, number)
        parts.append(part.withColumn("batch_id", F.lit(number).cast("long")))
        assert len(list((tmp_path / "live").iterdir())) <= 2
    assert sorted(r.grid_id for r in sink.live.read().collect()) == [4]
    sink(parts[-1].drop("batch_id"), len(parts) - 1)
    assert sorted(r.grid_id for r in sink.live.read().collect()) == [4]

    batches = cells.cell_congestion(reduce(lambda a, b: a.union(b), parts), "batch_id")
    expected = cells.cell_feed(batches.withColumn("updated_at", updated_at), settings)
    got = spark.read.parquet(sink.feed).select(expected.columns)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in expected.collect()}
    gone = sorted((r.batch_id, r.grid_id) for r in got.filter("op = 'delete'").collect())
    assert gone == [(2, "1"), (5, "2"), (6, "3")]


def test_bad_messages_pass_through_a_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, by_arrival)
    bad = [(1e300, 10.7, 5), (float("inf"), 10.7, 6), (float("nan"), 10.7, 7), (106.6, -91.0, 8), (106.6, 10.7, 9 * 10**18 - BASE)]
    feed.send([point(n, "a", t, x=x, y=y) for n, (x, y, t) in enumerate(bad)] + [point(9, "a", 60, speed=float("inf"))])
    feed.run()
    assert [(r.vehicle, r.event_ts - BASE, r.speed) for r in feed.rows().collect()] == [("a", 60, 0.0)]


def test_failed_batch_is_not_swallowed(spark, tmp_path):
    feed = Feed(spark, tmp_path, by_arrival)
    feed.send([point(1, "a", 0)])

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        feed.run(broken)
    feed.run()
    assert keys(feed.rows()) == [("a", 0)]


def test_tracking_stream(spark, small, tmp_path):
    rows = X.gps(spark, small).withColumnRenamed("event_id", "n")
    routes = dimensions.clean_routes(X.routes(spark, small))
    feed = Feed(spark, tmp_path, lambda w: jobs.tracked_positions(w, routes, "n", F.lit(60)))
    total = rows.count()
    for k in range(4):
        feed.send(rows.filter(f"n >= {k * total // 4} and n < {(k + 1) * total // 4}"))
    sink = sinks.TrackingSink(spark, str(tmp_path / "tracking"), "n")
    feed.run(sink)
    expected = tracking.latest_positions(rows, routes, "n", F.lit(60))
    columns = ["bus_id", "lat", "lng", "speed", "timestamp", "route_id", "route_no"]
    assert {tuple(r) for r in sink.snapshot().select(*columns).collect()} == {
        tuple(r) for r in expected.select(*columns).collect()
    }
    assert spark.read.parquet(sink.feed).count() == tracking.to_positions(rows).count()
    nulls = spark.read.parquet(sink.feed).filter("value like '%\"route_no\":null%'").count()
    assert nulls > 0


def test_kafka_reader_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.message_stream(spark, "localhost:1", "topic", 100)


def test_watermark_plan(spark, tmp_path):
    stream = messages.file_stream(spark, str(tmp_path), SCHEMA)
    plan = trajectory.drop_repeats(clean.clean(stream))._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan and "5 minutes" in plan


def test_a_stream_has_a_partition_for_each_core(spark, tmp_path, monkeypatch):
    from wayfold.plans import fixtures as X
    from wayfold.plans import queries

    monkeypatch.setattr(X, "STREAM_PARTITIONS", 1)
    monkeypatch.setattr(X, "STREAM_BATCHES", 1)
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 5000).cast("timestamp_ntz")
    events = spark.range(0, 60, 1, 1).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type")
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    used = []

    def start(*args, start=queries.jobs.start, **options):
        used.append(options["partitions"])
        return start(*args, **options)

    monkeypatch.setattr(queries.jobs, "start", start)
    assert queries.stream_labels(spark, str(tmp_path)).count() > 0
    assert used == [spark.sparkContext.defaultParallelism] and used[0] > 1
