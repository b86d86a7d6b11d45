"""Stream labels in blocks against a one-point-at-a-time model: late rows, copies, repeats, idle and hot vehicles."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests import brute
from wayfold.config import DEFAULTS
from wayfold.functions import geo
from wayfold.operators.labels import label_points
from wayfold.plans import fixtures as X
from wayfold.plans import queries
from wayfold.streaming import sinks
from wayfold.streaming.blocks import BlockLabels

SCHEMA = "n long, vehicle string, x double, y double, speed double, datetime long"
BASE = 1_704_067_200
SETTINGS = replace(DEFAULTS, block_s=40, watermark_s=60, idle_timeout_s=300)


class Feed:
    def __init__(self, spark, path, settings=SETTINGS, buckets=4):
        self.spark, self.path, self.settings, self.buckets = spark, str(path), settings, buckets

    def send(self, rows, batch_id, emit=None):
        # A new sink for each batch: nothing is kept but in the folder.
        write = emit or (lambda labels, i: sinks.write_batch(labels, f"{self.path}/rows", i))
        sink = BlockLabels(self.spark, f"{self.path}/state", "n", write, self.settings, self.buckets)
        batch = self.spark.createDataFrame(rows, SCHEMA)
        sink(batch.withColumn("grid_id", geo.grid_id(F.col("x"), F.col("y"), self.settings)), batch_id)

    def rows(self):
        found = self.spark.read.parquet(f"{self.path}/rows").collect()
        return sorted(
            (r.batch_id, r.vehicle, r.event_ts - BASE, r.cluster_id, r.congestion_status, r.tti, r.severity, r.buffer_size)
            for r in found
        )


def expected(parts, settings=SETTINGS):
    """Each fresh point as the last of a frame of the 30 before it of all that arrived up to its batch."""
    out, greatest, known = [], None, {}
    for b, part in enumerate(parts):
        rows = [r for r in part if r[1] is not None and r[5] is not None]
        mark = None if greatest is None else greatest - settings.watermark_s
        if mark is not None:
            rows = [r for r in rows if r[5] > mark]
            for vehicle, points in known.items():
                if max(points, default=0) + settings.idle_timeout_s <= mark:
                    points.clear()
        fresh = {}
        for r in sorted(rows):
            points = known.setdefault(r[1], {})
            if r[5] not in points:
                points[r[5]] = (r[2], r[3], r[4], r[5])
                fresh.setdefault(r[1], set()).add(r[5])
        for vehicle, seconds in fresh.items():
            points = known[vehicle]
            for t in sorted(seconds):
                before = [points[s] for s in sorted(points) if s < t][-30:]
                *_, last = brute.label_steps([before, [points[t]]] if before else [[points[t]]])
                out.append((b, vehicle, last[0] - BASE, *last[1:]))
        greatest = max([r[5] for r in rows] + ([] if greatest is None else [greatest]), default=None)
    return sorted(out)


def history(rng, low, high, vehicles=("a", "b", "c"), every=1.0):
    rows, n = [], low * 10
    for t in range(low, high):
        for vehicle in vehicles:
            if rng.random() < every:
                x = 106.6 + rng.randrange(40) / 20_000
                rows.append((n, vehicle, x, 10.7, rng.choice([0.0, 2.0, 12.5, 45.0]), BASE + t))
                n += 1
    return rows


def test_late_rows_copies_and_nulls_equal_the_model(spark, tmp_path):
    rng = random.Random(4)
    parts = []
    for b in range(4):
        part = history(rng, b * 70, b * 70 + 70, every=0.8)
        # Out of order by up to two batches: some are taken, some late; some copy a second that is known.
        part += [(10_000 + b * 100 + k, "a", 106.6, 10.7, 1.0, BASE + max(0, b * 70 - rng.randrange(120))) for k in range(25)]
        part += [(b, None, 106.6, 10.7, 1.0, BASE), (b, "a", 106.6, 10.7, 1.0, None)]
        rng.shuffle(part)
        parts.append(part)
    feed = Feed(spark, tmp_path)
    for b, part in enumerate(parts):
        feed.send(part, b)
    assert feed.rows() == expected(parts)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rng = random.Random(5)
    parts = [history(rng, b * 50, b * 50 + 50) for b in range(3)]
    feed = Feed(spark, tmp_path)

    def broken(labels, batch_id):
        sinks.write_batch(labels, f"{feed.path}/rows", batch_id)
        raise OSError("lost")

    feed.send(parts[0], 0)
    with pytest.raises(OSError, match="lost"):
        feed.send(parts[1], 1, broken)
    feed.send(parts[1], 1)
    feed.send(parts[1], 1)
    feed.send(parts[2], 2)
    feed.send([], 3)
    assert feed.rows() == expected(parts)


def test_an_idle_vehicle_starts_anew(spark, tmp_path):
    rng = random.Random(6)
    # "a" is silent while "b" carries the watermark on; "c" pauses for less than the limit.
    parts = [history(rng, 0, 40), history(rng, 200, 205, "bc"), history(rng, 500, 505, "b"), history(rng, 506, 520)]
    feed = Feed(spark, tmp_path, buckets=1)
    for b, part in enumerate(parts):
        feed.send(part, b)
    got = feed.rows()
    assert got == expected(parts)
    assert min(r[-1] for r in got if r[1] == "a" and r[0] == 3) == 1


def test_handed_on_points_are_bounded(spark, tmp_path):
    rng = random.Random(7)
    feed = Feed(spark, tmp_path, buckets=2)
    for b in range(3):
        feed.send(history(rng, b * 300, b * 300 + 300, "ab"), b)
    sink = BlockLabels(spark, f"{feed.path}/state", "n", None, SETTINGS, 2)
    held = {r["vehicle"]: r["count"] for r in sink.recent.read().groupBy("vehicle").count().collect()}
    # The seconds above the watermark, and 30 points more.
    assert held == {"a": 60 + 30, "b": 60 + 30}


def test_handed_on_points_meet_a_batch_packed(spark, tmp_path):
    rng = random.Random(9)
    feed = Feed(spark, tmp_path, buckets=2)
    # The second batch has all but "d", and "c" has a point in the midst of those handed on.
    parts = [history(rng, 0, 90, "abcd"), history(rng, 90, 100, "abc")]
    parts[1].append((5_000, "c", 106.6, 10.7, 1.0, BASE + 60))
    parts[0] = [r for r in parts[0] if (r[1], r[5]) != ("c", BASE + 60)]
    seen = []

    class Watched(BlockLabels):
        def labelled(self, arrived, met):
            labels = super().labelled(arrived, met)
            seen.append(sorted((r["vehicle"], len(r["points"] or [])) for r in met.collect()) if met is not None else [])
            return labels

    for b, part in enumerate(parts):
        sink = Watched(spark, f"{feed.path}/state", "n", lambda l, i: sinks.write_batch(l, f"{feed.path}/rows", i), SETTINGS, 2)
        batch = spark.createDataFrame(part, SCHEMA)
        sink(batch.withColumn("grid_id", geo.grid_id(F.col("x"), F.col("y"), SETTINGS)), b)
    assert feed.rows() == expected(parts)
    # One row a vehicle, of 60 points above the watermark and 30 more; "d" may lie in buckets that were not touched.
    assert [r for r in seen[1] if r[0] != "d"] == [("a", 90), ("b", 90), ("c", 89)]
    stored = sink.recent.read_buckets([0, 1])
    assert sorted(r["vehicle"] for r in stored.collect()) == ["a", "b", "c", "d"]


def test_a_hot_vehicle_is_dealt_to_many_tasks(spark, tmp_path):
    rng = random.Random(8)
    part = history(rng, 0, 900, ["hot"]) + [r for k in range(40) for r in history(rng, 0, 30, [f"v{k}"])]
    dealt = {}

    def emit(labels, batch_id):
        found = labels.withColumn("task", F.spark_partition_id()).groupBy("task").agg(
            F.count(F.when(F.col("vehicle") == "hot", 1)).alias("hot"), F.count(F.lit(1)).alias("all")
        )
        dealt[batch_id] = [(r.hot, r.all) for r in found.collect()]
        sinks.write_batch(labels, f"{tmp_path}/rows", batch_id)

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        feed = Feed(spark, tmp_path)
        feed.send(part[:600], 0, emit)
        feed.send(part[600:], 1, emit)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    hot = [h for h, _ in dealt[0]]
    assert sum(hot) == 600 and sum(h > 0 for h in hot) >= 6 and max(hot) <= 600 // 3


@pytest.mark.parametrize("rows", [150, 400])
def test_micro_batches_leave_no_trace(spark, small, monkeypatch, rows):
    monkeypatch.setattr(X, "LOG_ROWS", rows)
    monkeypatch.setattr(X, "BATCH_ROWS", rows)
    got = queries.stream_point_labels(spark, small)
    want = queries.labelled_points(spark, small)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_stream_shuffles_to_as_many_tasks_as_run_at_once(spark, small, monkeypatch):
    monkeypatch.setattr(X, "LOG_ROWS", 400)
    monkeypatch.setattr(X, "BATCH_ROWS", 400)
    dealt = []

    def write_batch(labels, path, batch_id, write=sinks.write_batch):
        dealt.append(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        write(labels, path, batch_id)

    monkeypatch.setattr(sinks, "write_batch", write_batch)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "70")
    try:
        queries.stream_point_labels(spark, small)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(dealt) > 1 and set(dealt) == {str(X.stream_partitions(spark))}


def test_a_longer_log_has_larger_micro_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "LOG_ROWS", 5)
    monkeypatch.setattr(X, "BATCH_ROWS", 10)
    monkeypatch.setattr(X, "LOG_BATCHES", 4)
    rows = [(n, n // 6, n % 6) for n in range(400)]
    ts = F.timestamp_seconds(F.lit(BASE) + F.col("minute") * 40_000).cast("timestamp_ntz")
    events = spark.createDataFrame(rows, "event_id long, minute long, user_id long").select(
        "event_id", ts.alias("ts"), "user_id", F.lit("view").alias("event_type")
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    written = []

    def write_batch(labels, path, batch_id, write=sinks.write_batch):
        written.append(batch_id)
        write(labels, path, batch_id)

    monkeypatch.setattr(sinks, "write_batch", write_batch)
    got = queries.stream_point_labels(spark, str(tmp_path))
    want = queries.labelled_points(spark, str(tmp_path))
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # 40 micro-batches of 10 rows before; a few more than 4, since the last segment of a task may not be full.
    assert 4 <= len(written) <= 8


def test_the_bound_of_a_micro_batch():
    assert X.log_rows(100_000) == (X.LOG_ROWS, X.BATCH_ROWS)
    for rows in (600_000, 6_000_000, 36_000_000, 10**9):
        segment, batch = X.log_rows(rows)
        assert X.BATCH_ROWS < batch <= X.MOST_BATCH_ROWS and batch % segment == 0


def test_points_given_packed_equal_rows(spark):
    rng = random.Random(12)
    rows = spark.createDataFrame(history(rng, 0, 200, every=0.9), SCHEMA).withColumn(
        "grid_id", geo.grid_id(F.col("x"), F.col("y"), SETTINGS)
    )
    points = rows.select("vehicle", "datetime", "x", "y", "speed", "grid_id")
    # "b" has fewer points before than a frame takes; "c" has none, so some blocks have no context.
    is_old = F.col("datetime") < BASE + F.when(F.col("vehicle") == "a", 90).when(F.col("vehicle") == "b", 12).otherwise(0)
    old, new = points.filter(is_old), points.filter(~is_old)
    before = old.groupBy("vehicle").agg(F.sort_array(F.collect_list(F.struct(*points.columns[1:]))).alias("points"))
    chosen = points.withColumn("is_new", ~is_old)
    want = sorted(map(tuple, label_points(chosen, SETTINGS, only="is_new").collect()), key=str)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows_at_once in ("3", "50", size):
            # Groups that go on over several Arrow batches.
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_at_once)
            got = label_points(new.withColumn("is_new", F.lit(True)), SETTINGS, only="is_new", before=before).collect()
            assert sorted(map(tuple, got), key=str) == want and want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_only_chosen_points_get_a_frame(spark):
    rng = random.Random(11)
    rows = spark.createDataFrame(history(rng, 0, 120, every=0.9), SCHEMA).withColumn(
        "grid_id", geo.grid_id(F.col("x"), F.col("y"), SETTINGS)
    )
    chosen = rows.withColumn("chosen", F.col("datetime") % 3 == 0)
    got = label_points(chosen, SETTINGS, only="chosen").collect()
    want = label_points(chosen, SETTINGS, keep=["chosen"]).filter("chosen").drop("chosen").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and got
    with pytest.raises(ValueError, match="steps"):
        label_points(chosen, SETTINGS, step="n", block=F.lit(0), only="chosen")
