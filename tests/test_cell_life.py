"""Expiry and episodes on a stream: as the batch forms, however the batches are cut, and also when only time passes."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS
from wayfold.operators import cells
from wayfold.sources import messages
from wayfold.streaming import cell_life, jobs, sinks

SETTINGS = replace(DEFAULTS, live_ttl_s=100, episode_gap_s=30)
SCHEMA = "grid_id long, batch_id long, updated_at long, congested_count long, cx double, cy double, avg_speed double, avg_tti double, severity double, point_count long, vehicles long"
START = 1_704_067_200


def row(grid, batch, at, congested):
    return (grid, batch, START + at, congested, 106.6, 10.7, 5.0, 8.0, 4.0, 3, 2)


def beat(at):
    return (None, None, START + at, None, None, None, None, None, None, None, None)


def run(spark, path, parts, transform):
    """Rows of a stream that is stopped and resumed after each part."""
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/input")
        rows = transform(messages.file_stream(spark, f"{path}/input", SCHEMA))
        write = lambda b, i: sinks.write_batch(b.withColumnsRenamed({"batch_id": "of_batch"}), f"{path}/rows", i)
        jobs.start(rows, write, f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def feed(spark, path, parts):
    rows = run(spark, path, parts, lambda b: cell_life.live_feed(b, SETTINGS)).collect()
    at = lambda text: text[11:19]
    return sorted((r.of_batch, int(r.grid_id), r.op, at(r.updated_at)) for r in rows)


def test_only_time_passes(spark, tmp_path):
    parts = [[row(1, 0, 0, 2), row(2, 0, 0, 1), row(3, 0, 0, 0)], [row(2, 1, 60, 1)], [beat(99)], [beat(101)], [beat(102)], [beat(400)], [beat(401)]]
    got = feed(spark, tmp_path, parts)
    assert got == [
        (0, 1, "delete", "00:01:40"),
        (0, 1, "upsert", "00:00:00"),
        (0, 2, "upsert", "00:00:00"),
        (1, 2, "delete", "00:02:40"),
        (1, 2, "upsert", "00:01:00"),
    ]


@pytest.fixture(scope="module")
def history():
    rnd = random.Random(4)
    times = [20 * b + rnd.randrange(15) for b in range(30)]
    return [[row(g, b, at, rnd.choice([0, 1, 2])) for g in range(8) if rnd.random() < 0.25] + [beat(at)] for b, at in enumerate(times)]


@pytest.mark.parametrize("cut", [1, 11, 30])
def test_feed_does_not_depend_on_the_cut(spark, tmp_path, history, cut):
    """However many batches are read at once, events are those of the history and of its silent times."""
    parts = [sum(history[i : i + cut], []) for i in range(0, len(history), cut)] if cut > 1 else [sum(history[:7], []), sum(history[7:], [])]
    got = feed(spark, tmp_path, [*parts, [beat(5000)], [beat(5001)]])
    expected, live = [], {}
    clock = lambda at: f"{at // 3600:02}:{at // 60 % 60:02}:{at % 60:02}"
    rows = sorted((r for part in history for r in part if r[0] is not None), key=lambda r: (r[0], r[2]))
    for r in [*rows, *[row(g, None, 10**4, 0) for g in range(8)]]:
        grid, batch, at, congested = r[0], r[1], r[2] - START, r[3]
        until = live.pop(grid, None)
        if until is not None and until[1] <= at:
            expected.append((until[0], grid, "delete", clock(until[1])))
            until = None
        if congested:
            expected.append((batch, grid, "upsert", clock(at)))
            live[grid] = (batch, at + 100)
        elif until is not None:
            expected.append((batch, grid, "delete", clock(at)))
    assert got == sorted(expected)


def test_episodes_equal_the_batch_form(spark, tmp_path, history):
    """Repeats of a batch count once; a run over the cut of two starts of the stream is one."""
    parts = [sum(history[:9], []), sum(history[9:10], []), sum(history[9:20], []), sum(history[20:], []), [beat(5000)], [beat(5001)]]
    got = run(spark, tmp_path, parts, lambda b: cell_life.ended_episodes(b, SETTINGS))
    every = spark.createDataFrame(sum(history, []), SCHEMA)
    expected = cells.episodes(cells.still_congested(every), SETTINGS)
    assert sorted(map(tuple, got.drop("batch_id").collect())) == sorted(map(tuple, expected.collect()))
    assert got.filter(F.col("updates") > 1).count() > 3
