"""Splitting a vehicle's history must not show in the results."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tests import brute
from wayfold.config import DEFAULTS
from wayfold.operators import frames, labels


@pytest.fixture(scope="module")
def history(spark):
    """One vehicle with two thirds of the points, several small ones, gaps of hours; sorted by nothing."""
    busy = spark.range(4000).select(
        F.lit("busy").alias("vehicle"),
        (F.col("id") * 7 + F.when(F.col("id") > 2500, 90_000).otherwise(0)).alias("datetime"),
        F.col("id").alias("n"),
    )
    others = spark.range(2000).select(
        F.concat(F.lit("v"), (F.col("id") % 40).cast("string")).alias("vehicle"),
        (F.col("id") * 13 + (F.col("id") % 40) * 1000).alias("datetime"),
        F.col("id").alias("n"),
    )
    moving = F.when(F.col("n") % 400 < 200, 0).otherwise(F.col("n") % 400 - 200)
    rows = busy.unionByName(others).select(
        "vehicle",
        (F.col("datetime") + 1_700_000_000).alias("datetime"),
        ((106_600_000 + moving * 300 + F.col("n") * 37 % 50) / F.lit(1e6)).alias("x"),
        ((10_760_000 + F.col("n") * 53 % 50) / F.lit(1e6)).alias("y"),
        (F.col("n") * 31 % 60 / 10.0).alias("speed"),
        (F.col("n") % 5).alias("grid_id"),
    )
    return rows.repartition(7).cache()


@pytest.mark.parametrize("block_s", [1, 50, 333, 5000, 10**7])
def test_rolling_frames_equal_a_plain_window(history, block_s):
    settings = replace(DEFAULTS, block_s=block_s)
    plain = W.partitionBy("vehicle").orderBy("datetime").rowsBetween(-30, 0)
    expected = history.select(
        "vehicle",
        "datetime",
        F.sum("grid_id").over(plain).alias("s"),
        F.min("datetime").over(plain).alias("m"),
        F.count(F.lit(1)).over(plain).cast("int").alias("buffer_size"),
    )
    got = frames.rolling_frames(history, [F.sum("grid_id"), F.min("datetime")], settings, ["s", "m"])
    got = got.select(expected.columns)
    assert got.exceptAll(expected).count() == 0
    assert got.count() == expected.count()


def test_blocks_bound_what_one_task_gets(history):
    settings = replace(DEFAULTS, block_s=700)
    sizes = (
        frames.with_context(history, frames.time_block(settings), 30).groupBy(*frames.GROUP).count()
    )
    assert sizes.agg(F.max("count")).first()[0] <= 700 / 7 + 1 + 30


def test_newest_points(history):
    got = frames.newest_points(history, 3)
    assert got.groupBy("vehicle").count().filter("count <> 3").count() == 0
    last = history.groupBy("vehicle").agg(F.max("datetime").alias("datetime"))
    assert got.filter("from_end = 1").join(last, ["vehicle", "datetime"]).count() == 41


def _expected(history, step_of, scope="emitted"):
    rows = [tuple(r) for r in history.select("vehicle", "x", "y", "speed", "datetime").collect()]
    by_vehicle: dict = {}
    for vehicle, *row in rows:
        by_vehicle.setdefault(vehicle, {}).setdefault(step_of(row[3]), []).append(tuple(row))
    out = set()
    for vehicle, steps in by_vehicle.items():
        for line in brute.label_steps([steps[s] for s in sorted(steps)], scope=scope):
            out.add((vehicle, *line))
    return out


def _got(df):
    columns = ["vehicle", "event_ts", "cluster_id", "congestion_status", "tti", "severity", "buffer_size"]
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def by_point(history):
    return _expected(history, lambda t: t)


@pytest.mark.parametrize(("block_s", "arrow_rows"), [(86_400, 10_000), (900, 10_000), (5000, 17), (40, 64)])
def test_labels_by_point(spark, history, by_point, block_s, arrow_rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_rows))
    try:
        got = _got(labels.label_points(history, replace(DEFAULTS, block_s=block_s)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == by_point
    assert {row[3] for row in got} == {"Congested", "Dwelling", "Smooth", "Warming Up"} - (
        {"Dwelling"} - {row[3] for row in by_point}
    )


@pytest.mark.parametrize(
    ("width", "per_block", "arrow_rows", "scope"),
    [
        (30, 10**6, 10_000, "emitted"),
        (30, 5, 23, "frame"),
        (400, 1, 10_000, "emitted"),
        (2000, 3, 50, "frame"),
    ],
)
def test_labels_by_step(spark, history, width, per_block, arrow_rows, scope):
    rows = history.withColumn("step", F.floor(F.col("datetime") / width))
    block = F.floor(F.col("step") / per_block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_rows))
    try:
        got = _got(labels.label_points(rows, step="step", block=block, density_scope=scope))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _expected(history, lambda t: t // width, scope)


def test_steps_need_blocks(history):
    with pytest.raises(ValueError, match="block"):
        labels.label_points(history.withColumn("step", F.lit(1)), step="step")
