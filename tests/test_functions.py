import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayfold.functions import geo, numbers, scoring, time
from wayfold.operators import clean


def column(spark, values, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_rounding_is_half_even_like_numpy(spark):
    values = [0.125, 0.375, 2.5, 1.015, 1.005, 0.0625, -0.125, 40 / 25.6, 40 / 7.3]
    for digits in (0, 2, 3):
        got = column(spark, values, lambda v: numbers.round_even(v, digits))
        assert got == list(np.round(values, digits))


def test_rounding_equals_pandas_on_all_speeds(spark):
    speeds = [k / 10 for k in range(0, 1200)]
    got = column(spark, speeds, scoring.travel_time_index)
    assert got == list((40.0 / pd.Series(speeds).clip(lower=1.0)).round(3))


def test_stable_mean_does_not_depend_on_partitions(spark):
    df = spark.range(50_000).select((106.6 + F.rand(7) / 1000).alias("v"))
    rows = df.repartition(1).cache()
    means = {rows.repartition(n).agg(numbers.stable_mean(F.col("v"), 7)).first()[0] for n in (1, 3, 7, 16)}
    assert len(means) == 1
    assert means.pop() == pytest.approx(rows.agg(F.avg("v")).first()[0], abs=1e-7)


def test_untrusted_text_reads_as_zero(spark):
    got = column(spark, ["1.5", "", "  ", None, "x", " 2 "], numbers.number_or_zero, "string")
    assert got == [1.5, 0.0, 0.0, 0.0, 0.0, 2.0]


def test_fixed_text(spark):
    values = [1.0, 2.345, 0.125, 0.375, 12.3456]
    assert column(spark, values, lambda v: numbers.fixed_text(v, 2)) == [f"{v:.2f}" for v in values]


def test_finite(spark):
    got = column(spark, [1.0, float("nan"), float("inf"), float("-inf"), None], numbers.is_finite)
    assert got == [True, False, False, False, False]


def test_epoch_unit_limit(spark):
    got = column(spark, [20_000_000_000, 20_000_000_001, 1_704_067_200_999, None], time.epoch_seconds, "long")
    assert got == [20_000_000_000, 20_000_000, 1_704_067_200, None]


def test_utc_text(spark):
    got = column(spark, [0, 1_704_067_207, 951_782_399], time.utc_text, "long")
    assert got == ["1970-01-01T00:00:00+00:00", "2024-01-01T00:00:07+00:00", "2000-02-28T23:59:59+00:00"]


def test_utc_text_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        assert column(spark, [1_704_067_207], time.utc_text, "long") == ["2024-01-01T00:00:07+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_position_time_falls_back(spark):
    got = column(spark, [None, 0, -5, 60], lambda v: time.position_time(v, F.lit(3600)), "long")
    hour, minute = "1970-01-01T01:00:00+00:00", "1970-01-01T00:01:00+00:00"
    assert got == [hour, hour, hour, minute]


def test_grid_of_negative_and_border_values(spark):
    df = spark.createDataFrame([(106.6, 10.76), (-0.0005, -0.0001), (0.0, 0.001)], "x double, y double")
    got = [tuple(r) for r in df.select(geo.grid_index(F.col("x")), geo.grid_id(F.col("x"), F.col("y"))).collect()]
    floor = lambda v: int(np.floor(v / 0.001))
    assert got == [
        (floor(x), floor(x) * 1000 + floor(y)) for x, y in [(106.6, 10.76), (-0.0005, -0.0001), (0.0, 0.001)]
    ]


def test_cell_key_falls_back_to_position(spark):
    df = spark.createDataFrame([(5, 1.0, 2.0), (None, 10.123456, 106.5)], "g long, lat double, lon double")
    got = [r[0] for r in df.select(geo.cell_key(F.col("g"), F.col("lat"), F.col("lon"))).collect()]
    assert got == ["5", "10.12346_106.50000"]


@pytest.mark.parametrize(
    ("points", "tti", "expected"),
    [(1, 10.0, 5.0), (5, 4.0, 2.0), (10, 4.0, 4.0), (30, 40.0, 25.0), (25, 4.0, 10.0), (7, 1.0, 0.7)],
)
def test_severity(spark, points, tti, expected):
    df = spark.createDataFrame([(0, points, tti), (-1, points, tti)], "c int, n int, t double")
    got = [r[0] for r in df.select(scoring.severity(F.col("c"), F.col("n"), F.col("t"))).collect()]
    assert got == [expected, 0.0]


def test_status_limits_are_strict(spark):
    rows = [
        (0, 30, 2.9, 14.9, "Dwelling"),
        (0, 30, 3.0, 14.9, "Congested"),
        (0, 30, 2.9, 15.0, "Congested"),
        (-1, 29, None, None, "Warming Up"),
        (-1, 30, None, None, "Smooth"),
    ]
    df = spark.createDataFrame(rows, "c int, n int, v double, d double, want string")
    status = scoring.congestion_status(F.col("c"), F.col("n"), F.col("v"), F.col("d"))
    assert df.filter(status != F.col("want")).count() == 0


def test_band_limits(spark):
    assert column(spark, [0.0, 1.99, 2.0, 4.99, 5.0], scoring.severity_band) == [
        "mild", "mild", "moderate", "moderate", "heavy",
    ]


def test_flags_are_three_valued(spark):
    values = [True, False, None]
    rows = [(w, i, u, d) for w in values for i in values for u in values for d in values]
    df = spark.createDataFrame(rows, "working boolean, ignition boolean, door_up boolean, door_down boolean")
    got = df.select("*", clean.in_service().alias("s"), clean.doors_closed().alias("c")).collect()
    for r in got:
        assert r.s == (r.working is not False and r.ignition is not False)
        assert r.c == (r.door_up is not True and r.door_down is not True)
