"""Compaction of the archive: each row is read once before, during and after, and old batches stay repeatable."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from wayfold.sources import archive
from wayfold.sources.tables import sized_files

DAY = 86_400
START = 1_704_067_200
COLUMNS = ["vehicle", "event_ts", "congestion_status", "batch_id"]


def points(spark, batch, days=(0, 1, 2), vehicles=6):
    rows = [
        (f"v{v}", 106.6, START + d * DAY + batch * 60 + v, ["Smooth", "Congested", "Dwelling"][v % 3])
        for d in days
        for v in range(vehicles)
    ]
    return spark.createDataFrame(rows, "vehicle string, x double, event_ts long, congestion_status string")


def rows(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "archive")
    for batch in range(4):
        archive.write_archive(points(spark, batch), path, batch)
    return path


def test_rows_stay_the_same_at_every_step(spark, path):
    whole = rows(archive.read_archive(spark, path))
    assert len(whole) == 4 * 3 * 4
    reader = archive.read_archive(spark, path)
    assert archive.compact_archive(spark, path, "2024-01-03", upto=2) == ["2024-01-01", "2024-01-02"]
    assert rows(reader) == whole  # a reader from before the switch
    assert rows(archive.read_archive(spark, path)) == whole
    # Two days of three batches go, then nothing more.
    assert archive.clean_archive(spark, path) == 6
    assert archive.clean_archive(spark, path) == 0
    assert rows(archive.read_archive(spark, path)) == whole
    assert sorted(os.listdir(f"{path}/date=2024-01-01")) == ["batch_id=3"]
    assert archive.compact_archive(spark, path, "2024-01-03", upto=2) == []
    # The next call takes in the batch left, and the form before goes.
    assert archive.compact_archive(spark, path, "2024-01-03", upto=3) == ["2024-01-01", "2024-01-02"]
    assert rows(archive.read_archive(spark, path)) == whole
    assert archive.clean_archive(spark, path) == 4
    assert rows(archive.read_archive(spark, path)) == whole
    # A day is taken as soon as it is closed, without new batches.
    assert archive.compact_archive(spark, path, "2024-01-04", upto=3) == ["2024-01-03"]
    archive.clean_archive(spark, path)
    assert rows(archive.read_archive(spark, path)) == whole
    assert not glob.glob(f"{path}/date=*/batch_id=*")


def test_old_batches_are_repeatable_and_late_rows_are_kept(spark, path):
    whole = rows(archive.read_archive(spark, path))
    archive.compact_archive(spark, path, "2024-01-04", upto=3)
    archive.write_archive(points(spark, 1), path, 1)
    assert rows(archive.read_archive(spark, path)) == whole
    archive.clean_archive(spark, path)
    archive.write_archive(points(spark, 1), path, 1)
    assert rows(archive.read_archive(spark, path)) == whole
    # A later batch has rows of a closed day.
    archive.write_archive(points(spark, 7, days=(0,)), path, 7)
    more = rows(archive.read_archive(spark, path))
    assert len(more) == len(whole) + 4 and set(whole) < set(more)
    assert archive.compact_archive(spark, path, "2024-01-04", upto=7) == ["2024-01-01"]
    archive.clean_archive(spark, path)
    assert rows(archive.read_archive(spark, path)) == more


def test_a_failed_compaction_is_not_seen(spark, path):
    whole = rows(archive.read_archive(spark, path))
    archive.compact_archive(spark, path, "2024-01-04", upto=3)
    os.remove(f"{path}/_compacted/upto=3~2024-01-04/_SUCCESS")
    assert rows(archive.read_archive(spark, path)) == whole
    assert archive.clean_archive(spark, path) == 0
    assert len(archive.compact_archive(spark, path, "2024-01-04", upto=3)) == 3
    assert rows(archive.read_archive(spark, path)) == whole


def test_files_are_bounded_by_size_whatever_the_vehicle(spark, tmp_path):
    path = str(tmp_path / "archive")
    for batch in range(3):
        one = spark.range(20_000).select(
            F.lit("hot").alias("vehicle"),
            F.rand(batch).alias("x"),
            (F.lit(START + batch * 20_000) + F.col("id")).alias("event_ts"),
            F.lit("Smooth").alias("congestion_status"),
        )
        archive.write_archive(one, path, batch)
    before = sum(size for _, size in sized_files(spark, f"{path}/date=*/batch_id=*/*/*.parquet"))
    limit = before // 5
    archive.compact_archive(spark, path, "2024-01-02", upto=2, file_bytes=limit)
    files = [size for _, size in sized_files(spark, f"{path}/_compacted/*/date=*/*/*.parquet")]
    assert len(files) == -(-before // limit)
    assert max(files) < 1.3 * limit
    assert archive.read_archive(spark, path).count() == 60_000


def test_pruning_by_day_and_status_is_kept(spark, path):
    archive.compact_archive(spark, path, "2024-01-03", upto=2)
    read = archive.read_archive(spark, path)
    some = read.filter("date = '2024-01-01' AND congestion_status = 'Congested'")
    assert some.count() == 8
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(date") == plan.count("FileScan parquet") == 2
    used = {r.f for r in some.select(F.input_file_name().alias("f")).distinct().collect()}
    assert all("date=2024-01-01" in f and "congestion_status=Congested" in f for f in used)


def test_nothing_to_compact(spark, tmp_path):
    path = str(tmp_path / "none")
    assert archive.compact_archive(spark, path, "2024-01-04", upto=3) == []
    assert archive.clean_archive(spark, path) == 0
