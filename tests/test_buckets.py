"""Bucketed tables: a batch reads and writes the buckets of its keys, repeats change nothing, old buckets go."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wayfold.sources.tables import BucketedTable, sized_files
from wayfold.streaming import sinks

COLUMNS = "k long, v string, keep boolean"


def content(table, before=None):
    found = table.read(before)
    return set() if found is None else {tuple(r) for r in found.collect()}


def test_random_history_equals_a_dictionary(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=8)
    assert table.read() is None and table.versions() == []
    rng = random.Random(3)
    model, states = {}, []
    for version in range(6):
        rows = [(k, f"{version}", rng.random() < 0.6) for k in rng.sample(range(20), 3)]
        for _ in range(2 if version % 2 else 1):
            table.merge(spark.createDataFrame(rows, COLUMNS), "keep", version)
        for k, v, keep in rows:
            model.pop(k, None)
            if keep:
                model[k] = v
        states.append(set(model.items()))
        assert content(table) == states[-1]
        if version:
            assert content(table, before=version) == states[-2]
        table.expire(keep=2)
        # No bucket is kept more often than the two versions need.
        folders = list((tmp_path / "t").glob("version=*/bucket_of_8=*"))
        assert len(folders) <= 8 + 3
    # A repeat of the last batch after the rest was removed.
    table.merge(spark.createDataFrame(rows, COLUMNS), "keep", version)
    assert content(table) == states[-1]


def test_bytes_read_and_written_follow_the_batch(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=64)
    whole = spark.range(64_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(True).alias("keep"))
    table.merge(whole, "keep", 0)
    change = whole.filter("k = 77").withColumn("v", F.lit("new"))
    assert len(table.touched(change)) == 1
    table.merge(change, "keep", 1)
    sizes = [sum(size for _, size in sized_files(spark, f"{table.path}/version={v}/*/*.parquet")) for v in (0, 1)]
    assert sizes[1] < sizes[0] / 32
    assert len(list((tmp_path / "t" / "version=1").glob("bucket_of_64=*"))) == 1
    used = table.read_buckets(table.touched(change), before=1).inputFiles()
    assert len(used) == 1
    assert table.read().count() == 64_000
    assert table.read().filter("k = 77").first().v == "new"


def test_an_emptied_bucket_stays_empty(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.merge(spark.createDataFrame([(1, "a", True)], COLUMNS), "keep", 0)
    table.merge(spark.createDataFrame([(1, "a", False)], COLUMNS), "keep", 1)
    assert content(table) == set()
    table.expire(keep=1)
    assert content(table) == set() and table.versions() == [1]


def test_an_unfinished_version_is_not_seen(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.merge(spark.createDataFrame([(1, "a", True), (2, "a", True)], COLUMNS), "keep", 0)
    table.merge(spark.createDataFrame([(1, "b", True)], COLUMNS), "keep", 1)
    Path(tmp_path, "t", "version=1", "_SUCCESS").unlink()
    assert content(table) == {(1, "a"), (2, "a")}
    table.merge(spark.createDataFrame([(1, "b", True)], COLUMNS), "keep", 1)
    assert content(table) == {(1, "b"), (2, "a")}


def test_another_number_of_buckets_is_an_error(spark, tmp_path):
    BucketedTable(spark, str(tmp_path / "t"), "k", 4).merge(spark.createDataFrame([(1, "a", True)], COLUMNS), "keep", 0)
    with pytest.raises(ValueError, match="bucket_of_4"):
        BucketedTable(spark, str(tmp_path / "t"), "k", 8).read()


@pytest.mark.parametrize("buckets", [1, 16])
def test_tracking_sink_gives_the_same_for_any_number(spark, tmp_path, buckets):
    sink = sinks.TrackingSink(spark, str(tmp_path), "arrival", buckets=buckets)
    columns = "bus_id string, lat double, lng double, speed double, timestamp string, route_id string, route_no string, arrival long"
    for batch in range(4):
        rows = [(f"b{i}", 1.0, 2.0, float(batch), "t", None, None, batch * 10 + i) for i in range(batch, batch + 3)]
        sink(spark.createDataFrame(rows, columns), batch)
    got = {r.bus_id: r.speed for r in sink.snapshot().collect()}
    assert got == {"b0": 0.0, "b1": 1.0, "b2": 2.0, "b3": 3.0, "b4": 3.0, "b5": 3.0}
