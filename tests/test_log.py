"""The segment log: numbering, repeats, bounded micro-batches, starts and lost segments."""

import random

import pytest
from pyspark.sql import functions as F

from wayfold.sources import log as L
from wayfold.sources import tables
from wayfold.streaming import jobs, sinks


@pytest.fixture
def log(spark, tmp_path):
    schema = spark.createDataFrame([], "n long, text string").schema
    return L.SegmentLog(spark, str(tmp_path / "log"), schema, rows_per_segment=10)


def rows(spark, low, high, parts=3):
    numbers = list(range(low, high))
    random.Random(low).shuffle(numbers)
    return spark.createDataFrame([(n, f"t{n % 7}") for n in numbers], "n long, text string").repartition(parts)


def drained(spark, log, tmp_path, name="reader", max_rows=20, latest=False):
    """(micro-batch, offset, n) of all that a stream has read so far, after another run of it."""
    stream = log.stream(max_rows, name, latest)
    jobs.start(
        stream, lambda b, i: sinks.write_batch(b, f"{tmp_path}/{name}", i), f"{tmp_path}/{name}-checkpoint", available_now=True
    ).awaitTermination()
    if not tables.path_exists(spark, f"{tmp_path}/{name}/*"):
        return []
    return sorted(map(tuple, spark.read.parquet(f"{tmp_path}/{name}").select("batch_id", "offset", "n").collect()))


def test_offsets_follow_the_order(spark, log):
    assert log.end() == 0 and log.read().count() == 0
    log.append(rows(spark, 0, 37), "n", 0)
    log.append(rows(spark, 37, 37), "n", 1)
    log.append(rows(spark, 37, 90), "n", 2)
    got = sorted(map(tuple, log.read().select("offset", "n").collect()))
    assert got == [(n, n) for n in range(90)]
    assert all(count <= 10 for _, count, _ in log._segments())
    times = [t for _, _, t in log._segments()]
    assert times == sorted(set(times))


def test_a_repeat_adds_nothing_and_ends_what_was_begun(spark, log, monkeypatch):
    log.append(rows(spark, 0, 45), "n", 0)
    log.append(rows(spark, 0, 45), "n", 0)
    assert log.read().count() == 45

    publish = log._publish

    def broken(staged, moves):
        publish(staged, moves[:2])
        raise OSError("lost")

    monkeypatch.setattr(log, "_publish", broken)
    with pytest.raises(OSError, match="lost"):
        log.append(rows(spark, 45, 100), "n", 1)
    monkeypatch.undo()
    assert 45 < log.read().count() < 100
    log.append(rows(spark, 45, 100), "n", 1)
    assert sorted(map(tuple, log.read().select("offset", "n").collect())) == [(n, n) for n in range(100)]


def test_micro_batches_are_bounded_and_in_order(spark, log, tmp_path):
    log.append(rows(spark, 0, 64), "n", 0)
    log.append(rows(spark, 64, 99), "n", 1)
    first = drained(spark, log, tmp_path)
    assert [r[1:] for r in first] == [(n, n) for n in range(99)]
    sizes = [sum(r[0] == b for r in first) for b in range(first[-1][0] + 1)]
    assert max(sizes) <= 20 and len(sizes) >= 5
    # Stopped and resumed: the checkpoint knows what was read.
    log.append(rows(spark, 99, 130), "n", 2)
    again = drained(spark, log, tmp_path)
    assert again[: len(first)] == first and [r[1] for r in again] == list(range(130))


def test_start_at_the_end_is_kept_over_a_restart(spark, log, tmp_path):
    log.append(rows(spark, 0, 30), "n", 0)
    assert drained(spark, log, tmp_path, "late", latest=True) == []
    log.append(rows(spark, 30, 50), "n", 1)
    assert [r[1] for r in drained(spark, log, tmp_path, "late", latest=True)] == list(range(30, 50))
    log.append(rows(spark, 50, 55), "n", 2)
    assert [r[1] for r in drained(spark, log, tmp_path, "late", latest=True)] == list(range(30, 55))


def test_lost_segments_are_passed_over_and_offsets_go_on(spark, log, tmp_path):
    log.append(rows(spark, 0, 40, parts=1), "n", 0)
    assert [r[1] for r in drained(spark, log, tmp_path)] == list(range(40))
    log.append(rows(spark, 40, 80), "n", 1)
    cut = log._segments()[-1][0]
    log.drop_before(cut)
    assert log.read().agg(F.min("offset")).first()[0] == cut
    assert [r[1] for r in drained(spark, log, tmp_path)] == [*range(40), *range(cut, 80)]
    log.drop_before(80)
    assert log.end() == 80
    log.append(rows(spark, 80, 85), "n", 2)
    assert sorted(r["offset"] for r in log.read().select("offset").collect()) == list(range(80, 85))


def test_nulls_and_a_batch_below_a_segment(spark, log):
    log.append(spark.createDataFrame([(2, None), (1, "a"), (None, "b")], "n long, text string"), "n", 0)
    assert sorted(map(tuple, log.read().collect())) == [(0, None, "b"), (1, 1, "a"), (2, 2, None)]
    with pytest.raises(ValueError, match="whole segments"):
        log.stream(9)
