"""Totals of a stream are stored once a batch, whatever the restarts and repeats."""

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import Feed
from wayfold.operators import clean
from wayfold.plans import fixtures as X
from wayfold.sources.tables import write_text
from wayfold.streaming import jobs, totals


def found(frame):
    return {tuple(r) for r in frame.select("tracked", "reason", "n").collect()}


def test_every_reason_is_counted(spark, small):
    rows = X.gps(spark, small)
    reasons = {(r.reason, r.tracked) for r in clean.skip_counts(rows).collect()}
    assert reasons <= set(clean.REASONS.items())


def test_totals_after_a_restart_and_a_failed_batch(spark, small, tmp_path):
    rows = X.gps(spark, small).withColumnRenamed("event_id", "n")
    stored = str(tmp_path / "totals")
    feed = Feed(spark, tmp_path, lambda w: jobs.congestion_labels(w, arrival="n"))
    assert found(totals.skip_totals(spark, stored)) == set()
    half = rows.agg(F.max("n")).first()[0] // 2
    feed.send(rows.filter(F.col("n") < half))
    with totals.recorded(spark, stored):
        feed.run()
    assert found(totals.skip_totals(spark, stored)) == found(clean.skip_counts(rows.filter(F.col("n") < half)))
    feed.send(rows.filter(F.col("n") >= half))

    def broken(batch, batch_id):
        batch.count()
        raise RuntimeError("sink is down")

    with totals.recorded(spark, stored):
        with pytest.raises(Exception, match="sink is down"):
            feed.run(broken)
        feed.run()
        feed.run()
    assert found(totals.skip_totals(spark, stored)) == found(clean.skip_counts(rows))
    ids = [r.batch_id for r in totals.batches(spark, stored).orderBy("batch_id").collect()]
    assert ids == [0, 1]


def test_a_small_file_is_replaced_whole(spark, tmp_path):
    for text in ("{}", '{"query": "ü"}'):
        write_text(spark, f"{tmp_path}/t/x.json", text)
    assert [p.name for p in (tmp_path / "t").iterdir() if p.suffix == ".json"] == ["x.json"]
    assert (tmp_path / "t" / "x.json").read_text("utf-8") == text
