"""The kept severity index against a full sort of the live table, after every batch of a random history."""

import random
from dataclasses import replace

from pyspark.sql import functions as F

from wayfold.config import DEFAULTS
from wayfold.operators import cells
from wayfold.sources.tables import BucketedTable
from wayfold.streaming.severity_index import SeverityIndex

SETTINGS = replace(DEFAULTS, top_cells=4, live_ttl_s=35)
COLUMNS = "grid_id long, severity double, updated_at long, keep boolean"


def test_index_equals_a_full_sort_after_every_batch(spark, tmp_path):
    rng = random.Random(11)
    live = BucketedTable(spark, str(tmp_path / "live"), "grid_id", buckets=2)
    index = SeverityIndex(spark, str(tmp_path / "index"), SETTINGS, spare=2)
    model, unsure = {}, 0
    for version in range(14):
        now = 1000 + version * 10
        # Ties in severity, and batches that remove much at once.
        keep = 0.2 if version % 5 == 4 else 0.85
        rows = [(g, float(rng.randrange(4)), now, rng.random() < keep) for g in rng.sample(range(5, 21), 6)]
        changed = spark.createDataFrame(rows, COLUMNS)
        for _ in range(2 if version == 6 else 1):  # a repeated batch
            live.merge(changed, "keep", version)
            index.update(changed, live.read, version)
        for g, severity, at, kept in rows:
            model.pop(g, None)
            if kept:
                model[g] = (severity, at)
        for as_of in (now, now + 12):
            fresh = sorted(((s, str(g)) for g, (s, at) in model.items() if at > as_of - 35), reverse=True)
            found = index.read(as_of, version)
            if found is None:
                unsure += 1
                assert as_of > now
                continue
            best = cells.ranked(found, SETTINGS.top_cells).orderBy("rank").collect()
            assert [(r.severity, str(r.grid_id)) for r in best] == fresh[: SETTINGS.top_cells]
        assert index.read(now, version + 1) is None
    # It is filled again now and then, not with every batch, and mostly knows the list without the table.
    assert 1 < index.refills < 10
    assert unsure < 10


def test_an_index_added_later_starts_from_the_table(spark, tmp_path):
    live = BucketedTable(spark, str(tmp_path / "live"), "grid_id", buckets=2)
    live.merge(spark.createDataFrame([(g, float(g), 1000, True) for g in range(10)], COLUMNS), "keep", 0)
    index = SeverityIndex(spark, str(tmp_path / "index"), SETTINGS, spare=0)
    assert index.read(1000, 0) is None
    change = spark.createDataFrame([(9, 1.0, 1001, True)], COLUMNS)
    live.merge(change, "keep", 1)
    index.update(change, live.read, 1)
    assert sorted(r.grid_id for r in index.read(1001, 1).collect()) == [5, 6, 7, 8]


def test_an_empty_table_has_an_empty_index(spark, tmp_path):
    index = SeverityIndex(spark, str(tmp_path / "index"), SETTINGS)
    index.update(spark.createDataFrame([(1, 1.0, 1000, False)], COLUMNS), lambda: None, 0)
    assert index.read(1000, 0).count() == 0
    index.update(spark.createDataFrame([(1, 1.0, 1001, True)], COLUMNS), lambda: None, 1)
    assert [r.grid_id for r in index.read(F.lit(1001), 1).collect()] == [1]
