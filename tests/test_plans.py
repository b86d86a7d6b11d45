"""The shape of the physical plans, which small data cannot show by its timing."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wayfold.config import DEFAULTS
from wayfold.operators import cells, clean, dedup, labels, replay, stops, tracking
from wayfold.plans import fixtures as X
from wayfold.plans import queries as Q

BATCH = [n for n in sorted(entry.queries()) if not n.startswith(("stream_", "archive_"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The waypoints as a Parquet table, as a user would have them."""
    path = str(tmp_path_factory.mktemp("gps") / "gps.parquet")
    X.gps(spark, small).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_whole_table_in_one_task(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # Only limits, and the one-row minimum of a scalar subquery, end in one partition.
    for line in text.splitlines():
        if "Exchange SinglePartition" in line:
            assert "TakeOrdered" in text or "Subquery" in text
    if name not in ("hot_cells", "live_cells") and "Subquery" not in text:
        assert "SinglePartition" not in text


def test_null_and_flag_filters_reach_the_scan(stored):
    text = clean.clean(stored)._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for wanted in ("IsNotNull(vehicle)", "IsNotNull(x)", "IsNotNull(y)", "IsNotNull(datetime)"):
        assert wanted in pushed
    assert "Or(IsNull(working),EqualTo(working,true))" in pushed
    assert "Or(IsNull(door_up),Not(EqualTo(door_up,true)))" in pushed


def test_columns_are_pruned(stored):
    text = plan(replay.slice_counts(replay.sliced(stored)))
    schemas = set(re.findall(r"ReadSchema: (struct<.*?>)", text))
    assert schemas == {"struct<datetime:bigint>"}


def test_copies_are_merged_before_the_shuffle(stored):
    rows = clean.with_grid(clean.clean(stored)).select(*Q.CLEAN_COLUMNS)
    text = plan(dedup.first_arrival(rows, Q.KEY, "event_id"))
    assert "partial_min_by" in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert text.count("Exchange") == 1


def test_latest_is_one_hash_aggregation(stored):
    text = plan(tracking.latest_waypoints(stored, "event_id"))
    assert "partial_max_by" in text and "SortAggregate" not in text
    assert text.count("Exchange") == 1


def test_routes_are_broadcast_while_small(spark, small, stored):
    routes = X.routes(spark, small).drop("ordinal")
    joined = tracking.with_routes(tracking.to_positions(stored), routes)
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(tracking.with_routes(tracking.to_positions(stored), routes))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stop_join_is_by_cell(spark, small, stored):
    text = plan(stops.without_stop_dwell(clean.clean(stored), X.stops(spark, small)))
    assert re.search(r"BroadcastHashJoin \[gx#\d+L, gy#\d+L\]", text)


def test_labelling_shuffles_the_points_once_per_key(spark, stored):
    """One exchange for copies, one by block; the context search reads the same exchange again."""
    rows = dedup.first_arrival(
        clean.with_grid(clean.clean(stored)).select(*Q.CLEAN_COLUMNS), Q.KEY, "event_id"
    )
    labelled = labels.label_points(rows, replace(DEFAULTS, block_s=200))
    labelled.collect()
    final = plan(labelled).split("== Initial Plan ==")[0]
    lines = [line for line in final.splitlines() if "ReusedExchange" not in line]
    by_second = [n for n in lines if re.search(r"Exchange hashpartitioning\(vehicle#\d+, datetime#", n)]
    by_block = [n for n in lines if re.search(r"Exchange hashpartitioning\(vehicle#\d+, block#", n)]
    # The points themselves, and the few rows of context.
    assert (len(by_second), len(by_block)) == (1, 2)
    assert "ReusedExchange" in final
    # Nothing is exchanged between the union and the Python function.
    head = final.split("Union")[0]
    assert "Exchange" not in head and "MapInArrow" in head


def test_top_cells_are_cut_in_every_task(spark, small):
    found = cells.cell_congestion(Q.labelled_points(spark, small))
    assert "TakeOrderedAndProject" in plan(cells.top_cells(found, 200))


def test_cells_are_combined_by_vehicle_first(spark, small):
    text = plan(cells.cell_congestion(Q.labelled_points(spark, small)))
    assert re.search(r"hashpartitioning\(grid_id#\d+L, vehicle#\d+", text)


def test_counts_while_passing(stored):
    watch = Observation("intake")
    counted = stored.observe(watch, F.count(F.lit(1)).alias("rows"))
    counted.count()
    expected = {r.reason: r.n for r in clean.skip_counts(stored).groupBy("reason").agg(F.sum("n").alias("n")).collect()}
    assert watch.get["rows"] == sum(expected.values())
    assert "kept" in expected
    assert "CollectMetrics" in plan(clean.with_counts(stored))
