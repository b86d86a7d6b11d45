"""Vehicle waypoints and dimensions derived from the test tables by integer arithmetic.

All values come from integers with one division last, so two engines agree on
every double. `event_id` is the order of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.schemas import WAYPOINT_COLUMNS, WRAPPER

# 2024-01-01 00:00:00 UTC, and event time divided by 4000.
BASE_S = 1_704_067_200
SPEED_UP = 4000

REPLAY_HEAD_S = 300
ARCHIVE_STEP_S = 200
LIVE_TTL_S = 120
LIVE_TOP = 50
AS_OF = BASE_S + 650
FALLBACK_S = BASE_S - 60

# Micro-batches the streaming queries cut the events into, by arrival.
STREAM_BATCHES = 3
STREAM_STEP_S = 50
# Rows of a segment of the message log, and of a micro-batch read from it, at most; a log that they would cut into more
# than LOG_BATCHES micro-batches has larger ones, up to MOST_BATCH_ROWS.
LOG_ROWS = 2_500
BATCH_ROWS = 7_500
LOG_BATCHES = 16
MOST_BATCH_ROWS = 1_000_000
STREAM_PARTITIONS = 8
BUCKETS = 16
SPARE = 10
# A heartbeat this long after the last batch comes when all cells have expired and all episodes are over.
HEARTBEAT_S = 1000

# Values of broken records: far off the earth, and some ten million years ahead.
FAR_OFF = 1e300
FAR_FUTURE = 400_000_000_000_000_000


def live_settings() -> Settings:
    """A time to live and a list short enough to matter over the ten minutes of data."""
    return replace(DEFAULTS, live_ttl_s=LIVE_TTL_S, top_cells=LIVE_TOP)


def split_settings() -> Settings:
    """Blocks short enough that the ten minutes of data fall into several, so their seams are checked."""
    return replace(DEFAULTS, block_s=200)


def log_rows(rows: int) -> tuple[int, int]:
    """Rows of a segment and of a micro-batch, at most, of a log of so many rows."""
    times = max(1, min(rows // (BATCH_ROWS * LOG_BATCHES), MOST_BATCH_ROWS // BATCH_ROWS))
    return LOG_ROWS * times, BATCH_ROWS * times


def stream_partitions(spark: SparkSession) -> int:
    """Partitions of a stream's state: as many as tasks run at once, so that no core waits for another's vehicles."""
    return max(STREAM_PARTITIONS, spark.sparkContext.defaultParallelism)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def gps(spark: SparkSession, folder: str) -> DataFrame:
    """Waypoints of parked, crawling, driving and stopping vehicles, with gaps and duplicates."""
    return gps_from_events(table(spark, folder, "events"))


def gps_from_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    # Read off the clock fields, which do not depend on the session time zone.
    clock = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    days = F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date"))
    dt = F.floor((days.cast("long") * 86_400 + clock) / F.lit(SPEED_UP)).cast("long")

    def every(k: int) -> Column:
        return e % k == 0

    crawl_speed = (30 + e % 80) / F.lit(10.0)
    drive_speed = (200 + e % 300) / F.lit(10.0)
    driven = F.least(F.col("dt"), F.lit(330))
    speed = (
        F.when(every(53), None)
        .when(u % 4 == 0, (e % 25) / F.lit(10.0))
        .when(u % 4 == 1, crawl_speed)
        .when(u % 4 == 2, drive_speed)
        .otherwise(F.when(F.col("dt") < 330, drive_speed).otherwise(crawl_speed))
    )
    moved = (
        F.when(u % 4 == 0, F.lit(0))
        .when(u % 4 == 1, F.col("dt") * 10)
        .when(u % 4 == 2, F.col("dt") * 80)
        .otherwise(driven * 80 + F.greatest(F.col("dt") - 330, F.lit(0)) * 10)
    )
    return events.select("event_id", "user_id", "event_type", dt.alias("dt"), *keep).select(
        *keep,
        "event_id",
        F.when(~every(97), F.concat(F.lit("bus_"), u.cast("string"))).alias("vehicle"),
        speed.alias("speed"),
        F.when(e % 454 == 227, F.lit(FAR_FUTURE)).otherwise(F.col("dt") + BASE_S).alias("datetime"),
        F.when(every(211), F.lit(FAR_OFF))
        .when(every(223), F.lit(float("inf")))
        .when(~every(101), (106_600_000 + (u % 5) * 2000 + e % 60 + moved) / F.lit(1_000_000.0)).alias("x"),
        ((10_760_000 + (u % 7) * 2000 + (e * 7) % 60) / F.lit(1_000_000.0)).alias("y"),
        F.when((F.col("event_type") == "error") & every(3), False)
        .when(every(13), None)
        .otherwise(True)
        .alias("ignition"),
        F.when(every(29), False).when(every(11), None).otherwise(True).alias("working"),
        F.when((F.col("event_type") == "signup") & every(4), True)
        .when(every(17), None)
        .otherwise(False)
        .alias("door_up"),
        every(37).alias("door_down"),
    )


def routes(spark: SparkSession, folder: str) -> DataFrame:
    """Raw route rows as text, with blanks, padding and repeated keys; `ordinal` is the line number."""
    n = F.col("n_nationkey")
    nation = table(spark, folder, "nation")
    vehicle = F.concat(F.lit("bus_"), n.cast("string")).alias("vehicle")
    route_id = F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("route_id")
    number = F.concat(F.lit(" "), (n + 1).cast("string"), F.lit(" "))
    first = nation.select(
        n.cast("long").alias("ordinal"),
        vehicle,
        route_id,
        F.when(n % 6 == 0, "  ").otherwise(number).alias("route_no"),
    )
    second = nation.filter(n % 8 == 0).select(
        (n + 1000).cast("long").alias("ordinal"), vehicle, route_id, F.lit("X").alias("route_no")
    )
    return first.unionByName(second)


def stops(spark: SparkSession, folder: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        ((106_600_030 + (s % 5) * 2000) / F.lit(1_000_000.0)).alias("stop_x"),
        ((10_760_030 + (s % 7) * 2000) / F.lit(1_000_000.0)).alias("stop_y"),
    )


def gps_mixed_units(spark: SparkSession, folder: str) -> DataFrame:
    """`gps` with every second time in milliseconds."""
    return gps(spark, folder).withColumn(
        "datetime",
        F.when(F.col("event_id") % 2 == 0, F.col("datetime") * 1000).otherwise(F.col("datetime")),
    )


def gps_messages(spark: SparkSession, folder: str) -> DataFrame:
    """`gps` as keyed JSON text, some of it cut in half."""
    from wayfold.sources.messages import to_messages

    messages = to_messages(gps(spark, folder), keep=["event_id"])
    cut = F.substring(F.col("value"), 1, F.floor(F.length("value") / 2).cast("int"))
    return messages.withColumn(
        "value", F.when(F.col("event_id") % 41 == 0, cut).otherwise(F.col("value"))
    )


def gps_records(spark: SparkSession, folder: str) -> DataFrame:
    """`gps` as archived records: wrapped, flat, or with neither; some with a blank vehicle."""
    e = F.col("event_id")
    blanked = gps(spark, folder).withColumn("vehicle", F.when(e % 47 == 0, "").otherwise(F.col("vehicle")))
    flat = (e % 3 == 0) & (e % 43 != 0)
    wrapped = (e % 3 != 0) & (e % 43 != 0)
    return blanked.select(
        "event_id",
        F.when(wrapped, F.struct(*WAYPOINT_COLUMNS)).alias(WRAPPER),
        *[F.when(flat, F.col(c)).alias(c) for c in WAYPOINT_COLUMNS],
    )
