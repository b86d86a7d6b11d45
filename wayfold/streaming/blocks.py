"""Labels of a stream whose vehicles may be hot: a micro-batch is labelled in blocks of time, not by vehicle.

The keyed operator of `trajectory` serves a vehicle's points of a micro-batch in one task. Here a micro-batch joins the
points that earlier ones handed on and is labelled by the batch operator, which deals (vehicle, block) to tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfold.config import DEFAULTS, Settings
from wayfold.operators.dedup import first_arrival
from wayfold.operators.frames import newest_points
from wayfold.operators.labels import label_points
from wayfold.sources.tables import BucketedTable, VersionedTable

POINT = ["vehicle", "datetime", "x", "y", "speed", "grid_id"]


class RecentPoints(BucketedTable):
    """The points handed on: one row per vehicle, with `points` in the order of time; `read` gives one row per point."""

    def read(self, before: int | None = None) -> DataFrame | None:
        packed = super().read(before)
        return None if packed is None else packed.select("vehicle", F.inline("points"))


class BlockLabels:
    """A sink for clean waypoints with `grid_id`: labels each point as its own step and passes them to `emit`.

    A point's frame holds the 30 points before it, in time, of all that arrived up to its micro-batch. Of a vehicle's
    copies of a second the first to arrive counts. A row is late, and dropped, if its time is at or below the watermark
    of the batches before: their greatest time less `watermark_s`. A vehicle is forgotten once the watermark is
    `idle_timeout_s` past its last point. Rows without vehicle or time are ignored. While points arrive in the order of
    time, the labels don't depend on where micro-batches are cut.

    The points handed on are those that a row not yet late can need: all above the watermark and the 30 before them, of
    each vehicle, which is at most `watermark_s` + 30. They lie packed, a vehicle in one row, in `buckets` of which a batch
    reads and writes those of its vehicles. They meet the batch packed as well: only those that a vehicle's fresh points
    precede become rows, and the 30 before these go to the blocks as arrays, so the cost of a batch is one row per known
    vehicle and the frames of its points. Everything is named by the batch number, so a repeated batch changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        arrival: str,
        emit: Callable[[DataFrame, int], None],
        settings: Settings = DEFAULTS,
        buckets: int = 1,
        keep_versions: int = 3,
    ):
        self.recent = RecentPoints(spark, f"{path}/recent", "vehicle", buckets)
        self.marks = VersionedTable(spark, f"{path}/marks")
        self.spark = spark
        self.arrival = arrival
        self.emit = emit
        self.settings = settings
        self.keep_versions = keep_versions

    def _greatest_time(self, before: int) -> int | None:
        mark = self.marks.read(before)
        return None if mark is None else mark.first()["greatest"]

    def _handed_on(self, buckets: list[int], batch_id: int, watermark: int) -> DataFrame | None:
        """The recent points of the vehicles in some buckets, packed, without idle vehicles."""
        stored = self.recent.read_buckets(buckets, before=batch_id)
        if stored is None:
            return None
        last = F.element_at("points", -1)["datetime"]
        return stored.filter(last + self.settings.idle_timeout_s > watermark).select("vehicle", "points")

    def _gathered(self, arrived: DataFrame, watermark: int) -> DataFrame:
        """Of each vehicle of a batch the time of its `first` point, and packed as `added` those that may be handed on."""
        open_points = arrived.filter(F.col("datetime") > watermark)
        # Ranked in each task before the shuffle, so a hot vehicle sends 30 rows a task.
        closed = newest_points(arrived.filter(F.col("datetime") <= watermark), self.settings.frame_points)
        point = F.struct(*POINT[1:]).alias("point")
        candidates = open_points.select("vehicle", point).unionByName(closed.select("vehicle", point))
        firsts = arrived.groupBy("vehicle").agg(F.min("datetime").alias("first"))
        # Lists have no nulls, so the rows of first times add nothing to them.
        return (
            candidates.unionByName(firsts, allowMissingColumns=True)
            .groupBy("vehicle")
            .agg(F.min("first").alias("first"), F.sort_array(F.collect_list("point")).alias("added"))
        )

    def _to_hand_on(self, met: DataFrame, watermark: int) -> DataFrame:
        """The points above the watermark and the 30 before them, of the stored and the added ones; of copies the stored."""
        known = F.transform("points", lambda p: p["datetime"])
        new = F.filter("added", lambda p: ~F.array_contains(known, p["datetime"]))
        behind = F.element_at("points", -1)["datetime"] < F.col("first")
        every = (
            F.when(F.col("points").isNull(), F.col("added"))
            .when(F.col("added").isNull(), F.col("points"))
            .when(behind, F.concat("points", "added"))
            .otherwise(F.sort_array(F.concat("points", new)))
        )
        closed = F.size(F.filter("points", lambda p: p["datetime"] <= watermark))
        begin = F.greatest(closed - self.settings.frame_points, F.lit(0)) + 1
        merged = met.select("vehicle", every.alias("points"))
        return merged.select("vehicle", F.slice("points", begin, F.size("points")).alias("points"))

    def labelled(self, arrived: DataFrame, met: DataFrame | None) -> DataFrame:
        """The labels of the arrived points that are not known yet, in frames of these and the stored ones."""
        if met is None:
            return label_points(arrived.select(*POINT), self.settings)
        both = met.filter(F.col("first").isNotNull() & F.col("points").isNotNull())
        behind = F.element_at("points", -1)["datetime"] < F.col("first")
        later = F.filter("points", lambda p: p["datetime"] >= F.col("first"))
        among = both.filter(~behind).select("vehicle", F.inline(later))
        fresh = arrived.join(among.select("vehicle", "datetime"), ["vehicle", "datetime"], "left_anti")
        marked = fresh.select(*POINT, F.lit(True).alias("is_fresh"))
        marked = marked.unionByName(among.select(*POINT, F.lit(False).alias("is_fresh")))

        earlier = F.filter("points", lambda p: p["datetime"] < F.col("first"))
        before = both.select("vehicle", F.when(behind, F.col("points")).otherwise(earlier).alias("points"))
        begin = F.greatest(F.size("points") - (self.settings.frame_points - 1), F.lit(1))
        newest = before.select("vehicle", F.slice("points", begin, self.settings.frame_points).alias("points"))
        return label_points(marked, self.settings, only="is_fresh", before=newest)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        greatest = self._greatest_time(batch_id)
        late = self.settings.watermark_s
        known = batch.select(*POINT, self.arrival).filter("vehicle is not null and datetime is not null")
        if greatest is not None:
            known = known.filter(F.col("datetime") > greatest - late)
        arrived = first_arrival(known, ["vehicle", "datetime"], self.arrival).select(*POINT).persist()
        met = None
        try:
            newest = arrived.agg(F.max("datetime")).first()[0]
            if newest is None:
                return
            buckets = self.recent.touched(arrived)
            watermark = (newest if greatest is None else max(newest, greatest)) - late
            met = self._gathered(arrived, watermark)
            stored = None if greatest is None else self._handed_on(buckets, batch_id, greatest - late)
            if stored is None:
                met = met.withColumn("points", F.lit(None).cast(met.schema["added"].dataType))
            else:
                met = met.join(stored, "vehicle", "full_outer")
            met = met.persist()
            self.emit(self.labelled(arrived, None if stored is None else met), batch_id)

            self.recent.write(self._to_hand_on(met, watermark), buckets, batch_id)
            self.recent.expire(self.keep_versions)
            # Last: a batch has a mark only once its points are handed on.
            mark = self.spark.range(0, 1, 1, 1).select(F.lit(watermark + late).cast("long").alias("greatest"))
            self.marks.write(mark, batch_id)
            self.marks.expire(self.keep_versions)
        finally:
            for cached in (met, arrived):
                if cached is not None:
                    cached.unpersist()
