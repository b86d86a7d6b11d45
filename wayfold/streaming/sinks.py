"""What happens to a micro-batch. Every write is named by the batch number and replaces itself when
the batch is repeated; errors are not caught, so a failed batch is not committed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.operators import cells, tracking
from wayfold.sources.archive import write_archive
from wayfold.sources.tables import BucketedTable, merge_or_remove
from wayfold.streaming.severity_index import SeverityIndex

LIVE_COLUMNS = ["grid_id", "batch_id", "updated_at", *cells.CELL_COLUMNS]


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append one batch to a folder of batches."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


class CongestionSink:
    """Archive the points, bring the live cell table up to date, add the changes to the feed.

    The last `keep_versions` versions stay, for readers that are under way and for the repeat of a batch (at least 2).
    With `buckets`, a batch reads and writes only the buckets of its cells, and a version holds only these; expired
    cells stay in the others until a batch touches them, but count nowhere. With `spare`, a `SeverityIndex` with that
    many spare cells is kept, and the served list is ranked from it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        settings: Settings = DEFAULTS,
        updated_at: Column | None = None,
        keep_versions: int = 3,
        buckets: int = 1,
        spare: int | None = None,
    ):
        self.archive = f"{path}/archive"
        self.feed = f"{path}/feed"
        self.live = BucketedTable(spark, f"{path}/live", "grid_id", buckets)
        self.index = None if spare is None else SeverityIndex(spark, f"{path}/index", settings, spare)
        self.settings = settings
        self.keep_versions = keep_versions
        self.updated_at = F.unix_timestamp(F.current_timestamp()) if updated_at is None else updated_at

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Cached before anything reads it: the keyed state must run once per batch.
        batch.persist()
        changed = (
            cells.cell_congestion(batch)
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            .withColumn("updated_at", self.updated_at.cast("long"))
            .select(*LIVE_COLUMNS, (F.col("congested_count") > 0).alias("keep"))
            .persist()
        )
        try:
            if batch.isEmpty():
                return
            write_archive(batch, self.archive, batch_id)
            buckets = self.live.touched(changed)
            before = self.live.read_buckets(buckets, before=batch_id)
            if before is None:
                events = changed.withColumn("was_live", F.lit(False))
            else:
                # Expired cells leave the buckets; one row, so the comparison reaches the scan.
                now = changed.agg(F.max("updated_at").alias("now")).scalar()
                before = cells.not_expired(before, now, self.settings)
                # The cached changes are the small side of the first join, its result of the second.
                known = before.join(changed.select("grid_id"), "grid_id", "left_semi")
                known = known.select("grid_id", F.lit(True).alias("was_live"))
                events = changed.join(known, "grid_id", "left")
            write_batch(cells.feed_events(events).drop("batch_id"), self.feed, batch_id)
            self.live.write(merge_or_remove(before, changed, "grid_id", "keep"), buckets, batch_id)
            self.live.expire(self.keep_versions)
            if self.index is not None:
                self.index.update(changed, self.live.read, batch_id)
                self.index.table.expire(self.keep_versions)
        finally:
            changed.unpersist()
            batch.unpersist()

    def snapshot(self, as_of: int | Column) -> DataFrame | None:
        """The served list of live cells, or None before the first batch."""
        current = self.live.read()
        if current is None:
            return None
        fresh = cells.not_expired(current, as_of, self.settings)
        worst = None
        if self.index is not None:
            worst = self.index.read(as_of, self.live.versions()[-1])
        return cells.cell_snapshot(fresh if worst is None else worst, cells.cell_details(fresh), self.settings)


class TrackingSink:
    """Keep the latest position of each vehicle, in `buckets` of which a batch rewrites those of its vehicles, and add
    every position to the feed."""

    def __init__(self, spark: SparkSession, path: str, arrival: str, keep_versions: int = 3, buckets: int = 1):
        self.feed = f"{path}/feed"
        self.latest = BucketedTable(spark, f"{path}/latest", "bus_id", buckets)
        self.arrival = arrival
        self.keep_versions = keep_versions

    def __call__(self, positions: DataFrame, batch_id: int) -> None:
        positions.persist()
        values = [c for c in positions.columns if c not in ("bus_id", self.arrival)]
        newest = (
            positions.groupBy("bus_id")
            .agg(F.max_by(F.struct(*values), self.arrival).alias("r"))
            .select("bus_id", "r.*", F.lit(True).alias("keep"))
            .persist()
        )
        try:
            if positions.isEmpty():
                return
            write_batch(tracking.position_feed(positions), self.feed, batch_id)
            self.latest.merge(newest, "keep", batch_id)
            self.latest.expire(self.keep_versions)
        finally:
            newest.unpersist()
            positions.unpersist()

    def snapshot(self) -> DataFrame | None:
        return self.latest.read()
