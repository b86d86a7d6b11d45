"""The worst cells, kept from batch to batch beside the live table instead of sorted out of it for every reader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.config import DEFAULTS, Settings
from wayfold.operators import cells
from wayfold.sources.tables import VersionedTable

_COLUMNS = ["grid_id", "severity", "updated_at"]
# The row without `grid_id` holds the threshold: severity and name of the last cell that had a place.
_STORED = "grid_id long, severity double, updated_at long, threshold_name string"


class SeverityIndex:
    """The first `top_cells` live cells by severity, and up to `spare` more to replace those that leave.

    Every live cell above the threshold is in the index, so a changed cell enters if it is above, and the table is not
    read. When too many left for the list to be full, the index is filled again from the table. Without a threshold
    the index holds all cells. The driver handles one row more than `top_cells` and `spare` together.
    """

    def __init__(self, spark: SparkSession, path: str, settings: Settings = DEFAULTS, spare: int = 200):
        self.spark = spark
        self.table = VersionedTable(spark, path)
        self.settings = settings
        self.size = settings.top_cells + spare
        self.refills = 0

    def _worst(self, rows: DataFrame) -> list[tuple]:
        """The worst cells as far as there is room, and one more to tell whether there are others."""
        found = rows.select(*_COLUMNS).orderBy(F.desc("severity"), F.desc(F.col("grid_id").cast("string")))
        return [tuple(r) for r in found.limit(self.size + 1).collect()]

    def _split(self, stored: DataFrame) -> tuple[DataFrame, tuple[float, str] | None]:
        mark = stored.filter(F.col("grid_id").isNull()).first()
        threshold = None if mark.severity is None else (mark.severity, mark.threshold_name)
        return stored.filter(F.col("grid_id").isNotNull()).select(*_COLUMNS), threshold

    def update(self, changed: DataFrame, live: Callable[[], DataFrame | None], version: int) -> None:
        """Apply a batch: `changed` has one row a cell with the flag `keep`; `live` reads the table after the batch."""
        before = self.table.read(before=version)
        now = changed.agg(F.max("updated_at")).first()[0]
        rows = None
        if before is not None:
            held, threshold = self._split(before)
            entering = changed.filter("keep").select(*_COLUMNS)
            if threshold is not None:
                severity, name = F.lit(threshold[0]), F.lit(threshold[1])
                above = (F.col("severity") == severity) & (F.col("grid_id").cast("string") >= name)
                entering = entering.filter((F.col("severity") > severity) | above)
            staying = held.join(changed.select("grid_id"), "grid_id", "left_anti")
            rows = self._worst(cells.not_expired(staying.unionByName(entering), now, self.settings))
        if rows is None or (threshold is not None and len(rows) < self.settings.top_cells):
            table = live()
            rows = [] if table is None else self._worst(cells.not_expired(table, now, self.settings))
            threshold = None
            self.refills += 1
        if len(rows) > self.size:
            rows = rows[: self.size]
            threshold = (rows[-1][1], str(rows[-1][0]))
        mark = (None, *((None, None, None) if threshold is None else (threshold[0], None, threshold[1])))
        stored = self.spark.createDataFrame([*[(*r, None) for r in rows], mark], _STORED)
        self.table.write(stored.coalesce(1), version)

    def read(self, as_of: int | Column, version: int) -> DataFrame | None:
        """The cells to rank (grid_id, severity), or None where the index can't tell: it is of another version, or
        too many have expired since."""
        if self.table.versions()[-1:] != [version]:
            return None
        held, threshold = self._split(self.table.read())
        fresh = cells.not_expired(held, as_of, self.settings).select("grid_id", "severity")
        if threshold is not None and fresh.count() < self.settings.top_cells:
            return None
        return fresh
