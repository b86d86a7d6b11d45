"""A message log in a shared folder: numbered rows in segments of bounded size, read as a stream in bounded batches.

A segment is a Parquet file named by the offset of its first row. No segment has more than `rows_per_segment` rows, so
a bound on the segments of a micro-batch is a bound on its rows. Spark's file source reads the segments and keeps in the
checkpoint which it has read; it goes by the time of a file's last change, so segments are published in the order of
their offsets, each at least a millisecond after the one before.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfold.sources import tables

OFFSET = "offset"
_DIGITS = 20


def _first_offset() -> Column:
    return F.substring(F.col("_metadata.file_name"), 1, _DIGITS).cast("long")


class SegmentLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, rows_per_segment: int = 1_000_000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.rows_per_segment = rows_per_segment

    def _segments(self) -> list[tuple[int, int, int]]:
        """First offset, rows and time of change of each segment, in order: one listing, nothing is opened."""
        files, target = tables._filesystem(self.spark, f"{self.path}/segments")
        if not files.exists(target):
            return []
        found = []
        for status in files.listStatus(target):
            name = status.getPath().getName()
            if name.endswith(".parquet"):
                first, count = name.removesuffix(".parquet").split("-")
                found.append((int(first), int(count), status.getModificationTime()))
        return sorted(found)

    def _text(self, path: str) -> str | None:
        if not tables.path_exists(self.spark, path):
            return None
        return "\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect())

    def end(self) -> int:
        """The offset that the next row will get; it counts segments that were dropped."""
        segments = self._segments()
        kept = self._text(f"{self.path}/dropped/upto")
        return max(segments[-1][0] + segments[-1][1] if segments else 0, int(kept) if kept else 0)

    def append(self, rows: DataFrame, order: str, batch_id: int) -> None:
        """Add rows at the end, numbered in the order of a column; a repeat of a batch adds nothing new.

        One writer at a time. The rows are staged, then a plan names each staged file's segment, then the files are
        moved; a repeat goes on from wherever the call before ended. Sorting is by range, so a hot key is dealt to
        many tasks; the driver handles one name a file.
        """
        staged, plan_path = f"{self.path}/staged/{batch_id}", f"{self.path}/appends/{batch_id}"
        plan = self._text(plan_path)
        if plan is None:
            columns = [f.name for f in self.schema.fields]
            # Files of a sorted write follow each other by name: task by task, and file by file in a task.
            (
                rows.sort(order).select(*columns)
                .write.mode("overwrite").option("maxRecordsPerFile", self.rows_per_segment).parquet(staged)
            )
            counted = (
                self.spark.read.schema(self.schema).parquet(staged)
                .groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
            )
            at, moves = self.end(), []
            for name, n in sorted((r["name"], r["n"]) for r in counted.collect()):
                moves.append([name, f"{at:0{_DIGITS}d}-{n}.parquet"])
                at += n
            plan = json.dumps(moves)
            tables.write_text(self.spark, plan_path, plan)
        if tables.path_exists(self.spark, staged):
            self._publish(staged, json.loads(plan))
            tables.remove_folder(self.spark, staged)

    def _publish(self, staged: str, moves: list[list[str]]) -> None:
        files, folder = tables._filesystem(self.spark, f"{self.path}/segments")
        files.mkdirs(folder)
        now = self.spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
        changed = max([now, *(time + 1 for _, _, time in self._segments())])
        for name, segment in moves:
            _, source = tables._filesystem(self.spark, f"{staged}/{name}")
            if not files.exists(source):
                continue
            _, target = tables._filesystem(self.spark, f"{self.path}/segments/{segment}")
            files.setTimes(source, changed, -1)
            if not files.rename(source, target):
                raise OSError(f"could not publish {segment}")
            changed += 1

    def drop_before(self, offset: int) -> None:
        """Remove the segments whose rows all lie before an offset. Readers that have not come so far go on after them."""
        gone = [s for s in self._segments() if s[0] + s[1] <= offset]
        if not gone:
            return
        # Before the files, so that offsets are never given twice.
        tables.write_text(self.spark, f"{self.path}/dropped/upto", str(max(self.end(), gone[-1][0] + gone[-1][1])))
        for first, count, _ in gone:
            tables.remove_folder(self.spark, f"{self.path}/segments/{first:0{_DIGITS}d}-{count}.parquet")

    def _numbered(self, segments: DataFrame, start: int) -> DataFrame:
        if start:
            # Names sort as offsets do, and a start is always the first offset of a segment.
            segments = segments.filter(F.col("_metadata.file_name") >= f"{start:0{_DIGITS}d}")
        offset = _first_offset() + F.col("_metadata.row_index")
        return segments.select(offset.alias(OFFSET), *[f.name for f in self.schema.fields])

    def read(self) -> DataFrame:
        """All rows with their `offset`, as a table."""
        files, folder = tables._filesystem(self.spark, f"{self.path}/segments")
        files.mkdirs(folder)
        return self._numbered(self.spark.read.schema(self.schema).parquet(f"{self.path}/segments"), 0)

    def start_of(self, reader: str, latest: bool) -> int:
        """Where a named reader starts: settled at its first call, so a restart does not skip what came meanwhile."""
        path = f"{self.path}/readers/{reader}"
        found = self._text(path)
        if found is None:
            found = str(self.end() if latest else 0)
            tables.write_text(self.spark, path, found)
        return int(found)

    def stream(self, max_rows: int, reader: str = "earliest", latest: bool = False) -> DataFrame:
        """The rows with their `offset` as a stream, in order, at most `max_rows` in a micro-batch.

        Progress lives in the query's checkpoint. With `latest`, a reader name starts at the end that the log had when
        the name was first used. Segments dropped before they were read are passed over.
        """
        if max_rows < self.rows_per_segment:
            raise ValueError(f"a micro-batch takes whole segments, of up to {self.rows_per_segment} rows")
        files, folder = tables._filesystem(self.spark, f"{self.path}/segments")
        files.mkdirs(folder)
        segments = (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", max_rows // self.rows_per_segment)
            .option("ignoreMissingFiles", "true")
            .parquet(f"{self.path}/segments")
        )
        return self._numbered(segments, self.start_of(reader, latest))
