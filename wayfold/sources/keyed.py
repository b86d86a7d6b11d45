"""A keyed folder that tasks write to by themselves: each task its own file, a batch visible with one manifest.

    keyed.register(spark)
    rows.writeStream.format(keyed.FORMAT).option("path", folder).option("checkpointLocation", ...).start()
    keyed.read_latest(spark, folder, "bus_id", "event_id")

No rows pass the driver; it gets one short message a task. A task that fails removes its file, and a batch that fails
the files of its finished tasks. A file left by a lost or killed worker is in no manifest, so no reader sees it, and
`clean` removes it. A batch that already has a manifest is not written again: the files of the repeat are removed. The path is a local or mounted folder, or an
address that pyarrow's file systems know (`hdfs://`, `s3://`, `gs://`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from wayfold.sources import tables

FORMAT = "keyed_folder"
_ROWS, _MANIFESTS = "rows", "manifests"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


@dataclass
class TaskFile(WriterCommitMessage):
    name: str | None
    rows: int


class TaskWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskFile:
        store, path = _opened(self.path)
        # A name of its own for each attempt, so two attempts of a task don't meet.
        name = f"{uuid.uuid4().hex}.parquet"
        target, writer, rows = f"{path}/{_ROWS}/{name}", None, 0
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    store.create_dir(f"{path}/{_ROWS}", recursive=True)
                    writer = pq.ParquetWriter(target, batch.schema, filesystem=store)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer is not None:
                writer.close()
        except BaseException:
            if writer is not None:
                writer.close()
                store.delete_file(target)
            raise
        return TaskFile(name if rows else None, rows)

    def _remove(self, messages) -> None:
        store, path = _opened(self.path)
        for message in messages:
            if message is not None and message.name is not None:
                store.delete_file(f"{path}/{_ROWS}/{message.name}")

    def commit(self, messages, batchId: int) -> None:
        store, path = _opened(self.path)
        folder = f"{path}/{_MANIFESTS}"
        store.create_dir(folder, recursive=True)
        target = f"{folder}/{batchId:020d}"
        if store.get_file_info(target).type != fs.FileType.NotFound:
            self._remove(messages)
            return
        files = [{"batch_id": batchId, "name": m.name, "rows": m.rows} for m in messages if m.name is not None]
        # Names that begin with an underscore are not listed by Spark, so the manifest appears whole.
        draft = f"{folder}/_{batchId:020d}"
        with store.open_output_stream(draft) as out:
            out.write("\n".join(map(json.dumps, files)).encode())
        store.move(draft, target)

    def abort(self, messages, batchId: int) -> None:
        self._remove(messages)


class KeyedFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> TaskWriter:
        return TaskWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KeyedFolder)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, name, rows) of the files of all finished batches."""
    folder = f"{path.rstrip('/')}/{_MANIFESTS}"
    schema = "batch_id long, name string, rows long"
    if not tables.path_exists(spark, f"{folder}/*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All rows of the finished batches, with their `batch_id`."""
    folder = f"{path.rstrip('/')}/{_ROWS}"
    known = committed(spark, path)
    if not tables.path_exists(spark, folder):
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("long"))
    found = spark.read.schema(schema).parquet(folder).withColumn("name", F.col("_metadata.file_name"))
    return found.join(known.select("name", "batch_id"), "name").drop("name")


def read_latest(spark: SparkSession, path: str, schema: StructType, key: str, order: str) -> DataFrame:
    """The row of each key with the greatest `order`, in the newest batch that has the key."""
    rows = read(spark, path, schema)
    values = [f.name for f in schema.fields if f.name != key]
    newest = F.max_by(F.struct(*values), F.struct("batch_id", order))
    # Merged in each task before the shuffle, so a hot key sends one row a task.
    return rows.groupBy(key).agg(newest.alias("r")).select(key, "r.*")


def clean(spark: SparkSession, path: str) -> list[str]:
    """Remove the files that lost workers left behind, and name them. Not while a batch is being written."""
    folder = f"{path.rstrip('/')}/{_ROWS}"
    names = [(f.rsplit("/", 1)[1],) for f in tables.files_below(spark, folder)] if tables.path_exists(spark, folder) else []
    known = committed(spark, path).select("name")
    left = [r["name"] for r in spark.createDataFrame(names, "name string").join(known, "name", "left_anti").collect()]
    for name in left:
        tables.remove_folder(spark, f"{folder}/{name}")
    return sorted(left)
