"""The keyed folder: commits and aborts by task and batch, repeats, what lost workers leave."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wayfold.sources import keyed

SCHEMA = "n long, key string, v double"


class Folder:
    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        keyed.register(spark)

    def send(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(f"{self.path}/input")

    def run(self, change=lambda rows: rows, checkpoint="checkpoint"):
        rows = self.spark.readStream.schema(SCHEMA).parquet(f"{self.path}/input")
        query = (
            change(rows).writeStream.format(keyed.FORMAT).option("path", f"{self.path}/out")
            .option("checkpointLocation", f"{self.path}/{checkpoint}").trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def files(self):
        folder = f"{self.path}/out/rows"
        return sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) if os.path.isdir(folder) else []

    def latest(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        found = keyed.read_latest(self.spark, f"{self.path}/out", schema, "key", "n")
        return set(map(tuple, found.select("key", "n", "v").collect()))

    def rows(self):
        return sorted(map(tuple, keyed.read(self.spark, f"{self.path}/out", SCHEMA).select("n", "key", "v").collect()), key=str)


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, tmp_path)


def test_latest_row_of_each_key(folder):
    assert folder.rows() == []
    folder.send([(n, f"k{n % 5}", n / 2) for n in range(40)] + [(100, None, 1.0)])
    folder.run()
    folder.send([(n, "k1", -1.0) for n in range(40, 50)])
    folder.run()
    assert len(folder.rows()) == 51
    assert folder.latest() == {
        ("k1", 49, -1.0), ("k0", 35, 17.5), ("k2", 37, 18.5), ("k3", 38, 19.0), ("k4", 39, 19.5), (None, 100, 1.0)
    }


def test_a_repeated_batch_adds_nothing(folder):
    folder.send([(n, f"k{n % 3}", 0.0) for n in range(30)])
    folder.run()
    before, files = folder.rows(), folder.files()
    # A new checkpoint sends batch 0 again.
    folder.run(checkpoint="again")
    assert folder.rows() == before and folder.files() == files


def test_a_failed_task_leaves_nothing(folder):
    folder.send([(n, f"k{n % 3}", 0.0) for n in range(30)])
    fails = F.when(F.col("n") == 17, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("double")
    with pytest.raises(StreamingQueryException):
        folder.run(lambda rows: rows.withColumn("v", fails))
    # Tasks that Spark kills with the batch may leave a file; no manifest has it.
    assert folder.rows() == []
    keyed.clean(folder.spark, f"{folder.path}/out")
    assert folder.files() == []
    folder.run()
    assert len(folder.rows()) == 30


def test_a_task_removes_its_file_and_an_abort_all_files(folder):
    writer = keyed.TaskWriter(f"{folder.path}/out")
    batches = folder.spark.createDataFrame([(n, "k", 1.0) for n in range(5)], SCHEMA).toArrow().to_batches()

    def broken():
        yield from batches
        assert len(folder.files()) == 1
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(broken())
    assert folder.files() == []
    messages = [writer.write(iter(batches)), None, writer.write(iter(batches)), writer.write(iter([]))]
    assert len(folder.files()) == 2
    writer.abort(messages, 0)
    assert folder.files() == [] and folder.rows() == []


def test_files_of_lost_workers_are_not_read(folder):
    folder.send([(n, "k", 0.0) for n in range(10)])
    folder.run()
    known = folder.files()
    writer = keyed.TaskWriter(f"{folder.path}/out")
    stray = writer.write(folder.spark.createDataFrame([(99, "k", 1.0)], SCHEMA).toArrow().to_batches())
    assert stray.rows == 1 and len(folder.rows()) == 10
    assert keyed.clean(folder.spark, f"{folder.path}/out") == [stray.name]
    assert folder.files() == known
    # Empty tasks write no file.
    assert writer.write(iter([])).name is None
