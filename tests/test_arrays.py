"""Array files read by many tasks, against the multi-line reader and the json module."""

import json
import random

import pytest
from pyspark.sql import functions as F

from wayfold.schemas import WRAPPER
from wayfold.sources import archive
from wayfold.sources.arrays import array_records

NASTY = ["", "}", "{", '"', "\\", '\\"', '"}{', "a\\", "\n}", "],[", "ü}", "名{前", " ", '{"a": "}"}', "\\\\}\\"]


@pytest.fixture(params=[40, 1 << 20])
def split_bytes(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def found(spark, path):
    return sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in array_records(spark, str(path)).collect())


def expected(records):
    return sorted(json.dumps(r, sort_keys=True) for r in records)


@pytest.mark.parametrize("indent, ascii_only", [(None, True), (2, False)])
def test_nasty_records_across_split_ends(spark, tmp_path, split_bytes, indent, ascii_only):
    rng = random.Random(split_bytes)
    files = {}
    for name in ("a", "b"):
        records = [
            {"id": f"{name}{i}", rng.choice(NASTY) + "k": rng.choice(NASTY), "in": {"x": [rng.choice(NASTY), {"y": {}}]}}
            for i in range(6)
        ]
        files[name] = [*records, {}]
        (tmp_path / f"{name}.json").write_text(json.dumps(files[name], indent=indent, ensure_ascii=ascii_only), "utf-8")
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "blank.json").write_text("")
    assert found(spark, tmp_path) == expected(files["a"] + files["b"])


def test_other_forms_of_files(spark, tmp_path, split_bytes):
    records = [{"i": i, "t": NASTY[i]} for i in range(len(NASTY))]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records[:5]))
    (tmp_path / "mark.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(records[5:10]).encode())
    (tmp_path / "crlf.json").write_bytes(json.dumps(records[10:], indent=1).replace("\n", "\r\n").encode())
    assert found(spark, tmp_path) == expected(records)


@pytest.mark.parametrize("cut", [1, 2, 5, 13, 14])
def test_a_cut_off_record_is_left_out(spark, tmp_path, split_bytes, cut):
    text = json.dumps([{"i": 1, "t": "}"}, {"i": 2, "t": {"u": 3}}])
    (tmp_path / "f.json").write_text(text[:-cut])
    whole = [{"i": 1, "t": "}"}] + ([{"i": 2, "t": {"u": 3}}] if cut == 1 else [])
    assert found(spark, tmp_path) == expected(whole)


def test_split_archive_equals_the_multi_line_reader(spark, tmp_path, split_bytes):
    point = {"speed": 1.5, "datetime": 1_704_067_200, "x": 106.6, "y": 10.7, "working": True, "ignition": None}
    records = [{WRAPPER: {**point, "vehicle": f"v{i}"}} if i % 2 else {**point, "vehicle": f"{{{i}"} for i in range(30)]
    (tmp_path / "part.json").write_text(json.dumps(records, indent=1))
    one = archive.read_waypoints(spark, str(tmp_path))
    many = archive.read_waypoints(spark, str(tmp_path), split=True)
    assert many.schema == one.schema and many.count() == 30
    assert many.exceptAll(one).isEmpty() and one.exceptAll(many).isEmpty()


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    records = [{"vehicle": f"v{i}", "x": 106.6} for i in range(20_000)]
    (tmp_path / "part.json").write_text(json.dumps(records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = archive.read_waypoints(spark, str(tmp_path), split=True).withColumn("task", F.spark_partition_id())
        assert got.select("vehicle").distinct().count() == 20_000
        by_task = [r["count"] for r in got.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(by_task) >= 6 and max(by_task) < 5_000
