"""JSON files that hold one array over many lines, read by many tasks.

Spark's multi-line reader gives a whole file to one task. Here a file is read as text cut at every closing brace, which
Spark splits at any byte, so a task has a run of pieces that may begin inside a record or a text value. A first pass
sums up each split (quotes, depth of braces), a running total over the splits of a file says in which state each one
begins, and a second pass cuts the records. What hangs over the ends of splits is joined in the order of the file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_SUMMARY = "path string, start long, n_bytes long, file_size long, flips boolean, rise_outside long, rise_inside long"
_CUT = "path string, start long, part int, opens boolean, value string"
# What one fragment is: the end of a record begun before, a whole record, the beginning of a record.
_TAIL, _WHOLE, _HEAD = 0, 1, 2


def _braces(piece: str, inside: bool) -> tuple[int, bool]:
    """Opening braces of a piece that count, and whether a text value is open at its end."""
    if "\\" in piece:
        piece = _ESCAPED.sub("", piece)
    between = piece.split('"')
    return sum(b.count("{") for b in between[inside::2]), inside ^ (len(between) % 2 == 0)


def _rise(piece: str, inside: bool) -> tuple[int, bool]:
    """The change of depth over a piece and the closing brace after it."""
    opened, inside = _braces(piece, inside)
    return opened - (not inside), inside


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "start", "n_bytes", "file_size", "flips", "rise_outside", "rise_inside"]
    done: dict[tuple[str, int], list] = {}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("path", "start", "file_size", "value")]
        for path, start, size, piece in zip(*columns):
            s = done.setdefault((path, start), [0, size, False, 0, 0])
            s[0] += len(piece.encode()) + 1
            # Both beginnings are followed: outside and inside of a text value.
            outside, flipped = _rise(piece, s[2])
            inside, _ = _rise(piece, not s[2])
            s[2], s[3], s[4] = flipped, s[3] + outside, s[4] + inside
    rows = [[*key, *s] for key, s in done.items()]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names)


def _beginnings(summaries: DataFrame) -> DataFrame:
    """The state in which each split begins, and whether a file's last piece lacks its closing brace.

    One row a split; the windows are over the splits of one file.
    """
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    flips = F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1
    told = summaries.withColumn("inside", flips)
    rise = F.when(F.col("inside"), F.col("rise_inside")).otherwise(F.col("rise_outside"))
    told = told.withColumn("rise", rise).withColumn("depth", F.coalesce(F.sum("rise").over(before), F.lit(0)))
    # The reader skips a byte order mark of three bytes.
    surplus = F.sum("n_bytes").over(whole) - F.col("file_size")
    last = F.col("start") == F.max("start").over(whole)
    return told.select("path", "start", "inside", "depth", (last & surplus.isin(1, -2)).alias("cut_off"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and the fragments at the ends of splits. Rows of a split come together and in order."""
    key, state = None, None
    for batch in batches:
        out: list[tuple] = []
        names = ("path", "start", "value", "inside", "depth", "cut_off")
        for path, start, piece, inside, depth, cut_off in zip(*[batch.column(c).to_pylist() for c in names]):
            if (path, start) != key:
                if key is not None:
                    out += _rest(key, state)
                key = (path, start)
                # Held pieces, inside a text value, depth, whether the record began in an earlier split.
                state = [[], inside, depth, depth > 0 or inside, cut_off]
            _take(key, state, piece, out)
        yield _fragments(out)
    if key is not None:
        yield _fragments(_rest(key, state))


def _take(key: tuple[str, int], state: list, piece: str, out: list[tuple]) -> None:
    held, inside, depth, begun, _ = state
    if depth <= 0 and not held and not inside:
        # Between records: commas and brackets go. A stray closing brace is dropped with its piece.
        opening = piece.find("{")
        if opening < 0:
            return
        piece, depth = piece[opening:], 0
    rise, inside = _rise(piece, inside)
    depth += rise
    held.append(piece + "}")
    if depth <= 0 and not inside:
        out.append((*key, _TAIL if begun else _WHOLE, False, "".join(held)))
        held, begun = [], False
    state[:4] = held, inside, depth, begun


def _rest(key: tuple[str, int], state: list) -> list[tuple]:
    held, _, _, begun, cut_off = state
    if not held or cut_off:
        return []
    return [(*key, _TAIL if begun else _HEAD, True, "".join(held))]


def _fragments(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["path", "start", "part", "opens", "value"]
    )


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """The objects of JSON arrays as text, one row each in column `value`, in UTF-8 files below `path`.

    Files of one object per line or of objects in sequence are read as well. An object that the end of its file cuts
    off is left out, and the objects before it are kept. The files are read three times (sums, whole records, shared records); the states of the splits go to all
    tasks, which is one row for each split of `spark.sql.files.maxPartitionBytes`.
    """
    pieces = _pieces(spark, path)
    begun = _beginnings(pieces.mapInArrow(_summarise, _SUMMARY))
    # Sent to all tasks, since a shuffle of the pieces would lose their order.
    known = pieces.drop("file_size").join(F.broadcast(begun), ["path", "start"])
    cut = known.mapInArrow(_cut, _CUT)
    whole = cut.filter(F.col("part") == _WHOLE).select("value")
    # At most two fragments a split: the records that splits share.
    order = Window.partitionBy("path").orderBy("start", "part")
    hanging = cut.filter(F.col("part") != _WHOLE)
    shared = (
        hanging.withColumn("record", F.sum(F.when(F.col("part") == _HEAD, 1).otherwise(0)).over(order))
        .groupBy("path", "record")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "part", "value"))).alias("parts"),
            F.bool_or(~F.col("opens")).alias("closed"),
        )
        .filter("closed")
        .select(F.array_join(F.transform("parts", lambda p: p["value"]), "").alias("value"))
    )
    return whole.unionByName(shared)
