"""Removal of word passages that already occur in an earlier document, by relative Lempel-Ziv parsing.

Documents are parsed against an index of all passages rather than against each other. Each window of
`window` words has an anchor: the gram of `anchor` words in it with the least hash (the first of equals),
so equal windows have equal anchors wherever they stand. The windows that share an anchor form a segment
of less than 2 * window words. Distinct segments are the reference blocks; the index holds, for each, the
smallest doc_id that has it.

1. A segment that is found whole with a smaller doc_id is part of a long factor: all its windows are
   duplicates. Copies consist of such segments almost alone, and cost one row per segment.
2. At the borders of factors a segment is not found whole, but some of its windows may still be. Of each
   distinct segment whose anchor also stands in another one, the first document looks its windows up
   one by one in an index of the windows of these segments.

Together the two steps decide every window of every document, so the result doesn't depend on the
parse. Words, segments and windows are compared by 64-bit hashes; the latter two also by their anchor's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import text as T
from wayfold.llm.tables import written

WINDOW = 50
ANCHOR = 10


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each position the place of the least of `width` values from there on, the first of equals."""
    low, place, covered = values, np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        right = low[step:] < low[:-step]
        low = np.where(right, low[step:], low[:-step])
        place = np.where(right, place[step:], place[:-step])
        covered += step
    return place


def _segments(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, "text"):
            t = T.Texts(batch.column("text"))
            words = t.word_hashes()
            if len(words) < window:
                continue
            grams = T.gram_hashes(words, anchor)
            place = _first_least(grams, window - anchor + 1)
            counts = np.maximum(t.counts - window + 1, 0)
            at = T.ranges(t.first[:-1], counts)
            if not len(at):
                continue
            row = np.repeat(np.arange(len(counts)), counts)
            chosen = place[at]
            begins = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])))
            sizes = np.diff(np.append(begins, len(at)))
            first, row = at[begins], row[begins]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    batch.column("text_hash").take(pa.array(row)),
                    pa.array(grams[chosen[begins]].view(np.int64)),
                    pa.array(_run_hashes(words, first, sizes + window - 1).view(np.int64)),
                    pa.array((first - t.first[row]).astype(np.int32)),
                    pa.array(sizes.astype(np.int32)),
                ],
                ["doc_id", "text_hash", "anchor", "segment", "start", "windows"],
            )

    return run


def _run_hashes(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    up, down = T._GRAM_POWERS.upto(len(words))
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(words * up))
    return T.mix((sums[first + sizes] - sums[first]) * down[first] + sizes.astype(np.uint64))


def _windows(window: int):
    """Rows (anchor, hash of the window, doc_id, text_hash, start) of the listed segments of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, "text"):
            t = T.Texts(batch.column("text"))
            hashes = T.gram_hashes(t.word_hashes(), window)
            listed = batch.column("listed")
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
            anchor, start, count = (np.asarray(x) for x in listed.flatten().flatten())
            at = T.ranges(t.first[row] + start, count)
            owner = np.repeat(row, count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(anchor, count)),
                    pa.array(hashes[at].view(np.int64)),
                    batch.column("doc_id").take(pa.array(owner)),
                    batch.column("text_hash").take(pa.array(owner)),
                    pa.array((at - t.first[owner]).astype(np.int32)),
                ],
                ["anchor", "hash", "doc_id", "text_hash", "start"],
            )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, "text"):
            t = T.Texts(batch.column("text"))
            spans = batch.column("spans")
            per_row = pc.list_value_length(spans).fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(batch)), per_row)
            edge = np.zeros(len(t.starts) + 1, np.int64)
            if len(row):
                start, count = (np.asarray(x) for x in spans.flatten().flatten())
                np.add.at(edge, t.first[row] + start, 1)
                np.add.at(edge, t.first[row] + start + count + window - 1, -1)
            kept = np.cumsum(edge)[:-1] == 0
            before = np.append(0, np.cumsum(kept))
            n_kept = before[t.first[1:]] - before[t.first[:-1]]
            begin, end = t.starts[kept].tolist(), t.ends[kept].tolist()
            words = [t.data[b:e] for b, e in zip(begin, end)]
            cuts = np.append(0, np.cumsum(n_kept)).tolist()
            texts = [b" ".join(words[a:b]).decode() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(t.counts), pa.array(t.counts - n_kept), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "text"],
            )

    return run


def duplicate_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, text_hash, start, windows): runs of windows that also start in a smaller doc_id."""
    named = _hashed(docs).filter("doc_id is not null")
    found = written(
        named.mapInArrow(
            _segments(window, anchor),
            "doc_id long, text_hash long, anchor long, segment long, start int, windows int",
        ),
        "segments",
    )
    blocks = found.groupBy("anchor", "segment").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    blocks = written(blocks, "blocks")
    # Blocks whose anchor stands in several distinct segments of several documents: their first documents look on.
    several = (
        blocks.groupBy("anchor")
        .agg(F.min("first_id").alias("low"), F.max("first_id").alias("high"))
        .filter("low < high").select("anchor", F.lit(True).alias("is_open"))
    )
    # Most blocks are of one document and share their anchor with no other: they decide nothing.
    deciding = blocks.join(several, "anchor", "left").filter("first_id < last_id or is_open")
    known = written(
        found.join(deciding, ["anchor", "segment"]).select(
            "doc_id", "text_hash", "start", "windows", (F.col("doc_id") > F.col("first_id")).alias("whole"),
            F.when(F.col("is_open") & (F.col("doc_id") == F.col("first_id")), F.col("anchor")).alias("open_anchor"),
        ).filter("whole or open_anchor is not null"),
        "deciding",
    )
    whole = known.filter("whole").select("doc_id", "text_hash", "start", "windows")
    listed = (
        known.filter("not whole")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct(F.col("open_anchor").alias("anchor"), "start", "windows")).alias("listed"))
    )
    looked_up = named.join(listed, ["doc_id", "text_hash"]).mapInArrow(
        _windows(window), "anchor long, hash long, doc_id long, text_hash long, start int"
    )
    looked_up = written(looked_up, "windows")
    index = looked_up.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    single = (
        looked_up.join(index.filter("first_id < last_id"), ["anchor", "hash"])
        .filter("doc_id > first_id")
        .select("doc_id", "text_hash", "start", F.lit(1).alias("windows"))
    )
    return whole.union(single)


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash")
    )


def deduplicate(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, text) for each row of `docs` (doc_id, text).

    `text` holds the words that stay, joined by one space. A word goes if it lies in a window whose words
    also start in a document with a smaller doc_id; windows are judged on the input. Null and empty texts
    have no words and give an empty text. Rows with the same doc_id don't affect each other; rows without
    doc_id neither lose words nor take any from others. Other columns are ignored; an empty table gives an
    empty result. A task holds about 40 bytes for each byte of the longest text.
    """
    spans = (
        duplicate_windows(docs, window, anchor)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    )
    return (
        _hashed(docs)
        .join(spans, ["doc_id", "text_hash"], "left")
        .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, text string")
    )
