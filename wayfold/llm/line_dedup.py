"""Removal of repeated and nearly repeated lines by a segment-partition edit join.

A line of `min_bytes` or more is cut into threshold + 1 segments of nearly equal length. At most `threshold`
edits leave one segment whole, and it stands in the other line at a place that the two lengths and the
edits narrow down. So each line is indexed by its segments and probes, for each length up to `threshold`
shorter, the substrings that can be such a segment. Pairs whose counts of bytes, or of pairs of neighbouring bytes,
differ in parity more often than the edits can explain are no candidates; the others are verified by a banded
bit-parallel edit distance over their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import text as T
from wayfold.llm.tables import written

THRESHOLD = 2
#: Shorter lines are only compared for equality.
MIN_BYTES = 24
#: Lines of a task whose keys have gone out and that it still remembers.
REMEMBERED = 500_000

_CLASS_BIT = (np.uint32(1) << (np.arange(256) % 32).astype(np.uint32)).astype(np.uint32)
#: By first byte * 256 + second: one of 64 classes, spread by a multiplication.
_PAIR_BIT = np.uint64(1) << (np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58))


class Lines:
    """Where the lines with a word lie in a column of texts."""

    def __init__(self, column: pa.Array):
        t = T.Texts(column)
        self.data, self.bytes = t.data, t.bytes
        edge = np.flatnonzero(t.bytes == 10)
        # A line starts at each text and after each newline.
        full = T._lengths(column) > 0
        starts = np.sort(np.concatenate([t.offsets[:-1][full], edge + 1]))
        starts = starts[np.append(True, starts[1:] != starts[:-1])] if len(starts) else starts
        starts = starts[starts < len(t.bytes)]
        ends = np.append(starts[1:], len(t.bytes))
        last_is_newline = t.bytes[ends - 1] == 10 if len(ends) else np.zeros(0, bool)
        row = np.searchsorted(t.offsets, starts, side="right") - 1
        ends = ends - last_is_newline
        word = np.searchsorted(t.starts, starts)
        has_word = np.append(t.starts, np.iinfo(np.int64).max)[word] < ends
        first = np.searchsorted(row, np.arange(len(column)))
        number = np.arange(len(starts)) - first[row]
        self.starts, self.ends, self.row, self.number = (x[has_word] for x in (starts, ends, row, number))

    @cached_property
    def _sums(self) -> np.ndarray:
        sums = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum(T._BYTE_VALUES[self.bytes] * T._WORD_POWERS.upto(len(self.bytes))[0], out=sums[1:])
        return sums

    def parities(self) -> np.ndarray:
        """For each line and each of 32 classes of bytes, whether it has an odd number of them."""
        sums = np.zeros(len(self.bytes) + 1, np.uint32)
        np.bitwise_xor.accumulate(_CLASS_BIT[self.bytes], out=sums[1:])
        return sums[self.ends] ^ sums[self.starts]

    def pair_parities(self) -> np.ndarray:
        """For each line and each of 64 classes of neighbouring bytes, whether it has an odd number of them."""
        sums = np.zeros(max(len(self.bytes), 1), np.uint64)
        pairs = self.bytes[:-1].astype(np.uint16) << 8 | self.bytes[1:]
        np.bitwise_xor.accumulate(_PAIR_BIT[pairs], out=sums[1:])
        # A line's last byte begins no pair.
        return sums[self.ends - 1] ^ sums[self.starts]

    def hashes(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        run = (self._sums[starts + sizes] - self._sums[starts]) * T._WORD_POWERS.upto(len(self.bytes) + 1)[1][starts]
        return T.mix(run + sizes.astype(np.uint64))


class Seen:
    """Lines of a task whose keys have gone out: a young and an old sorted array of at most REMEMBERED each."""

    def __init__(self):
        self._young = self._old = np.zeros(0, np.int64)

    def new(self, names: np.ndarray) -> np.ndarray:
        """Which of the sorted, distinct names are not remembered; all are from now on."""
        fresh = np.ones(len(names), bool)
        for known in (self._young, self._old):
            if len(known):
                fresh &= known[np.minimum(np.searchsorted(known, names), len(known) - 1)] != names
        add = names[fresh]
        if len(self._young) + len(add) > REMEMBERED:
            self._young, self._old = add[:0], self._young
        self._young = np.insert(self._young, np.searchsorted(self._young, add), add)
        return fresh


def segments(size: np.ndarray, threshold: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, length) of each of the threshold + 1 segments of lines of these sizes; the last are longer."""
    n = threshold + 1
    short, longer = size // n, size % n
    out, at = [], np.zeros_like(size)
    for i in range(n):
        length = short + (i >= n - longer)
        out.append((at, length))
        at = at + length
    return out


def _keys(lines: Lines, chosen: np.ndarray, threshold: int, probe: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line, key): a key holds the segment's bytes, its number and the size of the line it is a segment of."""
    starts, sizes = lines.starts[chosen], lines.ends[chosen] - lines.starts[chosen]

    def key(i: int, whole: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        tag = whole.astype(np.uint64) * np.uint64(threshold + 1) + np.uint64(i)
        return T.mix(lines.hashes(at, length) ^ T.mix(tag))

    if not probe:
        for i, (at, length) in enumerate(segments(sizes, threshold)):
            yield chosen, key(i, sizes, starts + at, length)
        return
    for shorter in range(threshold + 1):
        size = sizes - shorter
        for i, (at, length) in enumerate(segments(size, threshold)):
            # Of the edits, at most i lie before segment i if it is the first to survive, and the others after it.
            low = max(-i, shorter - (threshold - i))
            high = min(i, shorter + (threshold - i))
            for shift in range(low, high + 1):
                begin = at + shift
                fits = (begin >= 0) & (begin + length <= sizes)
                yield chosen[fits], key(i, size[fits], (starts + begin)[fits], length[fits])


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "text"):
        lines = Lines(batch.column("text"))
        row = pa.array(lines.row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(row),
                batch.column("text_hash").take(row),
                pa.array(lines.number),
                pa.array(lines.hashes(lines.starts, lines.ends - lines.starts).view(np.int64)),
            ],
            ["doc_id", "text_hash", "number", "line"],
        )


def _key_rows(threshold: int, min_bytes: int, probe: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in T.chunks(batches, "text", T.CHUNK_BYTES // 2):
            lines = Lines(batch.column("text"))
            line = lines.hashes(lines.starts, lines.ends - lines.starts).view(np.int64)
            # A line that many documents repeat leaves a task once, or few times.
            long = np.flatnonzero(lines.ends - lines.starts >= min_bytes)
            names, first = np.unique(line[long], return_index=True)
            chosen = long[first[seen.new(names)]]
            if not len(chosen):
                continue
            parity, pairs = lines.parities().view(np.int32), lines.pair_parities().view(np.int64)
            for at, key in _keys(lines, chosen, threshold, probe):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(line[at]), pa.array(key.view(np.int64)), pa.array(parity[at]), pa.array(pairs[at])],
                    ["line", "key", "parity", "pairs"],
                )

    return run


def within(a: bytes, b: bytes, threshold: int) -> bool:
    """Whether the edit distance is at most the threshold, by bit vectors of a band of 2 * threshold + 1."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > threshold:
        return False
    width = 2 * threshold + 1
    mask = (1 << width) - 1
    # Bit d of reach[e]: a[:i] and b[:i + d - threshold] are at most e edits apart.
    reach = [sum(1 << (threshold + d) for d in range(e + 1)) & mask for e in range(threshold + 1)]
    padded = bytes(threshold) + b + bytes(threshold)
    for i, c in enumerate(a):
        window = padded[i : i + width]
        same = 0
        for d in range(width):
            if window[d] == c and 0 <= i + d - threshold < len(b):
                same |= 1 << d
        new, below = [], 0
        for e in range(threshold + 1):
            now = reach[e] & same
            if e:
                # Change, drop a byte of a, and take a byte of b.
                now |= reach[e - 1] | (reach[e - 1] >> 1) | ((below << 1) & mask)
            new.append(now)
            below = now
        if not below:
            return False
        reach = new
    return bool(reach[threshold] >> (len(b) - len(a) + threshold) & 1)


def _verified(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("text_a", "text_b"))
            good = pa.array([within(x, y, threshold) for x, y in zip(a, b)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return run


def _wanted_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "text"):
        lines = Lines(batch.column("text"))
        line = lines.hashes(lines.starts, lines.ends - lines.starts).view(np.int64)
        wanted = np.unique(batch.column("wanted").flatten().to_numpy(zero_copy_only=False))
        found = np.flatnonzero(np.isin(line, wanted))
        texts = [lines.data[s:e] for s, e in zip(lines.starts[found].tolist(), lines.ends[found].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(line[found]), pa.array(texts, pa.binary())], ["line", "bytes"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "text"):
        n_lines = np.bincount(Lines(batch.column("text")).row, minlength=len(batch))
        texts = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            if gone and text:
                drop = set(gone)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
            texts.append(text or "")
        removed = pc.list_value_length(batch.column("gone")).fill_null(0).cast(pa.int64())
        links = batch.column("n_links").fill_null(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_lines), removed, links, pa.array(texts, pa.string()), *batch.columns[4:]],
            ["doc_id", "n_lines", "n_removed", "n_links", "text", *batch.schema.names[4:]],
        )


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash")
    ).filter("doc_id is not null")


def line_links(named: DataFrame, occurrences: DataFrame, threshold: int, min_bytes: int) -> DataFrame:
    """(a, b): hashes of different lines, a < b, at most `threshold` edits apart."""

    def keyed(probe: bool, name: str) -> DataFrame:
        rows = named.select("text").mapInArrow(
            _key_rows(threshold, min_bytes, probe), "line long, key long, parity int, pairs long"
        )
        # Dealt by key once, for removing repeats and for the join.
        rows = rows.select("key", *[F.col(c).alias(a) for c, a in (("line", name), ("parity", f"parity_{name}"), ("pairs", f"pairs_{name}"))])
        return rows.repartition("key").distinct()

    # An edit changes the parity of two classes of bytes at most, and of four classes of pairs.
    near = (F.bit_count(F.col("parity_a").bitwiseXOR(F.col("parity_b"))) <= 2 * threshold) & (
        F.bit_count(F.col("pairs_a").bitwiseXOR(F.col("pairs_b"))) <= 4 * threshold
    )
    probes, index = keyed(True, "b"), keyed(False, "a")
    same_key = probes["key"] == index["key"]
    candidates = (
        probes.join(index, same_key & (F.col("a") != F.col("b")) & near)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    candidates = written(candidates, "line-candidates")
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    places = (
        occurrences.join(wanted, "line")
        .groupBy("line").agg(F.min(F.struct("doc_id", "text_hash")).alias("at"))
        .groupBy("at.doc_id", "at.text_hash").agg(F.collect_list("line").alias("wanted"))
    )
    texts = (
        named.join(places, ["doc_id", "text_hash"]).select("text", "wanted")
        .mapInArrow(_wanted_texts, "line long, bytes binary")
        .groupBy("line").agg(F.min("bytes").alias("bytes"))
    )
    texts = written(texts, "line-texts")
    side = lambda c: texts.select(F.col("line").alias(c), F.col("bytes").alias(f"text_{c}"))
    pairs = candidates.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return pairs.mapInArrow(_verified(threshold), "a long, b long")


def deduplicate(
    docs: DataFrame, threshold: int = THRESHOLD, min_bytes: int = MIN_BYTES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_links, text) for each row of `docs` (doc_id, text).

    A line with a word goes if an equal line, or one at most `threshold` byte edits apart, has its first
    occurrence earlier, in the order of doc_id and place. That is judged on the input. n_links counts
    the different lines that the document's lines are linked to, line by line. Lines without a word stay. Null
    texts become empty. Rows without doc_id lose nothing and take nothing from others; repeated rows don't
    affect each other. Columns named in `keep` follow the others, the rest are ignored; an empty table gives an
    empty result.
    """
    named = _hashed(docs)
    occurrences = written(
        named.mapInArrow(_line_rows, "doc_id long, text_hash long, number long, line long"), "lines"
    )
    first = occurrences.groupBy("line").agg(
        F.min(F.struct("doc_id", "number")).alias("first"), F.max(F.struct("doc_id", "number")).alias("last")
    )
    links = written(line_links(named, occurrences, threshold, min_bytes), "line-links")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        both.join(first.select(F.col("line").alias("b"), "first"), "b")
        .groupBy(F.col("a").alias("line"))
        .agg(F.min("first").alias("other"), F.count("*").alias("links"))
    )
    # Lines that occur once and have no link need no second look.
    told = (
        first.join(linked, "line", "left").filter("first < last or links is not null")
        .select("line", F.least("first", F.coalesce("other", "first")).alias("earliest"), "links")
    )
    place = F.struct("doc_id", "number")
    per_document = (
        occurrences.join(told, "line")
        .groupBy("doc_id", "text_hash")
        # A set, since a repeated row brings each of its lines again.
        .agg(F.collect_set(F.struct("number", (F.col("earliest") < place).alias("goes"), "links")).alias("told"))
        .select(
            "doc_id",
            "text_hash",
            F.transform(F.filter("told", lambda x: x["goes"]), lambda x: x["number"]).alias("gone"),
            F.aggregate("told", F.lit(0).cast("long"), lambda n, x: n + F.coalesce(x["links"], F.lit(0))).alias("n_links"),
        )
    )
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    hashed = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"), *kept
    )
    names = [f"kept_{i}" for i in range(len(keep))]
    ready = hashed.join(per_document, ["doc_id", "text_hash"], "left").select(
        "doc_id", "text", "gone", "n_links", *names
    )
    first_columns = "doc_id long, n_lines long, n_removed long, n_links long, text string"
    schema = ", ".join([first_columns, *(f"{n} {ready.schema[n].dataType.simpleString()}" for n in names)])
    return ready.mapInArrow(_cut, schema).withColumnsRenamed(dict(zip(names, keep)))
