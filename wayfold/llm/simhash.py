"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A family of 2**(r+1) - 1 bit masks covers the radius r: each of the 64 positions has a vector of r+1
bits, each nonzero vector v makes a table, and the table's mask holds the positions whose vector has an
odd product with v. For r differing positions there is always a v orthogonal to all their vectors,
so every pair within the radius agrees under at least one mask.

Fingerprints that share a bucket with another one are then linked without listing the pairs of the
bucket: each stands for itself and for every value one bit away, among the bits outside the mask. Two
fingerprints within two bits meet in such a value, and no more than 65 fingerprints can meet in one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.components import components
from wayfold.llm.tables import written
from wayfold.llm.text import Texts, chunks, ranges

RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
BITS = 64

#: For each byte a number whose eight bytes hold its bits, so that up to 255 are counted in one sum.
_SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def masks(radius: int = RADIUS) -> list[int]:
    """The bit masks of the tables, as unsigned 64-bit numbers."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    return [
        sum(((v & x).bit_count() & 1) << i for i, x in enumerate(vectors)) for v in range(1, 2 ** (radius + 1))
    ]


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of hashes: bits that are set in over half of them."""
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    pieces = (counts + 254) // 255
    owner = np.repeat(np.arange(len(counts)), pieces)
    starts = np.repeat(np.cumsum(counts) - counts, pieces) + 255 * ranges(np.zeros(len(counts), np.int64), pieces)
    out = np.zeros(len(counts), np.uint64)
    if not len(starts):
        return out
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    have = owner[first]
    for lane in range(8):
        sums = np.add.reduceat(_SPREAD[lanes[:, lane]], starts).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(sums.astype(np.int64), first, axis=0)
        bits = (2 * ones > counts[have, None]).astype(np.uint64)
        for i in range(8):
            out[have] |= bits[:, i] << np.uint64(8 * lane + i)
    return out


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            t = Texts(batch.column("text"), lower=True)
            words = t.counts
            counts = np.where(words >= n, words - n + 1, (words > 0).astype(words.dtype))
            at = ranges(t.first[:-1], counts)
            last = np.minimum(at + n, np.repeat(t.first[1:], counts)) - 1
            starts, ends, data = t.starts, t.ends, t.data
            digest = xxhash.xxh64_intdigest
            spans = zip(starts[at].tolist(), ends[last].tolist())
            out = np.fromiter((digest(data[b:e], SEED) for b, e in spans), np.uint64, len(at))
            # That holds where every gap is one space; other shingles are joined anew.
            odd_gap = (starts[1:] != ends[:-1] + 1) | (t.bytes[ends[:-1]] != 32)
            odd_before = np.append(0, np.cumsum(odd_gap))
            for i in np.flatnonzero(odd_before[last] != odd_before[at]).tolist():
                w = range(int(at[i]), int(last[i]) + 1)
                out[i] = digest(b" ".join(data[starts[j] : ends[j]] for j in w), SEED)
            prints = _majority(out, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"]
            )

    return run


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint as a signed long), a row for each row. Texts without words get zero."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprints(shingle_words), "doc_id long, fingerprint long"
    )


def _values(table: Column, masks: list[int]) -> Column:
    """The fingerprint and all values one bit away from it outside the mask of the table."""
    flips = [[signed(1 << i) for i in range(BITS) if not m >> i & 1] for m in masks]
    arrays = [F.array(F.lit(0).cast("long"), *(F.lit(x).cast("long") for x in f)) for f in flips]
    chosen = reduce(lambda rest, i: F.when(table == i, arrays[i]).otherwise(rest), range(1, len(masks)), arrays[0])
    return F.transform(chosen, lambda x: x.bitwiseXOR(F.col("fp")))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of `fp` at most `radius` bits apart."""
    if radius != RADIUS:
        raise ValueError("values one bit away join fingerprints at most two bits apart")
    all_masks = masks(radius)
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
            for i, m in enumerate(all_masks)
        )
    )
    rows = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.table", "k.key")
    shared = (
        rows.groupBy("table", "key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    )
    candidates = rows.join(shared.select("table", "key"), ["table", "key"], "left_semi")
    values = candidates.select("fp", F.explode(_values(F.col("table"), all_masks)).alias("value"))
    met = values.groupBy("value").agg(F.sort_array(F.collect_set("fp")).alias("fps")).filter(F.size("fps") > 1)
    return met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, BITS + 1)).alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links of at most two differing bits.
    Null and empty texts have the fingerprint zero and are linked like any other. Rows without doc_id are
    linked as well but never name a component; where no row of a component has one, it is null. Repeated
    rows give repeated rows. Other columns are ignored; an empty table gives an empty result.
    """
    rows = written(fingerprints(docs, shingle_words), "fingerprints")
    distinct = written(
        rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("low")), "distinct-fingerprints"
    )
    member = components(links(distinct), "simhash-components").withColumnRenamed("node", "fp")
    lows = distinct.join(member, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    named = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    to_component = lows.join(named, "component").select("fp", "component_id")
    return rows.join(to_component, rows.fingerprint == to_component.fp).select(
        "doc_id", "fingerprint", "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its component; rows without doc_id stay."""
    found = near_duplicates(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("copy_id")).distinct()
    return docs.join(found, docs.doc_id == found.copy_id, "left_anti")
