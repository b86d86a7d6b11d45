"""N-gram Jaccard join by T-occurrence search: which documents share nearly all their shingles.

Sets are dealt to lists by size, such that two similar ones are on a list together, where similar sets differ in at
most D shingles. Shingles fall into parts by hash, a few more than D + 1, and each part with all its shingles is a key.
Every difference spoils one key, so of the D + 1 keys that are seen least in the corpus two similar sets share one at
least. Those keys route a search to the sets it could retain. For a query set and the sets routed to it, a task inverts
these sets into a list of sets for each shingle of the query, and retains the sets that occur on at least T lists:
the longest lists are set aside, the short ones are merged by a heap that skips what can't reach T any more, and
what is found there is looked up in the long lists by binary search.

Equal sets are one from the start. Of the sets with one key, one is the query of all others, and sets that a search
has linked are one group; that is repeated with other queries, and only where groups are left apart are their sets
compared pair by pair, by bits, in tasks that hold two blocks of sets of one key. So a large group of near copies takes
as many searches as it has members.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfold.llm import text as T
from wayfold.llm.components import components
from wayfold.llm.tables import BROADCAST_BYTES, join_back, written

SHINGLE_WORDS = 3
#: The similarity as a fraction, so that all limits are whole numbers.
SIMILAR = (9, 10)
#: Parts are ordered by how often their shingles' buckets of hashes are seen in the corpus, rarest first; 4 bytes a bucket.
BUCKET_BITS = 18
#: Bits of the parity of a set's shingles by bucket: two sets differ in at least as many shingles as bits.
PARITY_BITS = 1024
#: Searches with one query for each key before what is left is compared pair by pair.
ROUNDS = 3
#: Sets of one key that are compared with as many others at once.
BLOCK_SETS = 512
#: Sets of about this many shingles together are searched at once for one query.
BLOCK_SHINGLES = 1 << 18
#: Cost of a binary search against a step of the heap, as the division into short and long lists weighs them.
PROBE_COST = 0.0085


def needed(n_a, n_b):
    """Shingles that sets of two sizes must share: the least c with c * down >= up * (n_a + n_b - c)."""
    up, down = SIMILAR
    return -(-up * (n_a + n_b) // (up + down))


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Smallest size of each class of sets, and the largest size of a set similar to one of the class."""
    up, down = SIMILAR
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, least[-1] * 5 // 4))
    least = np.array(least, np.int64)
    return least[:-1], (least[1:] - 1) * down // up


LEAST, MOST = _classes()


def differing(of: int) -> int:
    """The most shingles in which a set of a class and a similar, larger one differ."""
    up, down = SIMILAR
    return int(LEAST[of + 1] - 1 + MOST[of]) * (down - up) // (down + up)


def part_keys(own: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Keys of a set of sorted hashes, of which any similar, different set has one too; `rare` weighs each shingle."""
    last = int(np.searchsorted(LEAST, len(own), side="right")) - 1
    first = max(int(np.searchsorted(MOST, len(own))), 0)
    # From unsigned hashes in the same order, so that a part is a range.
    hashes = own.view(np.uint64) ^ np.uint64(1 << 63)
    sums = np.append(np.uint64(0), np.cumsum(T.mix(hashes)))
    weights = np.append(0, np.cumsum(rare))
    keys = []
    for of in range(first, last + 1):
        most = differing(of)
        if not most:
            continue
        n = most + 1 + most // 16
        part = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        at = np.searchsorted(part, np.arange(n + 1, dtype=np.uint64))
        salt = T.mix(np.arange(n, dtype=np.uint64) + np.uint64((of + 1) << 48))
        key = T.mix((sums[at[1:]] - sums[at[:-1]]) ^ salt)
        # One order for all sets: equal parts have equal weights and keys.
        order = np.lexsort((key, weights[at[:-1]] - weights[at[1:]]))
        keys.append(key[order[: most + 1]])
    return np.concatenate(keys).view(np.int64) if keys else own[:0]


def t_occurrence(query: np.ndarray, sets: list[np.ndarray], need: np.ndarray) -> np.ndarray:
    """Numbers of the sets that share at least `need` (by set) elements with the query; arrays are sorted and distinct."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every = np.concatenate(sets) if sets else query[:0]
    at = np.searchsorted(query, every)
    hit = np.flatnonzero(query[np.minimum(at, len(query) - 1)] == every) if len(query) else at[:0]
    hit = hit[np.argsort(at[hit], kind="stable")]
    bounds = np.searchsorted(at[hit], np.arange(len(query) + 1))
    owners = owner[hit]
    lists = [owners[a:b] for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
    least = max(int(need.min(initial=1)), 1)
    if len(lists) < least:
        return np.zeros(0, np.int64)
    lists.sort(key=len)
    n_long = min(least - 1, int(least / (PROBE_COST * log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    found = _merge_skip([s.tolist() for s in short], least - n_long)
    if not found:
        return np.zeros(0, np.int64)
    ids, counts = np.array(list(found)), np.array(list(found.values()))
    for one in long:
        place = np.searchsorted(one, ids)
        counts += one[np.minimum(place, len(one) - 1)] == ids
    return ids[counts >= need[ids]]


def _merge_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Numbers on at least `least` of the sorted lists, with how many, by a heap of the lists' heads."""
    heap = [(one[0], i, 0) for i, one in enumerate(lists)]
    heapq.heapify(heap)
    found = {}
    while len(heap) >= least:
        head = heap[0][0]
        popped = []
        while heap and heap[0][0] == head:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            found[head] = len(popped)
            goal = head + 1
        else:
            # With one list fewer than needed out of the heap, nothing below its head can be on enough.
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            goal = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(lists[i], goal, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))
    return found


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none for a text without words."""
    t = T.Texts(batch.column("text"), lower=True)
    words = t.word_hashes()
    for a, b in zip(t.first[:-1].tolist(), t.first[1:].tolist()):
        yield np.unique(T.gram_hashes(words[a:b], min(n, b - a)).view(np.int64)) if b > a else np.zeros(0, np.int64)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _parity(own: np.ndarray) -> np.ndarray:
    odd = np.bincount(own & (PARITY_BITS - 1), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _name(own: np.ndarray) -> int:
    """A hash of a set."""
    return int(T.mix(own.view(np.uint64) + np.uint64(len(own))).sum(dtype=np.uint64).view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.append(0, np.cumsum([len(a) for a in arrays])), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def _seen(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for chunk in T.chunks(iter([batch]), "text"):
                for own in _sets(chunk, n):
                    np.add.at(counts, _bucket(own), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["bucket", "seen"])

    return run


def _listed(n: int, seen: np.ndarray):
    """Name, size, parity bits and keys of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = np.rint(16 * np.log2(1 + seen.sum(dtype=np.int64) / np.maximum(seen, 1))).astype(np.int64)
        for batch in T.chunks(batches, "text"):
            names, sizes, bits, keys = [], [], [], []
            for own in _sets(batch, n):
                names.append(_name(own) if len(own) else None)
                sizes.append(len(own))
                bits.append(_parity(own))
                keys.append(part_keys(own, rare[_bucket(own)]) if len(own) else own)
            columns = [batch.column("doc_id"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), _lists(bits), _lists(keys)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "name", "n", "bits", "keys"])

    return run


def _named(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, "text"):
            own = list(_sets(batch, n))
            names = pa.array([_name(s) for s in own], pa.int64())
            yield pa.RecordBatch.from_arrays([names, _lists(own)], ["name", "shingles"])

    return run


def _search(table: pa.Table) -> pa.Table:
    """The sets of a block that are similar to its query, which is the row without `y`."""
    q = table.column("q")[0].as_py()
    ys = table.column("y").to_pylist()
    flat = table.column("shingles").combine_chunks()
    own = [flat[i].values.to_numpy(zero_copy_only=False) for i in range(len(ys))]
    at = ys.index(None)
    others = [i for i in range(len(ys)) if i != at]
    sizes = np.array([len(own[i]) for i in others], np.int64)
    kept = t_occurrence(own[at], [own[i] for i in others], needed(len(own[at]), sizes))
    found = [ys[others[i]] for i in kept.tolist()]
    return pa.table([pa.array([q] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"])


def search(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of `pairs` (q, y, block) whose sets (name, shingles) are similar, as (a, b)."""
    side = sets.withColumnRenamed("name", "y")
    routed = pairs.join(side, "y").select("q", "block", "y", "shingles")
    queries = pairs.select("q", "block").distinct().join(sets.withColumnRenamed("name", "q"), "q")
    queries = queries.select("q", "block", F.lit(None).cast("long").alias("y"), "shingles")
    return routed.unionByName(queries).groupBy("q", "block").applyInArrow(_search, "a long, b long")


def _apart(lists: DataFrame) -> DataFrame:
    """The rows of lists that hold sets of two groups or more."""
    open_lists = lists.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high")
    return lists.join(open_lists.select("key"), "key", "left_semi")


def _routed(lists: DataFrame, queries: DataFrame) -> DataFrame:
    """(q, y, block): for each key its query (key, members, q, n_q, group_q) with the sets it could retain."""
    up, down = SIMILAR
    both = lists.join(queries, "key").filter((F.col("name") != F.col("q")) & (F.col("group") != F.col("group_q")))
    both = both.filter(up * F.greatest("n", "n_q") <= down * F.least("n", "n_q"))
    blocks = F.ceil(F.col("members") * F.col("n") / F.lit(BLOCK_SHINGLES))
    return both.groupBy("q", F.col("name").alias("y")).agg(
        F.min(F.pmod(F.xxhash64("name"), blocks)).alias("block"), F.min(F.col("n") + F.col("n_q")).alias("both")
    )


def _possible(pairs: DataFrame, parities: DataFrame) -> DataFrame:
    """The routed pairs (q, y, block, both) whose parity bits (name, bits) do not differ in more than similar sets may."""
    up, down = SIMILAR
    side = lambda c: parities.select(F.col("name").alias(c), F.col("bits").alias(f"bits_{c}"))
    differ = F.zip_with("bits_q", "bits_y", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    differ = F.aggregate(differ, F.lit(0), lambda a, b: a + b)
    need = F.expr(f"({up} * both + {up + down - 1}) div {up + down}")
    return pairs.join(side("q"), "q").join(side("y"), "y").filter(differ <= F.col("both") - 2 * need).select("q", "y", "block")


def _pairs(name: np.ndarray, n: np.ndarray, group: np.ndarray, block: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Pairs of the sets of two blocks of one key that may be similar and are in two groups: smaller name, larger, most shingles."""
    up, down = SIMILAR
    left = np.flatnonzero(block == block[0])
    right = np.flatnonzero(block == block[-1])
    found = []
    for i in left.tolist():
        y = right[(group[right] != group[i]) & (name[right] > name[i] if block[0] == block[-1] else True)]
        y = y[up * np.maximum(n[y], n[i]) <= down * np.minimum(n[y], n[i])]
        both = n[y] + n[i]
        y = y[np.bitwise_count(bits[y] ^ bits[i]).sum(axis=1, dtype=np.int64) <= both - 2 * needed(n[y], n[i])]
        found.append((np.full(len(y), i), y))
    q, y = (np.concatenate(x) for x in zip(*found))
    return np.array([np.minimum(name[q], name[y]), np.maximum(name[q], name[y]), np.maximum(n[q], n[y])])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each cell of rows that come in the order of key and cell; holds one cell and a batch."""
    held = []
    for batch in batches:
        if len(batch):
            held.append(batch)
            yield from _cells(held, whole=False)
    if held:
        yield from _cells(held, whole=True)


def _cells(held: list[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    ends = [(b.column("key")[at].as_py(), b.column("cell")[at].as_py()) for b, at in ((held[0], 0), (held[-1], len(held[-1]) - 1))]
    if ends[0] == ends[1] and not whole:
        return
    rows = pa.Table.from_batches(held)
    key, cell = rows.column("key").to_numpy(), rows.column("cell").to_numpy()
    bounds = np.concatenate([[0], 1 + np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])), [len(key)]])
    columns = [rows.column(c).to_numpy() for c in ("name", "n", "group", "block")]
    bits = rows.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(key), -1)
    for a, b in zip(bounds[:-1], bounds[1:] if whole else bounds[1:-1]):
        found = _pairs(*(c[a:b] for c in columns), bits[a:b])
        if found.size:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["q", "y", "n"])
    held[:] = [] if whole else rows.slice(bounds[-2]).combine_chunks().to_batches()


def _all_pairs(lists: DataFrame, parities: DataFrame) -> DataFrame:
    """(q, y, block): all pairs of sets of one key and two groups whose sizes and parity bits do not rule them out."""
    counted = lists.join(lists.groupBy("key").agg(F.ceil(F.count("*") / F.lit(BLOCK_SETS)).alias("blocks")), "key")
    dealt = counted.withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    dealt = dealt.select("key", cell.alias("cell"), "block", "name", "n", "group").join(parities, "name")
    ordered = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "block")
    found = ordered.mapInArrow(_compared, "q long, y long, n long").distinct()
    found = written(found, "possible-pairs")
    blocks = found.groupBy("q").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).alias("blocks"))
    return found.join(blocks, "q").select("q", "y", F.pmod(F.xxhash64("y"), F.col("blocks")).alias("block"))


def short_list_rows(sets: DataFrame) -> DataFrame:
    """(key, name, n, group): the keys of `sets` (name, n, keys) on which two sets meet."""
    every = sets.select("name", "n", F.explode("keys").alias("key"))
    met = every.withColumn("members", F.count("*").over(Window.partitionBy("key"))).filter("members > 1")
    return written(met.select("key", "name", "n", F.col("name").alias("group")), "short-lists")


def links(lists: DataFrame, parities: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges (a, b) between names, whose components are those of all similar pairs.

    `lists` is as from `short_list_rows`; `parities` has (name, bits); `sets` gives the table (name, shingles)
    for the names of a table.
    """
    parities = written(parities.join(lists.select("name").distinct(), "name", "left_semi"), "set-parities")
    edges = None
    for turn in range(ROUNDS + 1):
        if turn < ROUNDS:
            # One query for each key, another one in each round.
            one = F.min_by(F.struct("name", "n", "group"), F.xxhash64("name", F.lit(turn))).alias("one")
            queries = lists.groupBy("key").agg(one, F.count("*").alias("members")).select("key", "members", "one.*")
            as_query = [F.col(c).alias(a) for c, a in (("name", "q"), ("n", "n_q"), ("group", "group_q"))]
            pairs = _possible(_routed(lists, queries.select("key", "members", *as_query)), parities)
        else:
            pairs = _all_pairs(lists, parities)
        pairs = written(pairs, "routed-sets")
        wanted = pairs.select(F.col("q").alias("name")).union(pairs.select("y")).distinct()
        found = search(pairs, sets(wanted))
        edges = written(found if edges is None else edges.union(found), "ngram-links")
        if turn < ROUNDS:
            groups = components(edges, "ngram-groups").select(F.col("node").alias("name"), F.col("component").alias("now"))
            told = lists.drop("group").join(groups, "name", "left").withColumn("group", F.coalesce("now", "name"))
            lists = written(_apart(told.drop("now")), "short-lists")
            if lists.isEmpty():
                break
    return edges


def join(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links, itself included; rows without doc_id link
    as any other but name no component. A text of fewer words than a shingle is one shingle; a null text, or one
    without words, has an empty set and is linked with nothing. Repeated rows are equal sets. Words are compared
    without the case of ASCII letters, shingles, parts and sets by 64-bit hashes. Other columns are ignored; an empty table
    gives an empty result. A task holds the shingles of one text, or of a block of sets and their query, or the bits of two blocks.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = docs.select("text").mapInArrow(_seen(shingle_words), "bucket int, seen long").groupBy("bucket").agg(F.sum("seen"))
    seen = np.zeros(1 << BUCKET_BITS, np.int64)
    for bucket, n in counted.collect():
        seen[bucket] = n
    seen = np.minimum(seen, 2**31 - 1).astype(np.int32)
    rows = docs.mapInArrow(_listed(shingle_words, seen), "doc_id long, name long, n long, bits array<long>, keys array<long>")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "ngram-sets")
    filled = rows.filter("name is not null")
    names = written(
        filled.groupBy("name").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.min("row").alias("first")),
        "set-names",
    )
    total = rows.count()
    copies = join_back(filled.select("row", "name"), names.filter("copies > 1").select("name", "first", "copies"), "name", "copies", total)
    copies = written(copies.filter("row <> first").select("row"), "set-copies")
    if 16 * copies.count() <= BROADCAST_BYTES:
        copies = F.broadcast(copies)
    distinct = filled.join(copies, "row", "left_anti")

    def sets(wanted: DataFrame) -> DataFrame:
        carriers = names.join(wanted, "name", "left_semi").select(F.col("low").alias("carrier")).distinct()
        carriers = written(carriers, "set-carriers")
        n = carriers.count()
        if 16 * n <= BROADCAST_BYTES:
            carriers = F.broadcast(carriers)
        held = docs.join(carriers, F.col("doc_id").eqNullSafe(F.col("carrier")), "left_semi")
        found = held.select("text").mapInArrow(_named(shingle_words), "name long, shingles array<long>")
        found = written(found, "shingle-sets")
        # Only where a doc_id is null or repeated is there more than one text for a set.
        return found if found.count() <= n else written(found.dropDuplicates(["name"]), "shingle-sets")

    lists = short_list_rows(distinct.select("name", "n", "keys"))
    member = components(links(lists, distinct.select("name", "bits"), sets), "ngram-groups").withColumnRenamed("node", "name")
    told = names.join(member, "name", "left").select("name", "low", "copies", F.coalesce("component", "name").alias("component"))
    told = written(told, "set-components")
    least = told.groupBy("component").agg(F.min("low").alias("component_id"), F.sum("copies").alias("copies"))
    told = join_back(told.select("name", "component", F.col("copies").alias("held")), least, "component", "copies", total)
    told = told.select("name", "component_id", "held")
    full = join_back(filled.select("doc_id", "name", "n"), told, "name", "held", total)
    empty = rows.filter("name is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n", "component_id").unionByName(empty).withColumnRenamed("n", "n_shingles")
