"""Prefix trie of conversations: which share their first turns, and what is saved by handling those once.

A conversation is the string of its turns' ids, all of one width, so that its bytes sort as its turns do. Equal
conversations are one key with a count. Keys are dealt by range, so that a task holds neighbours and a common start
of any size is spread over as many tasks as its keys need. Each task puts its keys into a radix tree and walks it
once from the leaves; nodes are emitted where a whole number of turns ends, also inside a path.

Only the starts that a task's first key shares with the task before, and its last key with the task after, are
nodes of several tasks. Every sum over a subtree is additive if a node is counted by the first of its tasks alone,
and two lengths tell a task which nodes those are. So partial rows of these few nodes are added up by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfold.llm.radix_tree import RadixTree, shared_start
from wayfold.llm.tables import written

#: Bytes of a turn's id: 16 of a hash of role and text, and 4 of the number of code points of the text.
WIDTH = 20
#: Turns of distinct conversations a task holds in its tree, about; a single conversation is not divided.
TASK_TURNS = 200_000
#: Below that, this many turns make a task of their own, as far as there are shuffle partitions.
LEAST_TURNS = 5_000
#: Member ids are joined to pieces of about this many bytes before they are hashed in order.
PIECE_BYTES = 1 << 16

NO_ENDS = hashlib.sha256(b"").hexdigest()

_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_PARTS = (
    "p int, name binary, parent_name binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn; null role or text counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.length(text)), 8, "0")))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the ids of a conversation's turns by rising turn, null first; ties by id."""
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), turn_id(F.col("role"), F.col("text")).alias("id")
    ).filter("conv_id is not null")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id")))
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select("conv_id", F.col("t.id").alias("turns"))


def rebuilt(seqs: DataFrame, share: int = 100, heads: int = 6) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % share for its own first h.

    h is crc32 of c's decimals modulo `heads`; a conversation that is not there has no turns to give.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    given = seqs.filter(c % share == 0).select(c.alias("head_id"), F.slice("turns", 1, heads - 1).alias("head"))
    own = seqs.withColumn("head_id", c - c % share).withColumn("h", h)
    none = F.array().cast("array<binary>")
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), 1, F.greatest("h", F.lit(1)))).otherwise(none)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(given, "head_id", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring ids of a key, joined by commas, up to PIECE_BYTES."""
    key, first, ids, size = None, None, [], 0
    names = ["key_name", "first", "ids"]
    types = [pa.binary(), pa.int64(), pa.string()]
    made: list[tuple] = []

    def made_batch() -> pa.RecordBatch:
        columns = list(zip(*made)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for name, conv in zip(batch.column("key_name").to_pylist(), batch.column("conv_id").to_pylist()):
            if name != key or size > PIECE_BYTES:
                if ids:
                    made.append((key, first, ",".join(ids)))
                key, first, ids, size = name, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield made_batch()
        made.clear()
    if ids:
        made.append((key, first, ",".join(ids)))
        yield made_batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces in their order, comma-joined; a key's pieces may span batches."""
    key, state = None, None
    for batch in batches:
        done = []
        for name, ids in zip(batch.column("key_name").to_pylist(), batch.column("ids").to_pylist()):
            if name == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((key, state.hexdigest()))
            key, state = name, hashlib.sha256(ids.encode())
        yield _digest_batch(done)
    if key is not None:
        yield _digest_batch([(key, state.hexdigest())])


def _digest_batch(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["key_name", "ends_sha256"]
    )


def _ends(keyed: DataFrame) -> DataFrame:
    """(key_name, ends_sha256): the hash of the ascending ids of each key's conversations."""
    spread = keyed.select("key_name", "conv_id").repartitionByRange("key_name", "conv_id").sortWithinPartitions("key_name", "conv_id")
    pieces = spread.mapInArrow(_pieces, "key_name binary, first long, ids string")
    dealt = pieces.repartition("key_name").sortWithinPartitions("key_name", "first")
    return dealt.mapInArrow(_digests, "key_name binary, ends_sha256 string")


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns each task's first key shares with the key before, and its last with the key after; -1 without one."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("low", "before", "high", "after")]
        turns = [[-1 if b is None else shared_start(a, b) // WIDTH for a, b in zip(*columns[i : i + 2])] for i in (0, 2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("p"), pa.array(turns[0], pa.int32()), pa.array(turns[1], pa.int32())], ["p", "before", "after"]
        )


def _tree_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one task's keys: whole where no other task has them, else this task's part, with a name."""
    keys, counts, lows, ends = (table.column(c).to_pylist() for c in ("key", "n_convs", "low", "ends_sha256"))
    p, before, after = (table.column(c)[0].as_py() for c in ("p", "before", "after"))
    first, last = min(range(len(keys)), key=keys.__getitem__), max(range(len(keys)), key=keys.__getitem__)
    tree = RadixTree()
    for row, key in enumerate(keys):
        tree.insert(key, row)

    out: list[list] = [[] for _ in range(10)]
    names, parent_names, conv_ids, depths, parents, n_convs, n_children, n_leaves, saved_tokens, ends_of = out

    def close(node, start: int, below: list) -> tuple:
        """Emit the nodes that end on the way into `node`, deepest first; `below` holds what its children return."""
        end = start + len(node.path)
        n, low, tops, leaves, saved, row, is_first, is_last, waiting = 0, None, 0, 0, 0, node.value, False, False, []
        if row is not None:
            n, low, is_first, is_last = counts[row], lows[row], row == first, row == last
        for part in below:
            n, tops, leaves, saved = n + part[0], tops + part[2], leaves + part[3], saved + part[4]
            low = part[1] if low is None else min(low, part[1])
            row = part[5] if row is None else row
            is_first, is_last = is_first or part[6], is_last or part[7]
            waiting = waiting + part[8] if waiting else part[8]
        # The root has no path; its depth 0 is its own.
        for depth in range(end // WIDTH, -1 if node is tree.root else start // WIDTH, -1):
            earlier, later = is_first and depth <= before, is_last and depth <= after
            length = int.from_bytes(keys[row][depth * WIDTH - 4 : depth * WIDTH], "big") if depth else 0
            saved += (n - (not earlier)) * length
            leaves += not waiting and not later
            name = hashlib.sha256(keys[row][: depth * WIDTH]).digest()[:16] if earlier or later else None
            for i in waiting:
                parent_names[i] = name
                parents[i] = low if name is None else None
            here = node.value if depth * WIDTH == end else None
            values = (name, None, low, depth, None, n, tops, leaves, saved, None if here is None else ends[here])
            for column, value in zip(out, values):
                column.append(value)
            waiting, tops = [len(names) - 1], int(not earlier)
        return n, low, tops, leaves, saved, row, is_first, is_last, waiting

    # Children are closed before their parent; a stack, as paths may be longer than Python's calls go deep.
    stack = [(tree.root, 0, tree.root.children(), [])]
    while stack:
        node, start, rest, below = stack[-1]
        child = next(rest, None)
        if child is not None:
            stack.append((child, start + len(node.path), child.children(), []))
            continue
        stack.pop()
        done = close(node, start, below)
        if stack:
            stack[-1][3].append(done)
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    arrays = [pa.array(column, kind) for column, kind in zip(out, kinds)]
    labels = ["name", "parent_name", "conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"]
    return pa.table([pa.array([p] * len(names), pa.int32()), *arrays], ["p", *labels])


def trie(seqs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node.

    `seqs` has (conv_id, turns) with turns as by `turn_id`. A node is a sequence of first turns; conv_id is the
    smallest of the conversations that start with it, its members, and n_convs counts them. The root has depth 0
    and no parent. n_leaves counts nodes without children in its subtree, itself included. saved_tokens sums, over
    the subtree, (members - 1) times the code points of the node's last text. ends_sha256 hashes the ascending
    comma-joined ids of the members that end here.

    A conversation without turns is a member of the root alone. conv_id must be distinct and not null. An empty
    table has no node, not even a root.
    """
    key = F.unhex(F.array_join(F.transform("turns", F.hex), ""))
    keyed = seqs.select("conv_id", key.alias("key")).withColumn("key_name", F.unhex(F.substring(F.sha2("key", 256), 1, 32)))
    keyed = written(keyed, "conversation-keys")
    keys = keyed.groupBy("key_name", "key").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("low"))
    keys = written(keys.join(_ends(keyed), "key_name").drop("key_name"), "distinct-conversations")
    spark = keys.sparkSession
    turns = keys.agg(F.coalesce(F.sum(F.length("key")), F.lit(0))).first()[0] // WIDTH
    few = min(turns // LEAST_TURNS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(1, turns // TASK_TURNS, few)
    ranged = keys.repartitionByRange(tasks, "key").withColumn("p", F.spark_partition_id())
    ranged = written(ranged, "ranged-conversations")

    by_task = Window.orderBy("p")
    borders = ranged.groupBy("p").agg(F.min("key").alias("low"), F.max("key").alias("high")).select(
        "p", "low", "high", F.lag("high").over(by_task).alias("before"), F.lead("low").over(by_task).alias("after")
    )
    borders = borders.mapInArrow(_common, "p int, before int, after int")
    parts = ranged.join(F.broadcast(borders), "p").groupBy("p").applyInArrow(_tree_nodes, _PARTS)
    parts = written(parts, "trie-parts")

    opened = parts.filter("name is not null")
    merged = opened.groupBy("name", "parent_name", "depth").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in _COUNTS), F.max("ends_sha256").alias("ends_sha256")
    )
    merged = written(merged, "trie-shared-nodes")
    known = merged.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"]
    shared = merged.join(known, "parent_name", "left").select(columns)
    closed = parts.filter("name is null")
    inner = closed.filter("parent_name is null").select(columns)
    # Each task has its own row of a shared parent, so that its children are not dealt to one place.
    local = opened.select("p", F.col("name").alias("parent_name")).join(known, "parent_name")
    border = closed.filter("parent_name is not null").drop("parent_conv_id").join(local, ["p", "parent_name"]).select(columns)
    nodes = shared.unionByName(inner).unionByName(border)
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
