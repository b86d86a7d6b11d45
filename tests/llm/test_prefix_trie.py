"""The prefix trie against a dictionary of all prefixes, and the radix tree against a dictionary of keys."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wayfold.llm import prefix_trie, queries
from wayfold.llm.radix_tree import RadixTree

SCHEMA = "conv_id long, turn long, role string, text string, id string, turns string"


def brute(rows, rebuild=True):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by_conv.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(whole.items()):
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n in members
    )



def key(row):
    return tuple(-1 if x is None else x for x in row)


def same(got, expected):
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_query_equals_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    same(found(queries.op11_prefix_trie(spark, small)), brute(rows))


def found(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return [tuple(r[n] for n in names) for r in df.collect()]


@pytest.mark.parametrize("least_turns", [1, 7, 5000])
@pytest.mark.parametrize("rebuild", [True, False])
def test_any_division_into_tasks_gives_the_same_trie(spark, monkeypatch, least_turns, rebuild):
    """Few words, so that starts are shared at every depth and many tasks share a node."""
    monkeypatch.setattr(prefix_trie, "LEAST_TURNS", least_turns)
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 5)
    rnd = random.Random(least_turns)
    rows = []
    for conv in [*rnd.sample(range(1000), 150), -5, -250, 10**15]:
        if conv % 3 == 0:
            turns = [("user", "same"), ("assistant", "änd\U0001f600")]
        else:
            turns = [(rnd.choice(["u", None]), rnd.choice(["", "a", "bb", None])) for _ in range(rnd.choice([1, 1, 2, 5, 30]))]
        rows += [(conv, i if i else None, *t) for i, t in enumerate(turns)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    seqs = prefix_trie.sequences(df)
    same(found(prefix_trie.trie(prefix_trie.rebuilt(seqs) if rebuild else seqs)), brute(rows, rebuild))


def test_odd_rows(spark):
    """Null ids are no conversation; repeated rows are turns of their own; one very long conversation and text."""
    rows = [(None, 1, "u", "x"), (7, None, None, None), (7, 1, "u", "x"), (7, 1, "u", "x"), (8, 5, "u", "y" * 3_000_000)]
    rows += [(9, i, "u", str(i % 3)) for i in range(150)] + [(11, i, "u", str(i % 3)) for i in range(151)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    same(found(prefix_trie.trie(prefix_trie.sequences(df))), brute(rows, rebuild=False))
    assert prefix_trie.trie(prefix_trie.sequences(df.limit(0))).collect() == []


def test_a_long_conversation_is_a_long_path(spark):
    df = spark.range(20_000).selectExpr("1L as conv_id", "id as turn", "'u' as role", "cast(id as string) as text")
    nodes = prefix_trie.trie(prefix_trie.sequences(df))
    got = nodes.selectExpr("count(*)", "max(depth)", "sum(n_children)", "sum(n_leaves)", "sum(saved_tokens)").first()
    assert tuple(got) == (20_001, 20_000, 20_000, 20_001, 0)


def test_radix_tree_holds_all_keys_in_order():
    rnd = random.Random(5)
    keys = {bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 2, 5]))) for _ in range(3000)}
    keys |= {b"\x01" * n for n in range(50)} | {b"\x02\x02" + bytes([n]) for n in range(40)}
    tree, rooms = RadixTree(), set()
    for k in rnd.sample(sorted(keys), len(keys)):
        tree.insert(k, k)
    seen = []

    def walk(node, start):
        rooms.add(node.room)
        if node.value is not None:
            assert node.value == start + node.path
            seen.append(node.value)
        for child in node.children():
            assert child.path and node.find(child.path[0]) is child
            walk(child, start + node.path)

    walk(tree.root, b"")
    assert seen == sorted(keys) and rooms == {4, 16, 48, 256}
