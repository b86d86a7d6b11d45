"""SimHash and covering masks against brute force."""

import itertools
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from wayfold.llm import simhash
from wayfold.llm.components import components


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids = list(prints)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(ids, 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return {i: find(i) for i in ids}


def test_masks_cover_every_pair_of_bits():
    found = simhash.masks()
    assert len(found) == 7
    for i, j in itertools.combinations(range(64), 2):
        assert any(not m >> i & 1 and not m >> j & 1 for m in found)


def test_query_equals_brute_force(spark, small):
    from wayfold.llm.queries import op4_simhash

    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs}
    expected = {i: (f"{p:016x}", c) for (i, p), c in zip(prints.items(), brute_components(prints).values())}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, small).collect()}
    assert got == expected


def test_chains_and_close_prints(spark):
    import random

    rng = random.Random(5)
    values = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(30):
        x = rng.getrandbits(64)
        values.add(x)
        for _ in range(rng.randrange(8)):
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    prints = {v: v for v in values}
    edges = simhash.links(spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long"))
    got = {r.node % 2**64: r.component % 2**64 for r in components(edges).collect()}
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    expected = {g for g in groups(brute_components(prints)) if len(g) > 1}
    assert groups(got) == expected


@pytest.mark.parametrize("rows", [[], [(None, None), (1, None), (2, ""), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "x y z " * 5000)]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x"))
    got = sorted(((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect()))
    assert got == ([(0, 1), (1, 1), (2, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)] if rows else [])
    assert sorted(r.doc_id or 0 for r in simhash.one_of_each(docs).collect()) == ([0, 1, 4, 6] if rows else [])
