"""Passage removal against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wayfold.llm import substring_dedup


def brute(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(i, first.get(k, i)) if i is not None else first.get(k, float("inf"))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                gone |= set(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, small):
    from wayfold.llm.queries import op2_substring_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    expected = [(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute(rows, 50)]
    got = op2_substring_dedup(spark, small).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == expected
    assert sum(g for _, _, g, _ in expected) > 0


@pytest.mark.parametrize("seed", range(3))
def test_random_passages(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcd") * rng.randrange(1, 3) for _ in range(rng.randrange(5, 40))] for _ in range(8)]
    rows = [(i, " ".join(w for _ in range(rng.randrange(6)) for w in rng.choice(passages))) for i in range(60)]
    rows += [(None, rows[3][1]), (5, rows[3][1]), (7, rows[7][1]), (61, None), (62, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    got = substring_dedup.deduplicate(docs, window=8, anchor=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 8)


def test_empty_table(spark):
    assert substring_dedup.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text_of_one_word(spark):
    rows = [(1, "x " * 40_000), (2, "x " * 40_000), (3, "x " * 49)]
    got = substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (2, 40_000), (3, 0)]
