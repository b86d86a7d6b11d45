"""The n-gram join against all pairs, and the T-occurrence search against counting."""

import random
import re

import numpy as np
import pytest

from wayfold.llm import ngram_join, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, name string, key long, n string"


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted(range(len(docs)), key=lambda i: len(sets[i]))
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if not sets[i] or 10 * len(sets[i]) < 9 * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    rows = [(d, len(s), low.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]
    return sorted(rows, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def table(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1, "y") for d, t in docs], SCHEMA)


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = found(queries.op13_ngram_join(spark, folder))
    assert got == brute(docs)
    assert sum(d != c for d, _, c in got) > 5


@pytest.mark.parametrize("rounds,block", [(3, 1 << 18), (0, 1 << 18), (1, 300)])
def test_edits_around_the_limit(spark, monkeypatch, rounds, block):
    """Chains of near copies, a common passage in all texts of a family, sizes from one word on."""
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    rnd = random.Random(rounds)
    word = lambda: f"w{rnd.randrange(3000)}"
    common = [word() for _ in range(120)]
    docs = []
    for family in range(25):
        base = [word() for _ in range(rnd.choice([1, 2, 9, 11, 12, 30, 60, 130]))]
        if family % 4 == 0:
            base = common + base[: rnd.randrange(1, 12)]
        for _ in range(rnd.choice([1, 2, 8])):
            docs.append(" ".join(base))
            if len(base) > 3:
                for _ in range(rnd.randrange(1, 3)):
                    base[rnd.randrange(len(base))] = word()
    docs += [docs[0]] * 5 + ["", None, " \t\n", "One Two", "one  two", "İÄ", "İä"]
    rows = list(enumerate(docs)) + [(3, docs[3]), (None, docs[4]), (None, "alone in the world"), (None, None)]
    rnd.shuffle(rows)
    assert found(ngram_join.join(table(spark, rows).repartition(5))) == brute(rows)


def test_a_large_group_of_near_copies(spark):
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for i in range(300):
        own = list(base)
        own[rnd.randrange(150)] = f"x{i}"
        docs.append((i, " ".join(own)))
    assert found(ngram_join.join(table(spark, docs))) == brute(docs)


def test_no_join_makes_all_pairs_of_a_key(spark, monkeypatch):
    """Near copies too far apart to link: each set meets one query for a key; only tasks compare all pairs."""
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for i in range(120):
        own = list(base)
        for _ in range(5):
            own[rnd.randrange(150)] = f"x{rnd.randrange(10**6)}"
        docs.append((i, " ".join(own)))
    made, routed = [], ngram_join._routed

    def spied(lists, queries):
        made.append((lists.join(queries.select("key"), "key").count(), lists.count()))
        return routed(lists, queries)

    monkeypatch.setattr(ngram_join, "_routed", spied)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7, raising=False)
    assert found(ngram_join.join(table(spark, docs))) == brute(docs)
    assert made and made[0][1] > 120 and all(rows <= members for rows, members in made)


def test_similar_sets_share_a_key():
    rnd = np.random.default_rng(8)
    up, down = ngram_join.SIMILAR
    pairs = 0
    for n in [*range(1, 60), 77, 78, 96, 97, 120, 121, 300, 1000]:
        for _ in range(20):
            more = int(rnd.integers(0, n // up + 1))
            gone = int(rnd.integers(0, n // up + 1))
            every = rnd.integers(-(2**63), 2**63, n + more, np.int64)
            a, b = np.sort(every[:n]), np.sort(every[gone:])
            if a.tolist() != b.tolist() and n - gone >= ngram_join.needed(len(a), len(b)):
                rare = lambda s: s & 3
                assert len(np.intersect1d(ngram_join.part_keys(a, rare(a)), ngram_join.part_keys(b, rare(b))))
                pairs += 1
    assert pairs > 300


def test_long_text_and_empty_table(spark):
    words = [f"w{i}" for i in range(300_000)]
    rows = [(2, " ".join(words)), (1, " ".join(words[:-5000])), (3, " ".join(words[:200_000]))]
    got = found(ngram_join.join(table(spark, rows)))
    assert got == [(1, 294_998, 1), (2, 299_998, 1), (3, 199_998, 3)]
    assert ngram_join.join(table(spark, []).limit(0)).collect() == []


def test_search_equals_counting():
    rnd = random.Random(11)
    for _ in range(300):
        universe = rnd.choice([20, 60, 400])
        pick = lambda: np.array(sorted(rnd.sample(range(universe), rnd.randrange(1, 20))), np.int64)
        query, sets = pick(), [pick() for _ in range(rnd.randrange(0, 40))]
        need = np.array([rnd.randrange(1, 15) for _ in sets], np.int64)
        want = [i for i, s in enumerate(sets) if len(np.intersect1d(query, s)) >= need[i]]
        assert sorted(ngram_join.t_occurrence(query, sets, need).tolist()) == want
