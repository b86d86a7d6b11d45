"""Base scores against brute force; the suffix tree by sums of its distributions and held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.llm import lm_scoring as L


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + [None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def brute(rows):
    counts = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    log = lambda t: math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1)))
    return sorted(
        ((-1 if i is None else i, held(i), len(tokens(x)), sum(t in counts for t in tokens(x)), n, round(sum(map(log, tokens(x))), 6)) for i, x in rows)
    )


def plain(df):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()
    )


def test_query_equals_brute_force(spark, small):
    from wayfold.llm.queries import op9_lm_scoring

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert plain(op9_lm_scoring(spark, small)) == brute(rows)


def test_rare_words_are_joined(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert plain(L.score(docs, L.Settings(frequent_share=0.002, symbol_share=0.01))) == brute(rows)


def test_contexts_help_where_words_depend_on_them(spark):
    rng = random.Random(1)
    follow = {w: rng.sample("abcdefgh", 2) for w in "abcdefgh"}

    def text():
        w, out = "a", []
        for _ in range(200):
            out.append(w)
            w = rng.choice(follow[w])
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(200)], "doc_id long, text string")
    sums = L.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] / sums[2] > -0.32 and sums[1] / sums[2] < -0.7


def test_distributions_sum_to_one(spark, small):
    settings = L.Settings(symbol_share=0.01, context_share=0.001)
    prepared = L._prepared(spark.read.parquet(f"{small}/documents.parquet"))
    base = L.base_model(L.word_counts(prepared), settings)
    tree = L.suffix_tree(prepared.mapInArrow(L._code(base), L.CODED), base, settings)
    assert len(tree.one.contexts)
    every = np.arange(tree.width)
    for c in [*tree.one.contexts, *range(3)]:
        for b in range(3):
            run = np.stack([np.full(tree.width, b), np.full(tree.width, c), every], 1).ravel()
            gain = tree.gain(run, np.tile([0, 1, 2], tree.width))[2::3]
            assert abs((tree.root * 10**gain).sum() - 1) < 1e-9


@pytest.mark.parametrize("rows", [[], [(8, "held out only")] if held(8) else [], [(None, None), (1, None), (1, None), (2, ""), (3, "A a ä " * 30_000), (4, "x")]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    assert plain(L.score(docs)) == brute(rows)


def brute_score(rows, depth=3):
    """Scores in contexts of words alone, for texts all of whose words are contexts."""
    train = [tokens(x) for i, x in rows if not held(i)]
    counts = Counter(t for x in train for t in x)
    n, v = sum(counts.values()), len(counts)
    arcs = {}
    for x in train:
        for k in range(1, depth + 1):
            for i in range(k, len(x)):
                arcs.setdefault(tuple(x[i - k : i]), Counter())[x[i]] += 1

    def p(context, word):
        if not context:
            return (counts[word] + 0.1) / (n + 0.1 * (v + 1))
        own, below = arcs.get(context, Counter()), p(context[1:], word)
        total, kinds = sum(own.values()), len(own)
        if total < 2 or sum(c * math.log(c / total / p(context[1:], w)) for w, c in own.items()) <= kinds:
            return below
        return (own[word] + kinds * below) / (total + kinds)

    texts = [(i, tokens(x)) for i, x in rows]
    return {i: sum(math.log10(p(tuple(x[max(0, j - depth) : j]), x[j])) for j in range(len(x))) for i, x in texts}


@pytest.mark.parametrize("hot_share", [2.0**-12, 0.01])
def test_scores_equal_brute_force(spark, hot_share):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(words[: rng.choice([3, 30])]) for _ in range(rng.randrange(1, 40)))) for i in range(80)]
    got = L.score(spark.createDataFrame(rows, "doc_id long, text string"), L.Settings(hot_share=hot_share)).collect()
    expected = brute_score(rows)
    assert len(got) == len(rows) and all(abs(r.score - expected[r.doc_id]) < 1e-6 for r in got)


def test_rare_phrases_are_contexts_at_any_size(spark):
    """Words far below every share still tell what follows them."""
    rng = random.Random(4)
    filler = [f"f{i}" for i in range(400)]
    phrase = "zeta eta theta iota"
    text = lambda i: " ".join(rng.choices(filler, k=300)) + (f" {phrase}" if i % 100 == 8 else "")
    unseen = next(i for i in range(1000, 2000) if held(i))
    rows = [(i, text(i)) for i in range(400) if not held(i)] + [(unseen, phrase)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = L.Settings(symbol_share=0.001, context_share=0.001, transition_share=0.001)
    found = L.score(docs, settings).filter(f"doc_id = {unseen}").first()
    # Three of its four words, and the end, follow from the word before.
    assert found.score - found.base_score > 8


@pytest.mark.parametrize("settings", [L.Settings(task_tokens=40, hot_share=0.0), L.Settings(task_tokens=300, frequent_share=0.1), L.Settings(task_tokens=1)])
def test_contexts_of_more_tokens_than_a_task_takes(spark, settings, monkeypatch):
    """Hot contexts of one to three words, rare words, and texts of several batches."""
    monkeypatch.setattr(L, "COMMON_ARCS", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(words[: rng.choice([2, 5, 30])]) for _ in range(rng.randrange(1, 60)))) for i in range(120)]
    rows += [(i, "w0 w1 w0 w2 w1 w0") for i in range(200, 260)] + [(None, None), (300, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prepared = L._prepared(docs).filter("not held_out")
    counts = L.word_counts(prepared)
    hot = L.hot_contexts(prepared, counts, L.base_model(counts, settings), settings)
    assert len(hot.keys[0]) and (settings.task_tokens > 100 or len(hot.keys[2]) and len(hot.arcs))
    expected = {i: (a, b) for (i, a), b in zip(brute_score(rows).items(), [sum(1 for _ in tokens(x)) for _, x in rows])}
    got = L.score(docs, settings).collect()
    assert len(got) == len(rows) and all(abs(r.score - expected[r.doc_id][0]) < 1e-6 and r.n_tokens == expected[r.doc_id][1] for r in got)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_known, round(r.base_score, 6)) for r in got) == sorted((x[0], x[3], x[5]) for x in brute(rows))


def test_tokens_are_packed(spark):
    """What the shuffles to the tasks of contexts hold; a row for each token's context and arc took over 18 bytes a token."""
    rng = random.Random(6)
    words = [f"w{int(1.3**rng.uniform(0, 30))}" for _ in range(100_000)]
    docs = spark.createDataFrame([(i, " ".join(words[i * 500 : i * 500 + 500])) for i in range(200)], "doc_id long, text string")
    prepared, settings = L._prepared(docs), L.Settings(task_tokens=20_000)
    counts = L.word_counts(prepared.filter("not held_out"))
    base = L.base_model(counts, settings)
    hot = L.hot_contexts(prepared.filter("not held_out"), counts, base, settings)
    size = F.expr("aggregate(data, 0L, (sum, x) -> sum + length(x))")
    shared = spark.sparkContext.broadcast((base, hot, None))
    sizes = [prepared.mapInArrow(L._deal(shared, settings, 8, later), L.DEALT).agg(F.sum(size)).first()[0] for later in (False, True)]
    assert sum(sizes) < 12 * 100_200


def test_texts_in_another_order_are_refused(spark):
    rows = lambda dest: [(dest, False, [b""])]
    with pytest.raises(ValueError, match="read again"):
        L._scored(L._rows(rows(1)))
