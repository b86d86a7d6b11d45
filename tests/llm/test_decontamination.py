"""Benchmark passages against brute-force alignment of every passage with every text."""

import random

import pytest
from pyspark.sql import functions as F

from wayfold.llm import decontamination as D


def norm(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    out = bytearray()
    for b in low:
        b = 32 if b in b" \t\n\x0b\x0c\r" else b
        if b == 32 and out[-1:] == b" ":
            continue
        out.append(b)
    return bytes(out)


def best(pattern, text):
    """Least edits of the pattern against any part of the text."""
    row = list(range(len(pattern) + 1))
    low = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
        low = min(low, row[-1])
    return low


def stands_alone(p, t):
    """Whether p stands in t and neither begins nor ends inside a word."""
    in_word = lambda b: b >= 128 or chr(b).isalnum()
    at = t.find(p)
    while at >= 0:
        end = at + len(p)
        cut = at > 0 and in_word(t[at - 1]) and in_word(t[at])
        if not cut and not (end < len(t) and in_word(t[end - 1]) and in_word(t[end])):
            return True
        at = t.find(p, at + 1)
    return False


def brute(docs, items, s):
    out = set()
    for d, text in docs:
        t = norm(text)
        for i, item in items:
            p = norm(item)
            if len(p) < s.min_passage:
                p = p.strip(b" ")
                if len(p) >= s.q and stands_alone(p, t):
                    out.add((d, i, 1, 0))
                continue
            last = max(len(p) - s.passage, 0)
            parts = [p[a : a + s.passage] for a in sorted({*range(0, last, s.stride), last})]
            hits = [e for x in parts if (e := best(x, t)) <= s.budget(len(x))]
            if hits:
                out.add((d, i, len(hits), min(hits)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_edits(spark, seed):
    rng = random.Random(seed)
    s = D.Settings(passage=30, stride=10, q=4, edit_share=0.1, min_passage=12, block_bytes=200)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(2, 14)))) for i in range(12)]
    docs = []
    for d in range(40):
        x = list(rng.choice(items)[1])
        for _ in range(rng.randrange(7)):
            at = rng.randrange(len(x) or 1)
            x[at : at + rng.randrange(2)] = rng.choice(["", "x", "\n", "Q", "zz"])
        docs.append((d, " ".join(word() for _ in range(rng.randrange(9))) + " \t" + "".join(x)[rng.randrange(8) :] + " " + word()))
    docs += [(100, None), (101, ""), (102, items[0][1]), (103, (items[1][1] + " ") * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    got = {tuple(r) for r in D.leaks(df, spark.createDataFrame(items + [(99, None)], "item_id long, text string"), s).collect()}
    expected = brute(docs, items, s)
    assert got == expected and len(expected) > 5
    clean = D.without_leaks(df, spark.createDataFrame(items, "item_id long, text string"), s)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, *_ in expected}
    assert clean.columns == df.columns


def test_query_on_small_tables(spark, small):
    from wayfold.llm.queries import op3_decontamination

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = {tuple(r) for r in op3_decontamination(spark, small).collect()}
    exact = {(d, i) for d, t in docs for i, x in items if norm(x) in norm(t)}
    assert exact and exact <= {(d, i) for d, i, *_ in got}
    assert got == brute([(d, t) for d, t in docs if d in {g[0] for g in got} or d < 3], [x for x in items if x[0] in {g[1] for g in got} or x[0] < 2], D.Settings())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "x " * 60)], "item_id long, text string")
    assert D.leaks(none, items).count() == 0
    docs = spark.createDataFrame([(1, "x " * 60), (None, "X  " * 3000), (None, "X  " * 3000)], "doc_id long, text string")
    assert D.leaks(docs, items.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in D.leaks(docs, items).collect()) == ["1", "None", "None"]


def test_short_items(spark):
    items = [
        (1, "What is the capital of France? Paris."), (2, "what is  the CAPITAL of France? Paris."), (3, "twelve bytes"),
        (4, "eleven byte"), (5, "ab ab ab ab ab"), (6, "Größe des Maßes"), (7, "x " * 60), (None, " twelve\tbytes "),
    ]
    docs = [
        (1, "He asked: WHAT is the\ncapital of France?  Paris. Then he left."), (2, "What is the capital of France? Parish."),
        (3, "Twelve bytes"), (4, "twelve bytesize, untwelve bytes"), (5, "untwelve bytes but twelve bytes."), (6, "eleven byte"),
        (7, "cab ab ab ab ab ab"), (8, "cab ab ab ab abc"), (9, "die größe des maßes"), (10, "die Größe des Maßes."), (11, "What is the capital of France? Pariz."),
        (12, "x " * 80 + "twelve bytes"), (None, "twelve bytes"), (13, None), (14, "twelve" + " " * 50_000 + "bytes " + "word " * 50_000),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in D.leaks(frame, benchmark).collect()}
    # Item 7 alone is long enough for passages.
    wanted = {(d, i, 1, 0) for d, t in docs for i, x in items if i != 7 and len(norm(x).strip(b" ")) >= 12 and stands_alone(norm(x).strip(b" "), norm(t))}
    assert {g for g in got if g[1] != 7} == wanted and {g[0] for g in got if g[1] == 7} == {12}
    assert {d for d, *_ in wanted} == {1, 3, 5, 7, 9, 10, 12, 14, None}
    kept = [r.doc_id for r in D.without_leaks(frame, benchmark).collect()]
    assert sorted(kept) == [2, 4, 6, 8, 11, 13]


def test_a_copied_part_inside_a_long_item(spark):
    rng = random.Random(9)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(300))
    parts = [(k, "before " + item[k : k + 120] + " after") for k in range(300, 340)]
    found = D.leaks(spark.createDataFrame(parts, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.doc_id for r in found.collect()} == {k for k, _ in parts}
