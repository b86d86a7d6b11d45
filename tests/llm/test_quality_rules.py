"""Quality rules: base counts against brute force, distances against a plain model."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wayfold.llm import quality_rules
from wayfold.llm.quality_rules import Rules


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def divergence(p, q):
    part = lambda x, m: x * math.log2(x / m) if x else 0.0
    return sum(part(a, (a + b) / 2) + part(b, (a + b) / 2) for a, b in zip(p, q)) / 2


def brute_kept(rows, rules=Rules()):
    words = defaultdict(Counter)
    for r in rows:
        words[r.lang or ""].update(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))

    def classes(counter):
        out = [0, 0, 0]
        for w, n in counter.items():
            for c in w:
                out[0 if c.isupper() else 1 if c.isalpha() else 2] += n
        return [x / max(1, sum(out)) for x in out]

    kept = {}
    for r in rows:
        counter = words[r.lang or ""]
        total = sum(counter.values())
        own = Counter(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        n = sum(own.values())
        *_, failed = brute_counts(r.text)
        common = [w for w, k in counter.items() if k >= rules.common_share * total]
        shares = lambda c, t: (x := [c[w] / t for w in common]) + [1 - sum(x)]
        far = n >= rules.min_words and total >= rules.min_language_words and (
            math.sqrt(divergence(classes(own), classes(counter))) > rules.max_class_distance
            or math.sqrt(max(0, divergence(shares(own, n), shares(counter, total)))) > rules.max_word_distance
        )
        kept[r.doc_id] = not failed and not far
    return kept


def test_query_equals_brute_force(spark, small):
    from wayfold.llm.queries import op8_quality_rules

    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    kept = brute_kept(rows)
    expected = {r.doc_id: (*brute_counts(r.text), kept[r.doc_id]) for r in rows}
    got = {r[0]: tuple(r[1:]) for r in op8_quality_rules(spark, small).collect()}
    assert got == expected
    assert len(set(kept.values())) == 2


@pytest.mark.parametrize("rows", [[], [(None, None, None), (1, "", "en"), (1, "", "en"), (2, "a b c\n" * 3 + " \n" + "x", None), (3, "é # w w " * 30_000, "fr")]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n_words", F.lit("x"))
    got = quality_rules.judge(docs).collect()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    key = lambda x: str(x)
    assert sorted(((r.doc_id, *(r[c] for c in columns)) for r in got), key=key) == sorted(((i, *brute_counts(t)) for i, t, _ in rows), key=key)
    assert not any(r.kept for r in got)


def test_plan_is_native_and_filters_stay_cheap(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = quality_rules.judge(docs).filter("kept")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
