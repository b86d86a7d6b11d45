"""Whitening against numpy on the whole table, and odd vectors."""

import math

import numpy as np
import pytest

from wayfold.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, whitened string"


def grid(vectors):
    return np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], np.int64)


def model(vectors, weights=None):
    """n, sums, eigenvalues and eigenvectors by falling eigenvalue, of distinct whole vectors."""
    x, counts = np.unique(grid(vectors), axis=0, return_counts=True)
    w = counts if weights == "count" else np.ones(len(x), np.int64)
    n, sums = int(w.sum()), (x * w[:, None]).sum(axis=0)
    centred = x - sums / n
    v = (centred * w[:, None]).T @ centred / n
    values, vectors = np.linalg.eigh(v)
    return n, sums, values[::-1], vectors[:, ::-1], np.trace(v)


def check(rows, kept, weights=None, components=16):
    n, sums, values, vectors, trace = model([v for _, v in kept], weights)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == len(kept) * min(components, (values > 1e-12 * values[0]).sum())
    signs = {}
    for vec_id, v in kept:
        x = grid([v])[0]
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        for j, r in by_id[vec_id].items():
            assert (r.n, r.deviation) == (n, deviation)
            want = float((x - sums / n) @ vectors[:, j - 1] / math.sqrt(values[j - 1]))
            sign = signs.setdefault(j, 1 if want * r.whitened >= 0 else -1) if abs(want) > 1e-6 else signs.get(j, 1)
            assert abs(r.whitened - sign * want) < 1e-6
            assert abs(r.explained / (values[j - 1] / trace) - 1) < 1e-9
            assert r.identity_error < 1e-8


@pytest.fixture(scope="module")
def vectors(spark, small):
    return [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]


def test_query_equals_numpy(spark, small, vectors):
    check(queries.op12_embedding_whitening(spark, small).collect(), vectors)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_repeated_vectors_and_odd_rows(spark, weights):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 5)).astype(np.float32).tolist()
    kept = list(enumerate(base + [base[0]] * 40 + [base[1]] * 3))
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [math.nan] * 5), (903, [math.inf] * 5), (904, []), (905, [1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in kept + odd], SCHEMA).repartition(5)
    check(whitening.whiten(df, weights=weights).collect(), kept, weights)


def test_few_vectors_give_few_components(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 2.0], ""), (1, [1.0, 1.0, 0.0], ""), (None, [1.0, 1.0, 0.0], "")], SCHEMA)
    rows = whitening.whiten(df).collect()
    assert sorted((r.vec_id is None, r.component) for r in rows) == [(False, 1), (False, 1), (True, 1)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == pytest.approx(1) and r.n == 2 for r in rows)
    assert whitening.whiten(df.filter("vec_id is null")).collect() == []


def test_empty_table(spark):
    empty = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_entries_past_all_limits(spark):
    """Very large entries count as the limit; sums stay exact, and a deviation past a long is null."""
    df = spark.createDataFrame([(1, [3e38, 1.0], ""), (2, [-3e38, 2.0], ""), (3, [0.0, 3.0], "")], SCHEMA)
    rows = whitening.whiten(df).collect()
    assert {r.vec_id: r.deviation for r in rows}[1] is None
    big = {r.vec_id: r.whitened for r in rows if r.component == 1}
    assert big[1] == pytest.approx(-big[2]) and abs(big[1]) == pytest.approx(math.sqrt(1.5))
