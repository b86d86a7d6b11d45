"""Line removal against brute-force edit distances."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfold.llm import line_dedup as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(rows, threshold, min_bytes):
    blank = lambda x: not x.strip(" \t\n\x0b\x0c\r")
    lines = [(d, n, x) for d, t in rows if d is not None and t for n, x in enumerate(t.split("\n")) if not blank(x)]
    first = {}
    for d, n, x in lines:
        first[x] = min((d, n), first.get(x, (d, n)))
    data = {x: x.encode() for x in first}
    links = {x: [] for x in first}
    names = sorted(first, key=lambda x: len(data[x]))
    for i, x in enumerate(names):
        for y in names[i + 1 :]:
            if len(data[y]) - len(data[x]) > threshold:
                break
            if len(data[x]) >= min_bytes and distance(data[x], data[y]) <= threshold:
                links[x].append(y)
                links[y].append(x)
    out = []
    for d, t in rows:
        parts = (t or "").split("\n")
        real = [x for x in parts if not blank(x)]
        if d is None:
            out.append((-1, len(real), 0, 0, t or ""))
            continue
        early = lambda x: min([first[x], *(first[y] for y in links[x])])
        gone = {n for n, x in enumerate(parts) if not blank(x) and early(x) < (d, n)}
        kept = "\n".join(x for n, x in enumerate(parts) if n not in gone)
        out.append((d, len(real), len(gone), sum(len(links[x]) for x in real), kept))
    return sorted(out)


def plain(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_random_lines(spark, threshold):
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randrange(3, 26))) for _ in range(25)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.randrange(threshold + 2)):
            at = rng.randrange(len(x) + 1)
            x[at : at + rng.randrange(2)] = rng.choice(["", "q", "é"])
        return "".join(x)

    rows = [(i, "\n".join(line() for _ in range(rng.randrange(7)))) for i in range(50)]
    rows += [(None, rows[1][1]), (3, rows[3][1]), (60, None), (61, ""), (62, "\n \n\t\n"), (63, "\n" + base[0] + "\n\n" + base[0] + "\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit("clash"))
    assert plain(L.deduplicate(docs, threshold, 8)) == brute(rows, threshold, 8)


def test_within_equals_distance():
    rng = random.Random(0)
    for _ in range(3000):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12)))
        b = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12)))
        for k in (1, 2, 3):
            assert L.within(a, b, k) == (distance(a, b) <= k)


def test_query_equals_brute_force(spark, small):
    from wayfold.llm.queries import op5_line_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()][:]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = op5_line_dedup(spark, small).select("doc_id", "n_lines", "n_removed", "n_links", "kept_sha256")
    mine = {r.doc_id: tuple(r) for r in got.collect()}
    exact = brute_exact(rows)
    assert {d: (r[2] >= n, r[1]) for (d, r), n in zip(sorted(mine.items()), (exact[d][0] for d in sorted(exact)))} == {d: (True, exact[d][1]) for d in exact}
    assert all(mine[d][4] == sha(t or "") for d, t in rows if mine[d][2] == 0)


def brute_exact(rows):
    seen, out = set(), {}
    for d, t in sorted(rows):
        real = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        gone = 0
        for x in real:
            gone += x in seen
            seen.add(x)
        out[d] = (gone, len(real))
    return out


def test_empty_table_and_long_line(spark):
    assert L.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = "word " * 40_000
    rows = [(1, long), (2, long[:-1] + "x"), (3, "x" + long[3:])]
    got = L.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (2, 1), (3, 0)]


def test_segments_cover_the_line():
    sizes = np.arange(4, 60)
    for k in (1, 2, 3):
        at = np.zeros_like(sizes)
        for start, length in L.segments(sizes, k):
            assert (start == at).all() and (length > 0).all()
            at = at + length
        assert (at == sizes).all()


def test_lines_are_those_of_split():
    texts = ["a\n\nb\n", None, "", "\n", "c", "\nd e\n \nf"]
    lines = L.Lines(pa.array(texts))
    got = list(zip(lines.row.tolist(), lines.number.tolist(), [lines.data[s:e] for s, e in zip(lines.starts, lines.ends)]))
    assert got == [(i, n, x.encode()) for i, t in enumerate(texts) for n, x in enumerate((t or "").split("\n")) if x.strip()]


def _signatures(lines):
    found = L.Lines(pa.array(["\n".join(lines)]))
    return found.parities(), found.pair_parities()


def test_parities_lose_no_link():
    rng = random.Random(12)
    lines = ["".join(rng.choice("abcdeé ß日 ") for _ in range(rng.randrange(1, 40))) + "x" for _ in range(300)]
    for edits in (1, 2, 3):
        edited = []
        for line in lines:
            data = list(line)
            for _ in range(edits):
                at = rng.randrange(len(data))
                data[at : at + rng.randrange(2)] = rng.choice(["", "a", "q", "é"])
            edited.append("".join(data))
        both = [(a, b) for a, b in zip(lines, edited) if b.strip(" ")]
        (p, q), (u, v) = _signatures([a for a, _ in both]), _signatures([b for _, b in both])
        for i, (a, b) in enumerate(both):
            d = distance(a.encode(), b.encode())
            assert int(p[i] ^ u[i]).bit_count() <= 2 * d and int(q[i] ^ v[i]).bit_count() <= 4 * d
    assert len(L.Lines(pa.array(["", None, "\n"])).pair_parities()) == 0


def test_lines_of_the_same_bytes_are_seldom_candidates():
    rng = random.Random(13)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(7)) for _ in range(30)]
    lines = []
    for _ in range(80):
        own = list(words)
        # The same bytes in another order: their counts tell nothing.
        for i in rng.sample(range(10, 20), 3):
            own[i] = "".join(rng.sample(own[i], len(own[i])))
        lines.append(" ".join(own))
    lines = sorted(set(lines))
    parity, pairs = _signatures(lines)
    met = [(i, j) for i in range(len(lines)) for j in range(i)]
    assert all(parity[i] == parity[j] for i, j in met)
    assert sum(int(pairs[i] ^ pairs[j]).bit_count() <= 4 * L.THRESHOLD for i, j in met) < len(met) / 4


def test_remembered_lines_equal_a_set(monkeypatch):
    """A line goes out once while it is remembered, which holds for REMEMBERED other lines at least."""
    monkeypatch.setattr(L, "REMEMBERED", 400)
    rng, known, order = random.Random(8), L.Seen(), []
    for _ in range(200):
        names = np.unique(np.array([rng.randrange(-900, 900) for _ in range(rng.randrange(1, 60))], np.int64))
        fresh = known.new(names)
        ever, late = set(order), set(order[-400:])
        assert all(x not in late for x in names[fresh].tolist())
        assert all(x in ever for x in names[~fresh].tolist())
        order += names[fresh].tolist()
