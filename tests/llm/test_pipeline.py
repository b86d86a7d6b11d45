"""The pipeline against the brute-force versions of its stages."""

import hashlib

import corpus_pipeline
from tests.llm.test_decontamination import norm
from tests.llm.test_quality_rules import brute_kept
from tests.llm.test_simhash import brute_components, brute_fingerprint
from wayfold.llm.line_dedup import MIN_BYTES, THRESHOLD, within


def brute_lines(rows):
    blank = lambda x: not x.strip(" \t\n\x0b\x0c\r")
    first = {}
    for d, t in sorted(rows):
        for n, x in enumerate((t or "").split("\n")):
            if not blank(x):
                first.setdefault(x, (d, n))
    names = sorted(first, key=lambda x: len(x.encode()))
    early = dict(first)
    for i, x in enumerate(names):
        a = x.encode()
        for y in names[i + 1 :]:
            b = y.encode()
            if len(b) - len(a) > THRESHOLD:
                break
            if len(a) >= MIN_BYTES and within(a, b, THRESHOLD):
                early[x], early[y] = min(early[x], first[y]), min(early[y], first[x])
    return [(d, "\n".join(x for n, x in enumerate((t or "").split("\n")) if blank(x) or early[x] >= (d, n))) for d, t in rows]


def test_pipeline_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    kept = brute_kept(docs)
    rows = brute_lines([(r.doc_id, r.text) for r in docs if kept[r.doc_id]])
    group = brute_components({d: brute_fingerprint(t) for d, t in sorted(rows)})
    rows = [(d, t) for d, t in rows if group[d] == d]
    items = [norm(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    whole = {d for d, t in rows if any(x in norm(t) for x in items)}
    part = {d for d, t in rows if any(x[i : i + 60] in norm(t) for x in items for i in range(0, len(x) - 59, 20))}
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, small).collect()}
    sha = {d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows}
    assert {d for d in sha if d not in part} <= set(got) <= {d for d in sha if d not in whole}
    assert all(sha[d] == got[d] for d in got)


def test_stages_keep_the_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert sorted(stage(spark, docs, small).columns) == sorted(docs.columns)
        assert stage(spark, docs.limit(0), small).count() == 0
