"""Label estimation and scorer on made-up votes and on the small tables' held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.llm import quality_classifier as Q


def test_estimation_finds_the_labellers_accuracy():
    rng = np.random.default_rng(2)
    truth = rng.choice(3, 40_000, p=[0.85, 0.1, 0.05])
    right = Q._FIRST[:, :, 1].copy()
    right[1, 1], right[2, 1] = 0.9, 0.3
    votes = np.where(rng.random((len(truth), len(right))) < right[:, truth].T, Q.BAD, Q.CLEAN)
    votes[:, -1] = np.where(rng.random(len(truth)) < 0.3, votes[:, -1], Q.ABSTAIN)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, table = Q.estimate(patterns, counts.astype(float))
    assert abs(prior - [0.85, 0.1, 0.05]).max() < 0.02
    assert abs(table[1, 1, Q.BAD] - 0.9) < 0.05 and abs(table[2, 1, Q.BAD] - 0.3) < 0.05


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    hidden = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 0
    got = Q.classify(docs, labels.filter(~hidden)).join(labels.filter(hidden), "doc_id")
    rates = {(r.quality, r.toxic): r.kept for r in got.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1, 0] > 0.97 and rates[0, 0] < 0.1 and rates[1, 1] < 0.6


@pytest.mark.parametrize("rows", [[], [(None, None), (1, ""), (2, "a b"), (2, "a b"), (3, "You idiot! " * 40_000), (4, None)]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("votes", F.lit("clash"))
    for labels in ([], [(1, 1, 0), (1, 0, 0), (None, 1, 1), (3, None, None), (4, None, 1)]):
        got = Q.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert sorted(r.doc_id or 0 for r in got) == sorted(d or 0 for d, _ in rows)
        assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 2}) <= 1
