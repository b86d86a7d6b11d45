"""Weak supervision: expectation maximisation over heuristic labellers, and a hashed linear scorer.

Labellers vote clean, bad or not at all. How often each is right on clean and on bad documents is estimated
without truth from where their votes overlap; only the counts of vote patterns are needed, of which there are
at most 3 ** labellers. Their posterior labels train a logistic model of hashed words and word beginnings on a
bounded sample, which then scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import text as T
from wayfold.llm.tables import written

# Insults that mark a toxic text.
INSULTS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
MARKS = b"#*$%&|<>"

ABSTAIN, CLEAN, BAD = 0, 1, 2
#: The last labeller is a person, where there is a label.
LABELLERS = ("insults", "marks", "capitals", "repeated_words", "repeated_lines", "person")


@dataclass(frozen=True)
class Settings:
    #: Documents the scorer is fitted on: labelled ones first, then those with the least hashes of their doc_id.
    train_rows: int = 12_000
    buckets: int = 1 << 18
    rounds: int = 150
    penalty: float = 1e-5
    #: A document goes if the scorer or the votes are as sure as this that it is bad.
    max_score: float = 0.3
    max_posterior: float = 0.9


def _insult_hashes() -> np.ndarray:
    return np.sort(T.Texts(pa.array([" ".join(INSULTS)])).word_hashes())


class Features:
    """Votes and hashed features of a column of texts. Only those asked for are computed."""

    def __init__(self, column: pa.Array):
        self._raw = T._bytes(column)[0]
        self._t = t = T.Texts(column, lower=True)
        self._of = np.repeat(np.arange(len(t.counts)), t.counts)
        # A word without the marks around it, for the lexicon and as a feature.
        letter = (t.bytes >= 97) & (t.bytes <= 122) | (t.bytes >= 128)
        inside = np.append(0, np.cumsum(letter))
        starts, ends = t.starts, t.ends
        trail = (inside[ends] > inside[starts]) & ~letter[ends - 1] if len(ends) else np.zeros(0, bool)
        self._bare = t.hashes(starts, ends - trail)
        self.votes = self._votes(t, self._raw, self._of, t.word_hashes(), self._bare)

    def hashed(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket) of each feature, and how many each row has."""
        t, n = self._t, len(self._t.counts)
        begins = t.hashes(t.starts, np.minimum(t.starts + 4, t.ends))
        keys = [self._key(self._of, self._bare, buckets, 1), self._key(self._of, begins, buckets, 2)]
        for i in range(self.votes.shape[1]):
            code = np.full(n, 1000 + 3 * i, np.uint64) + self.votes[:, i].astype(np.uint64)
            keys.append(self._key(np.arange(n), code, buckets, 3))
        keys = np.unique(np.concatenate(keys))
        row, bucket = keys // buckets, keys % buckets
        return row, bucket, np.bincount(row, minlength=n)

    @staticmethod
    def _key(row: np.ndarray, hashes: np.ndarray, buckets: int, kind: int) -> np.ndarray:
        return row * buckets + (T.mix(hashes + np.uint64(kind)) % np.uint64(buckets)).astype(np.int64)

    @staticmethod
    def _votes(t: T.Texts, raw: np.ndarray, row: np.ndarray, words: np.ndarray, bare: np.ndarray) -> np.ndarray:
        n = np.maximum(t.counts, 1)
        per_text = lambda flags: np.diff(np.append(0, np.cumsum(flags))[t.offsets])
        size = np.maximum(np.diff(t.offsets), 1)
        insults = np.bincount(row, np.isin(bare, _insult_hashes()), len(n))
        marks = per_text(np.isin(raw, list(MARKS))) / n
        capitals = per_text((raw >= 65) & (raw <= 90)) / size
        grams = T.gram_hashes(words, 3).view(np.int64)
        whole = row[: len(grams)] == row[2:]
        runs = np.bincount(row[: len(grams)][whole], minlength=len(n))
        kinds = _distinct(row[: len(grams)][whole], grams[whole])
        fresh = np.bincount(kinds, minlength=len(n)) / np.maximum(runs, 1)
        lines, again = _line_counts(t, len(n))
        enough = t.counts >= 20
        judged = lambda bad, clean: np.where(bad, BAD, np.where(clean & enough, CLEAN, ABSTAIN))
        return np.stack(
            [
                judged(insults > 0, insults == 0),
                judged(marks > 0.2, marks < 0.02),
                judged((capitals > 0.25) & enough, capitals < 0.08),
                judged((fresh < 0.7) & enough, fresh > 0.85),
                judged((again / np.maximum(lines, 1) > 0.3) & (lines >= 4), again == 0),
            ],
            1,
        ).astype(np.int8)


def _distinct(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The row of each distinct pair of row and hash."""
    both = T.mix(hashes.view(np.uint64) ^ T.mix(row.astype(np.uint64)))
    return row[np.unique(both, return_index=True)[1]]


def _line_counts(t: T.Texts, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of each text, and how many of them equal an earlier one."""
    edges = np.unique(np.concatenate([t.offsets[:-1], np.flatnonzero(t.bytes == 10) + 1, t.offsets[-1:]]))
    starts, ends = edges[:-1], edges[1:]
    full = ends - starts > 1
    starts, ends = starts[full], ends[full]
    row = np.searchsorted(t.offsets, starts, side="right") - 1
    lines = np.bincount(row, minlength=rows)
    if not len(starts):
        return lines, np.zeros(rows)
    ends = ends - (t.bytes[ends - 1] == 10)
    kinds = _distinct(row, t.hashes(starts, ends).view(np.int64))
    return lines, lines - np.bincount(kinds, minlength=rows)


def _pattern(votes: np.ndarray) -> np.ndarray:
    return votes.astype(np.int64) @ 3 ** np.arange(votes.shape[1])


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "text"):
        votes = Features(batch.column("text")).votes
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_pattern(votes))], ["doc_id", "pattern"])


# What is assumed at first: share of clean and of bad votes of each labeller on clean, junk and toxic documents.
_FIRST = np.array(
    [
        [[0.99, 0.01], [0.95, 0.05], [0.4, 0.6]],
        *[[[0.95, 0.05], [0.5, 0.5], [0.95, 0.05]]] * (len(LABELLERS) - 2),
        [[0.98, 0.02], [0.05, 0.95], [0.05, 0.95]],
    ]
)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Shares of clean, junk and toxic documents, and table[labeller, truth, vote], from votes and counts.

    Junk and toxic documents are told apart, since the labellers of the one know nothing of the other. The
    person's first shares weigh as much as there are labelled documents. Abstaining says nothing.
    """
    n = patterns.shape[1]
    table = np.ones((n, 3, 3))
    table[:, :, 1:] = _FIRST
    prior = np.array([0.85, 0.1, 0.05])
    labelled = counts[patterns[:, -1] > 0].sum() + 1.0
    for _ in range(rounds):
        weight = counts[:, None] * truths(patterns, prior, table)
        prior = np.maximum(weight.sum(0) / max(counts.sum(), 1), 0.005)
        prior /= prior.sum()
        for vote in (CLEAN, BAD):
            table[:, :, vote] = (patterns == vote).T @ weight + 1.0
        table[-1, :, 1:] += labelled * _FIRST[-1]
        table[:, :, 1:] /= table[:, :, 1:].sum(2, keepdims=True)
    return prior, table


def truths(patterns: np.ndarray, prior: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probabilities of clean, junk and toxic for each row of votes."""
    labeller = np.arange(patterns.shape[1])
    logs = np.log(table)
    sums = np.stack([logs[labeller, truth, patterns].sum(1) for truth in range(3)], 1) + np.log(prior)
    odds = np.exp(sums - sums.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def posterior(patterns: np.ndarray, prior: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability that a document with these votes is junk or toxic."""
    return 1 - truths(patterns, prior, table)[:, 0]


def _sampled(ids: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, "text"):
            doc_id = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(np.isin(doc_id, ids)))
            _, bucket, sizes = Features(batch.column("text")).hashed(buckets)
            ends = np.append(0, np.cumsum(sizes))
            features = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), features], ["doc_id", "features"])

    return run


def fit(buckets: np.ndarray, sizes: np.ndarray, target: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights of a logistic model of feature presence, with adaptive steps; the last is the constant."""
    weights, seen = np.zeros(settings.buckets + 1), np.full(settings.buckets + 1, 1e-8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    value = 1 / np.sqrt(np.maximum(sizes, 1))
    for _ in range(settings.rounds if len(sizes) else 0):
        z = np.add.reduceat(weights[buckets], starts) * value + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(sizes)
        slope = np.bincount(buckets, (error * value)[row], settings.buckets + 1)
        slope[-1] = error.sum()
        slope[:-1] += settings.penalty * weights[:-1] / len(sizes)
        seen += slope**2
        weights -= 1.0 * slope / np.sqrt(seen)
    return weights.astype(np.float32)


def _scored(weights: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, "text"):
            f = Features(batch.column("text"))
            row, bucket, sizes = f.hashed(buckets)
            z = np.bincount(row, weights[bucket], len(sizes)) / np.sqrt(np.maximum(sizes, 1)) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_pattern(f.votes)), pa.array(score)], ["doc_id", "votes", "score"]
            )

    return run


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, votes, posterior, score, kept) for each row of `docs` (doc_id, text).

    votes is the pattern of all labellers in base 3, posterior the probability of a bad document from them,
    score the scorer's, from the text alone. kept is false if either reaches its limit. `labels` (doc_id, quality, toxic) gives
    the person's votes: bad if toxic or of no quality; a null in both is no vote, and of several rows for a
    document the worst counts. Null and empty texts get no heuristic vote. Rows without doc_id are scored but
    not trained on; repeated rows are scored alike. Other columns are ignored; an empty table gives an empty
    result, and without any vote every document has the same score.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    person = (
        labels.filter("doc_id is not null and (quality is not null or toxic is not null)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.when(bad, BAD).otherwise(CLEAN)).alias("person"))
    )
    voted = rows.mapInArrow(_vote_rows, "doc_id long, pattern long")
    voted = written(
        voted.join(person, "doc_id", "left").select("doc_id", "pattern", F.coalesce("person", F.lit(ABSTAIN)).alias("person")),
        "votes",
    )
    unpack = lambda t: np.stack(
        [*(t["pattern"].to_numpy() // 3**i % 3 for i in range(len(LABELLERS) - 1)), t["person"].to_numpy()], 1
    ).astype(np.int64)
    counted = voted.groupBy("pattern", "person").count().toArrow()
    prior, table = estimate(unpack(counted), counted["count"].to_numpy().astype(float))

    chosen = (
        voted.filter("doc_id is not null").groupBy("doc_id").agg(F.max("pattern").alias("pattern"), F.max("person").alias("person"))
        .orderBy(F.col("person") == ABSTAIN, F.xxhash64("doc_id"), "doc_id").limit(settings.train_rows).toArrow()
    )
    ids = chosen["doc_id"].to_numpy()
    target = posterior(unpack(chosen), prior, table)
    order = np.argsort(ids)
    ids, target = ids[order], target[order]
    sample = rows.mapInArrow(_sampled(ids, settings.buckets), "doc_id long, features array<int>").toArrow()
    features = sample["features"].combine_chunks()
    sizes = pa.compute.list_value_length(features).to_numpy(zero_copy_only=False)
    own = target[np.searchsorted(ids, sample["doc_id"].to_numpy())] if len(ids) else target
    weights = fit(features.flatten().to_numpy(zero_copy_only=False), sizes, own, settings)

    scored = rows.mapInArrow(_scored(weights, settings.buckets), "doc_id long, votes long, score double")
    every = np.arange(3 ** len(LABELLERS))
    by_votes = posterior(every[:, None] // 3 ** np.arange(len(LABELLERS)) % 3, prior, table)
    known = docs.sparkSession.createDataFrame(list(zip(every.tolist(), by_votes.tolist())), "votes long, posterior double")
    votes = F.col("votes") + F.coalesce("person", F.lit(ABSTAIN)) * 3 ** (len(LABELLERS) - 1)
    return (
        scored.join(person, "doc_id", "left").withColumn("votes", votes).join(known, "votes")
        .select("doc_id", "votes", "posterior", "score")
        .withColumn("kept", (F.col("score") < settings.max_score) & (F.col("posterior") < settings.max_posterior))
    )
