"""A training corpus from the documents table: filter, remove copies and leaks, encode."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import byte_bpe, decontamination, line_dedup, quality_rules, simhash
from wayfold.llm.tables import read, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    given = docs.withColumn("given_lang", F.col("lang")).withColumn("given_text", F.col("text"))
    judged = quality_rules.judge(given, keep=("given_text", "given_lang", "source", "n_chars"))
    # Exploding an array that is null for rejected rows decides them above the rules; Spark would copy a filter's
    # condition, all rules with it, below them.
    kept = judged.select("*", F.explode(F.when(F.col("kept"), F.array(F.lit(True)))).alias("stays"))
    return kept.select("doc_id", F.col("given_text").alias("text"), F.col("given_lang").alias("lang"), "source", "n_chars")


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated and nearly repeated lines go; a document stays even if none of its lines does."""
    cut = line_dedup.deduplicate(docs, keep=("lang", "source"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of SimHash fingerprints linked at 2 bits or fewer, by 3-word shingles, the smallest doc_id stays."""
    return simhash.one_of_each(docs).select(COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.without_leaks(docs.select(COLUMNS), read(spark, folder, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, and proof that they decode to its text."""
    vocabulary = byte_bpe.Vocabulary.read(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return byte_bpe.round_trip(docs, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("byte-level bpe", encode),
]

# The stages can't all be told in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = read(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, folder)
