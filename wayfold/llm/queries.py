"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import (
    byte_bpe,
    decontamination,
    line_dedup,
    lm_scoring,
    ngram_join,
    oracles,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    token_counts,
    url_filters,
    whitening,
)
from wayfold.llm.tables import read
from wayfold.session import shared_folder


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.deduplicate(read(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.deduplicate(read(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_links", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def dated_list(captures: DataFrame) -> DataFrame:
    """List entries for the hosts and domains of the pages, dated by their hashes; the tables have no list."""
    number = lambda c: F.conv(F.substring(F.md5(F.col(c).cast("binary")), 1, 7), 16, 10).cast("long")
    hosts = captures.select(url_filters.host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
    domains = hosts.select(F.substring_index("host", ".", -2).alias("pattern")).distinct()
    patterns = (
        hosts.filter(number("host") % 2 == 0).select(F.col("host").alias("pattern")).union(domains).distinct()
        .select("pattern", number("pattern").alias("n"))
    )
    on = lambda days: F.date_add(F.lit("2024-01-01").cast("date"), days.cast("int"))
    n = F.col("n")
    block, allow, remove = (F.lit(k) for k in (url_filters.BLOCK, url_filters.ALLOW, url_filters.REMOVE))
    dated = F.array(
        F.struct(block.alias("kind"), on(n % 200).alias("listed_on")),
        F.struct(remove.alias("kind"), on(n % 200 + 30 + n % 41).alias("listed_on")),
        F.struct(F.when(n % 3 == 0, allow).otherwise(block).alias("kind"), on(n % 200 + 100 + n % 37).alias("listed_on")),
    )
    return patterns.select("pattern", F.inline(dated))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 360).cast("int"))
    captures = read(spark, folder, "pages").select("page_id", "url", fetched.alias("fetched_on"))
    return url_filters.as_of(captures, dated_list(captures))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents come in, every seventh goes again, every third of the rest gets a new tokenizer; then the
    second batch arrives once more."""
    docs = read(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    gone, revised = F.col("doc_id") % 7 == 0, (F.col("doc_id") % 7 != 0) & (F.col("doc_id") % 3 == 0)
    table = token_counts.Rollups(spark, shared_folder(spark, "token-counts"))
    table.commit("1-inserts", token_counts.inserts(docs, "words-1"))
    deleted = token_counts.deletes(docs.filter(gone), "words-1")
    table.commit("2-deletes", deleted)
    table.commit("3-revisions", token_counts.revisions(docs.filter(revised), "words-1", "runs-2"))
    table.commit("2-deletes", deleted)
    return table.totals()


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(read(spark, folder, "documents"), reread=True)


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.read(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    coded = byte_bpe.round_trip(read(spark, folder, "documents"), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(read(spark, folder, "conversations"))))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings"))


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_ngram_join": op13_ngram_join,
}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filters": oracles.OP6, "op7_token_counts": oracles.OP7, "op8_quality_rules": oracles.OP8}
