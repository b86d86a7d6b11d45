"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes is committed as one folder of sums, written beside the table and moved into place by one
rename, so it is there whole or not at all; a batch that was committed before is left as it is. Totals are
the sums over all committed batches, so the order of batches doesn't matter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens"]
DELTAS = "source string, lang string, tokenizer string, documents long, tokens long"

# The tokenizers by version. Words between white space; runs of ASCII letters and digits, and
# every other character that is no white space.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "runs-2": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]",
}


def n_tokens(text: Column, tokenizer: str) -> Column:
    """Number of tokens; a null text has none."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKENIZERS[tokenizer]), F.lit(0))).cast("long")


def inserts(docs: DataFrame, tokenizer: str, sign: int = 1) -> DataFrame:
    """Changes that add (or with sign -1 take away) each row of docs (source, lang, text)."""
    return docs.select(
        "source", "lang", F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("long").alias("documents"), (sign * n_tokens(F.col("text"), tokenizer)).alias("tokens"),
    )


def deletes(docs: DataFrame, tokenizer: str) -> DataFrame:
    return inserts(docs, tokenizer, -1)


def revisions(docs: DataFrame, old: str, new: str) -> DataFrame:
    """Changes that replace the counts of one tokenizer version by those of another."""
    return deletes(docs, old).union(inserts(docs, new))


def rollup(changes: DataFrame) -> DataFrame:
    """Sums by key. Null keys are keys of their own. Few keys: combined in every task before the shuffle."""
    return changes.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))


class Rollups:
    """Committed batches below one folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self._path).getFileSystem(spark._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        root = self._hadoop(self._path)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes under its name; False, and no change, if the name is there already.

        Several writers of one batch may run at once: only the first rename succeeds.
        """
        target = self._hadoop(f"{self._path}/batch={batch}")
        if self._fs.exists(target):
            return False
        draft = f"{self._path}/_draft-{uuid.uuid4().hex}"
        rollup(changes).write.parquet(draft)
        self._fs.mkdirs(target.getParent())
        renamed = self._fs.rename(self._hadoop(draft), target)
        # A rename onto a folder that appeared meanwhile moves into it; such a draft is no part of the batch.
        inner = self._hadoop(f"{self._path}/batch={batch}/{draft.rsplit('/', 1)[1]}")
        if self._fs.exists(inner):
            self._fs.delete(inner, True)
            return False
        if not renamed:
            self._fs.delete(self._hadoop(draft), True)
        return bool(renamed)

    def totals(self) -> DataFrame:
        """Sums over all committed batches; keys whose sums are all zero are gone."""
        paths = [f"{self._path}/batch={b}" for b in self.committed()]
        reader = self._spark.read.schema(DELTAS)
        rows = reader.parquet(*paths) if paths else self._spark.createDataFrame([], DELTAS)
        return rollup(rows).filter(" or ".join(f"{c} <> 0" for c in SUMS))
