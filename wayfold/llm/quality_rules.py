"""Quality rules: base counts, and the distance of a text's histograms from those of its language.

Two histograms of each document, of character classes and of common words, are compared with the
histograms of all documents of the same language, by Jensen-Shannon
distance (base 2, between 0 and 1). Everything is built from Spark's own expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.tables import BROADCAST_BYTES, bytes_of, written

# Fixed values of the base rules.
GAP = r"[\x20\x09-\x0D]+"
NOT_GAP = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

CLASSES = ("upper", "letter", "mark")


@dataclass(frozen=True)
class Rules:
    #: A word is common in a language if at least this share of the language's words are it, so a
    #: language has at most 1 / common_share of them.
    common_share: float = 0.004
    #: Guards: shorter documents, and languages with less text, are not judged by the distances.
    min_words: int = 100
    min_language_words: int = 2_000
    max_class_distance: float = 0.25
    max_word_distance: float = 0.3


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once. Filters that Spark moves below a projection copy its
    expressions; inside a lambda a copied expression would be computed again for every element."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Number of words in windows of three words that occur twice or more."""

    def twice(s: Column) -> Callable[[Column, Column], Column]:
        same = lambda x, k: F.coalesce(F.get(s, k)["gram"] == x["gram"], F.lit(False))
        return lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["at"])

    covered = lambda t: F.array_union(F.array_union(t, F.transform(t, lambda x: x + 1)), F.transform(t, lambda x: x + 2))
    in_order = lambda g: F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("gram"), i.alias("at"))))
    # Only texts with some repeated window pay for sorting the windows with their places.
    repeats = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(
        let(in_order(g), lambda s: let(F.array_compact(F.transform(s, twice(s))), lambda t: F.size(covered(t))))
    )
    gram = lambda w: lambda i: F.xxhash64(*(F.element_at(w, i + k) for k in range(3)))
    return let(
        words,
        lambda w: F.when(F.size(w) < 3, 0).otherwise(
            let(F.transform(F.sequence(F.lit(1), F.size(w) - 2), gram(w)), repeats)
        ),
    )


def _left(pattern: str, text: str = "text") -> Column:
    """Number of characters of the text that the pattern does not match."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _classes(text: str = "text") -> dict[str, Column]:
    upper, letters = _left(r"\P{Lu}+", text), _left(r"\P{L}+", text)
    return {"upper": upper, "letter": letters - upper, "mark": _left(GAP, text) - letters}


def language_references(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per language: shares of the character classes, common words and their shares.

    Characters are counted on the distinct words, weighted by how often each occurs.
    """
    lang = F.coalesce("lang", F.lit(""))
    counts = written(
        docs.select(lang.alias("lang"), F.explode(F.split("text", GAP)).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
        .filter("word <> ''"),
        "word-counts",
    )
    # Written, so that Spark knows its size and, while it is small, does not deal the words of a language to one task.
    totals = written(
        counts.groupBy("lang").agg(
            F.sum("n").alias("language_words"), *(F.sum(c * F.col("n")).alias(k) for k, c in _classes("word").items())
        ),
        "language-totals",
    )
    common = (
        counts.join(totals.select("lang", "language_words"), "lang")
        .filter(F.col("n") >= rules.common_share * F.col("language_words"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("word", (F.col("n") / F.col("language_words")).alias("share")))).alias("common"))
    )
    every = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    return totals.join(common, "lang", "left").select(
        F.col("lang").alias("ref_lang"),
        "language_words",
        F.array(*(F.col(c) / F.greatest(every, F.lit(1)) for c in CLASSES)).alias("class_shares"),
        F.coalesce(F.col("common.word"), F.array().cast("array<string>")).alias("common_words"),
        F.coalesce(F.col("common.share"), F.array().cast("array<double>")).alias("common_shares"),
    )


def _term(p: Column, q: Column) -> Column:
    """What one entry adds to twice the divergence."""
    mean = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / mean)).otherwise(F.lit(0.0))
    return part(p) + part(q)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _distance(twice_divergence: Column) -> Column:
    return F.sqrt(F.greatest(twice_divergence / 2, F.lit(0.0)))


def _word_distance(words: Column) -> Column:
    """Distance of the shares of the language's common words, and of all others together."""
    n = F.size(words).cast("double")
    share = lambda k: F.element_at("common_shares", k)
    place = lambda w: F.array_position("common_words", w).cast("int")
    places = F.sort_array(F.filter(F.transform(words, place), lambda x: x > 0))

    def twice_divergence(places: Column, seen: Column, firsts: Column) -> Column:
        times = lambda i: F.coalesce(F.get(firsts, i + 1), F.size(places) + 1) - F.get(firsts, i)
        found = _sum(F.transform(seen, lambda k, i: _term(times(i) / n, share(k))))
        # A common word that is absent adds its whole share.
        absent = _sum("common_shares") - _sum(F.transform(seen, share))
        return found + absent + _term(1 - F.size(places) / n, 1 - _sum("common_shares"))

    first = lambda p: lambda k: F.array_position(p, k).cast("int")
    return let(
        places,
        lambda p: let(
            F.array_distinct(p),
            lambda d: let(F.transform(d, first(p)), lambda f: _distance(twice_divergence(p, d, f))),
        ),
    )


def measure(docs: DataFrame, references: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The base counts of each row, class_distance and word_distance.

    The distances are null for a text without words or a language without reference.
    """
    words = F.array_remove(F.split("text", GAP), "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_GAP))
    known = F.col("ref_lang").isNotNull()
    by_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        _repeat_words(w).cast("long").alias("n_repeat_words"),
        F.when(known & (F.size(w) > 0), _word_distance(w)).alias("word_distance"),
    )
    counted = (
        docs.select(
            "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), *keep
        )
        .join(references, F.col("lang") == F.col("ref_lang"), "left")
        .select(
            "*",
            let(words, by_words).alias("words"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            *(n.alias(c) for c, n in _classes().items()),
        )
    )
    every = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    divergences = (_term(F.col(c) / every, F.get("class_shares", F.lit(i))) for i, c in enumerate(CLASSES))
    n_words, n_repeat = F.col("words.n_words"), F.col("words.n_repeat_words")
    return counted.select(
        "doc_id", "text", *keep, "language_words", "n_dup_lines", "words.*",
        every.alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        ((n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)).alias("base_failed"),
        F.when(known & (every > 0), _distance(sum(divergences, F.lit(0.0)))).alias("class_distance"),
    )


def judge(docs: DataFrame, rules: Rules = Rules(), keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of `docs` (doc_id, text, lang): counts, distances and the verdict `kept`.

    A null text counts as an empty one and fails, a null language is a language of its own. Rows
    with the same doc_id are judged one by one. An empty table gives an empty result. Columns of
    `docs` other than these three are ignored unless named in `keep`.
    """
    references = written(language_references(docs, rules), "language-references")
    size = bytes_of(references, 64 + 24 * F.size("common_words") + F.length(F.concat_ws("", "common_words")))
    if size <= BROADCAST_BYTES:
        references = F.broadcast(references)
    guarded = (F.col("n_words") >= rules.min_words) & (F.col("language_words") >= rules.min_language_words)
    far = (F.col("class_distance") > rules.max_class_distance) | (F.col("word_distance") > rules.max_word_distance)
    return measure(docs, references, keep).select(
        "*", (~F.col("base_failed") & ~F.coalesce(guarded & far, F.lit(False))).alias("kept")
    )
