"""Scores of texts by a word model and by a probabilistic suffix tree over all words.

The base is a smoothed word model whose counts are never cut: the commonest words, at most 1 / `frequent_share`, are sent
to all tasks and numbered; any other word's tokens are dealt to one task, which counts them.

The tree's contexts are runs of one to `depth` words that occur at least `least_context` times in training, whatever the
size of the corpus; all their next words count. Each token is dealt once, packed with the words before it, by its shortest context
that fits one task; there that context and all longer ones are whole, so the task counts, tests and scores them. Contexts of
more tokens are `Hot`: their next words are counted beforehand. A context is retained if its next-word distribution diverges from
that of its suffix by more nats over all its occurrences than it has different next words; it is smoothed as below. A token is
scored in the longest retained context of its history.

After a word that is no context the history is told by symbols, in a small tree sent to all tasks: the words of at
least `symbol_share`, and one for all others. A context of one or two symbols is retained if its next-symbol distribution diverges from that of its suffix by more nats over all its
occurrences than it has different next symbols. Distributions are smoothed towards the suffix with as much
weight as there are different next symbols (Witten-Bell). Such a token is scored in the longest retained run of
symbols; within the symbol for other words, by the share of its base probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import text as T
from wayfold.llm.tables import written

#: Hash that stands for the end of a text.
END = -1
OTHER = 0
FOLDS = 10
#: Tokens of the texts that a task packs at once.
BATCH_TOKENS = 1 << 20
#: Next words of hot contexts are sent to all tasks if they have one in so many of the tokens of a task.
COMMON_ARCS = 64


@dataclass(frozen=True)
class Settings:
    #: Words of the longest context.
    depth: int = 3
    #: A context that occurs once tells nothing of its distribution.
    least_context: int = 2
    #: A task gets about so many tokens, or this share of all if that is more; a context of more tokens is hot.
    task_tokens: int = 1 << 20
    hot_share: float = 2.0**-12
    #: Every share bounds a table that is sent to all tasks to 1 / share entries.
    frequent_share: float = 2.0**-19
    symbol_share: float = 2.0**-12
    context_share: float = 2.0**-14
    transition_share: float = 2.0**-20
    add: float = 0.1


@dataclass(frozen=True)
class Base:
    """The frequent words and the sums that the smoothed word model needs."""

    tokens: int
    types: int
    add: float
    hashes: np.ndarray  # sorted
    counts: np.ndarray
    symbols: np.ndarray  # of the hashes; OTHER for words that are no symbol

    def p(self, counts: np.ndarray) -> np.ndarray:
        return (counts + self.add) / (self.tokens + self.add * (self.types + 1))

    def log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(self.p(counts))

    @cached_property
    def by_rank(self) -> np.ndarray:
        """Places of the words, the commonest first: their codes less one. Small codes pack well."""
        return np.argsort(-self.counts, kind="stable")

    @cached_property
    def rank(self) -> np.ndarray:
        out = np.empty(len(self.hashes), np.int64)
        out[self.by_rank] = np.arange(len(out))
        return out

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """From 1; 0 for words without number."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        # A word is at one of the few places after that of its first bits.
        at = self._starts[(hashes >> 44) + (1 << 19)]
        out = np.zeros(len(hashes), np.int64)
        left = np.arange(len(hashes))
        while len(left):
            here = self.hashes[at]
            found = here == hashes
            out[left[found]] = 1 + self.rank[at[found]]
            more = (here < hashes) & (at < len(self.hashes) - 1)
            left, at, hashes = left[more], at[more] + 1, hashes[more]
        return out

    @cached_property
    def _starts(self) -> np.ndarray:
        """The place of the first word with each value of the first 20 bits, or after."""
        first = np.searchsorted(self.hashes >> 44, np.arange(-(1 << 19), 1 << 19))
        return np.minimum(first, len(self.hashes) - 1)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text with its end, and the bounds of the texts."""
    t = T.Texts(texts, lower=True)
    bounds = t.first + np.arange(len(t.first))
    out = np.full(bounds[-1], END, np.int64)
    ends = np.zeros(bounds[-1], bool)
    ends[bounds[1:] - 1] = True
    words = t.word_hashes().view(np.int64)
    # No word may pass for the end of a text.
    out[~ends] = np.where(words == END, 0, words)
    return out, bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "text"):
        hashes, n = np.unique(_tokens(batch.column("text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], ["hash", "n"])


def _prepared(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    remainder = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS
    return docs.select(
        doc_id.alias("doc_id"),
        (remainder == 0).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def word_counts(prepared: DataFrame) -> DataFrame:
    """(hash, n): how often each token occurs in the training texts."""
    found = prepared.filter("not held_out").select("text").mapInArrow(_count, "hash long, n long")
    return found.groupBy("hash").agg(F.sum("n").alias("n"))


def base_model(counts: DataFrame, settings: Settings) -> Base:
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    most = round(1 / settings.frequent_share)
    # Words of a higher count than the last bin's are fewer than `most` for any text that fits a cluster; else by the share.
    bins = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("words")).toPandas().sort_values("n", ascending=False)
    fit = bins["n"][bins["words"].cumsum() <= most]
    least = int(fit.min()) if len(fit) else settings.frequent_share * tokens
    frequent = counts.filter(F.col("n") >= least).toArrow()
    hashes, n = (frequent.column(x).to_numpy() for x in ("hash", "n"))
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    chosen = np.flatnonzero(n >= settings.symbol_share * tokens)
    symbols = np.zeros(len(n), np.int64)
    symbols[chosen] = 1 + np.arange(len(chosen))
    return Base(tokens, types, settings.add, hashes, n, symbols)


def _code(base: Base):
    """The symbols of training texts and the texts' sizes, packed."""
    chosen = base.symbols > 0
    hashes, numbers = base.hashes[chosen], np.append(base.symbols[chosen], OTHER).astype(np.int16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, "text"):
            tokens, bounds = _tokens(batch.filter(pc.invert(batch.column("held_out"))).column("text"))
            packed = [_packed(numbers[_place(hashes, tokens)]), _packed(np.diff(bounds).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], ["symbols", "sizes"])

    return run


CODED = "symbols binary, sizes binary"


def _histories(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All symbols, and how many symbols of the same text stand before each."""
    for batch in batches:
        for symbols, sizes in zip(batch.column("symbols").to_pylist(), batch.column("sizes").to_pylist()):
            sizes = _unpacked(sizes, np.int64)
            yield _unpacked(symbols, np.int16).astype(np.int64), T.ranges(np.zeros(len(sizes), np.int64), sizes)


def _pairs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, place in _histories(batches):
            at = np.flatnonzero(place >= 1)
            keys, n = np.unique(s[at - 1] * width + s[at], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    return run


def _triples(width: int, contexts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, place in _histories(batches):
            at = np.flatnonzero(place >= 2)
            pair = _place(contexts, s[at - 2] * width + s[at - 1])
            keys, n = np.unique(pair[pair >= 0] * width + s[at[pair >= 0]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    return run


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass(frozen=True)
class Level:
    """The retained contexts of one length and the probabilities of their frequent next symbols."""

    contexts: np.ndarray  # sorted keys
    rest: np.ndarray  # weight of the suffix's distribution
    keys: np.ndarray  # sorted; context number * width + next symbol
    own: np.ndarray  # share of the next symbol without the suffix's part


def _level(counts: DataFrame, suffix: DataFrame, width: int, floor: float) -> Level:
    """Retain contexts by divergence. counts: (context, next, n). suffix: (context, next, p of the suffix)."""
    totals = counts.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    tested = (
        counts.join(totals, "context")
        .join(suffix, ["context", "next"])
        .withColumn("gain", F.col("n") * F.log(F.col("n") / F.col("total") / F.col("p")))
    )
    retained = tested.groupBy("context").agg(
        F.first("total").alias("total"), F.first("kinds").alias("kinds"), F.sum("gain").alias("gain")
    ).filter("gain > kinds")
    kept = counts.filter(F.col("n") >= floor).join(retained, "context")
    contexts = retained.select("context", "total", "kinds").toPandas().sort_values("context")
    arcs = kept.select("context", "next", "n").toPandas().sort_values(["context", "next"])
    keys, total, kinds = (contexts[c].to_numpy(np.int64) for c in ("context", "total", "kinds"))
    number = np.searchsorted(keys, arcs["context"].to_numpy(np.int64))
    n = arcs["n"].to_numpy(np.float64)
    held = np.bincount(number, n, len(keys)) if len(keys) else np.zeros(0)
    return Level(
        keys,
        (kinds + total - held) / (total + kinds),
        number * width + arcs["next"].to_numpy(np.int64),
        n / (total + kinds)[number],
    )


@dataclass(frozen=True)
class Tree:
    width: int
    root: np.ndarray  # probability of each symbol without context
    one: Level
    two: Level

    def _in(self, level: Level, number: np.ndarray, after: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        arc = _place(level.keys, number * self.width + after)
        own = np.where(arc >= 0, level.own[arc], 0.0) if len(level.own) else 0.0
        return own + level.rest[number] * suffix

    def gain(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """What the longest retained suffix adds to log10 of each symbol's probability."""
        one, two = (np.append(np.zeros(min(k, len(symbols)), np.int64), symbols[:-k]) for k in (1, 2))
        return self.gain_after(symbols, one, two, place)

    def gain_after(self, symbols: np.ndarray, one: np.ndarray, two: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The same, given the symbol before each and the one before that; `place` tells how many there are."""
        root = self.root[symbols]
        p = root.copy()
        for level, length in ((self.one, 1), (self.two, 2)):
            at = np.flatnonzero(place >= length)
            if not len(at) or not len(level.contexts):
                continue
            context = one[at] if length == 1 else two[at] * self.width + one[at]
            number = _place(level.contexts, context)
            at, number = at[number >= 0], number[number >= 0]
            p[at] = self._in(level, number, symbols[at], p[at])
        return np.log10(p / root)


def suffix_tree(coded: DataFrame, base: Base, settings: Settings) -> Tree:
    spark = coded.sparkSession
    width = int(base.symbols.max(initial=0)) + 1
    root = np.zeros(width)
    chosen = base.symbols > 0
    root[base.symbols[chosen]] = 10 ** base.log10(base.counts[chosen])
    root[OTHER] = max(1 - root[1:].sum(), 1e-12)
    floor = settings.transition_share * base.tokens

    def counted(run) -> DataFrame:
        rows = coded.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        rows = written(rows, "context-counts")
        return rows.select(
            F.expr(f"key div {width}").alias("context"), (F.col("key") % width).alias("next"), "n"
        )

    pairs = counted(_pairs(width))
    by_root = spark.createDataFrame([(i, float(p)) for i, p in enumerate(root)], "next long, p double")
    one = _level(pairs, pairs.select("context", "next").join(by_root, "next"), width, floor)

    often = pairs.filter(F.col("n") >= settings.context_share * base.tokens)
    keys = np.sort(often.select((F.col("context") * width + F.col("next")).alias("key")).toPandas()["key"].to_numpy(np.int64))
    triples = counted(_triples(width, keys))
    numbered = spark.createDataFrame(
        [(i, int(k), int(k) % width) for i, k in enumerate(keys)], "context long, key long, last long"
    )
    totals = pairs.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    # The suffix's smoothed distribution, whether the suffix is retained or not.
    suffix = (
        triples.select("context", "next").join(numbered, "context")
        .join(pairs.select(F.col("context").alias("last"), "next", "n"), ["last", "next"])
        .join(totals.withColumnRenamed("context", "last"), "last")
        .join(by_root, "next")
        .select("context", "next", ((F.col("n") + F.col("kinds") * F.col("p")) / (F.col("total") + F.col("kinds"))).alias("p"))
    )
    two = _level(triples, suffix, width, floor)
    two = Level(keys[two.contexts] if len(two.contexts) else two.contexts, two.rest, two.keys, two.own)
    return Tree(width, root, one, two)


def _packed(x: np.ndarray) -> bytes:
    """The bytes of an array by their place in its entries, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(x).to_bytes(4, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def _unpacked(data: bytes, dtype: type) -> np.ndarray:
    n, width = int.from_bytes(data[:4], "little"), np.dtype(dtype).itemsize
    planes = pa.Codec("zstd").decompress(data[4:], n * width, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(dtype).reshape(n)


#: `data` are packed arrays: of tokens (see `Records`), of a batch of texts, or of sums for the texts of a batch.
DEALT = "dest long, texts boolean, data array<binary>"


def _rows(rows: list[tuple[int, bool, list[bytes]]]) -> pa.Table:
    dest, texts, data = zip(*rows) if rows else ((), (), ())
    columns = [pa.array(dest, pa.int64()), pa.array(texts, pa.bool_()), pa.array(data, pa.list_(pa.binary()))]
    return pa.Table.from_arrays(columns, ["dest", "texts", "data"])


@dataclass(frozen=True)
class Hot:
    """The contexts of more tokens than one task takes, by length, all of whose suffixes are such contexts too."""

    words: np.ndarray  # sorted hashes
    keys: list[np.ndarray]  # for each length, sorted: the numbers of the words from 1, the last word's first
    total: np.ndarray
    kinds: np.ndarray
    retained: np.ndarray
    arcs: np.ndarray  # sorted; common next words: number of the context * width + code of the word
    counts: np.ndarray

    def numbers(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """For each length the contexts' numbers, or -1. words: numbers of the hot words before, nearest first; 0: no hot one."""
        out, key, before, hot = [], 0, 0, True
        for length, (word, keys) in enumerate(zip(words, self.keys)):
            key = key + word.astype(np.int64) * (len(self.words) + 1) ** length
            hot = hot & (word > 0)
            at = np.where(hot, _place(keys, key), -1)
            hot = at >= 0
            out.append(np.where(hot, at + before, -1))
            before += len(keys)
        return out

    def suffixes(self) -> np.ndarray:
        """For each context the number of the one without its first word, or -1."""
        out, before = [np.full(len(x), -1) for x in self.keys[:1]], 0
        for length, keys in enumerate(self.keys[1:], 1):
            out.append(before + _place(self.keys[length - 1], keys % (len(self.words) + 1) ** length))
            before += len(self.keys[length - 1])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


class Words:
    """The words of some tokens by code: 0 none, then the numbered words, then `rare` ones."""

    def __init__(self, base: Base, hot: Hot, rare: np.ndarray):
        self.base, self.hot, self.rare = base, hot, rare
        self.first_rare = 1 + len(base.hashes)
        self.width = self.first_rare + len(rare)

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.int64), self.base.hashes[self.base.by_rank], self.rare])

    @cached_property
    def _hot(self) -> np.ndarray:
        out = np.zeros(self.width, np.int64)
        out[self.base.codes(self.hot.words)] = 1 + np.arange(len(self.hot.words))
        return out

    def numbers(self, w: list[np.ndarray]) -> list[np.ndarray]:
        if not len(self.hot.words):
            return []
        out = [np.full(len(w[0]), -1) for _ in self.hot.keys]
        at = np.flatnonzero(self._hot[w[1]])
        for mine, found in zip(out, self.hot.numbers([self._hot[x[at]] for x in w[1:]])):
            mine[at] = found
        return out

    def buckets(self, w: list[np.ndarray], numbers: list[np.ndarray], parts: int) -> np.ndarray:
        """By the shortest context that is not hot, or by the token itself."""
        mixed = T.mix(self.hashes.view(np.uint64))
        out = mixed[np.where(w[1] > 0, w[1], w[0])]
        # From here on only tokens all of whose shorter contexts are hot.
        at, key = np.arange(len(out)), out
        for number, x in zip(numbers, w[2:]):
            hot = number[at] >= 0
            at, key = at[hot], key[hot]
            key = T.mix(key * np.uint64(0x9E3779B97F4A7C15) + mixed[x[at]])
            out[at] = np.where(x[at] > 0, key, mixed[w[0][at]])
        if numbers and len(numbers) + 1 >= len(w):
            at = at[numbers[-1][at] >= 0]
            out[at] = mixed[w[0][at]]
        return (T.mix(out) % np.uint64(parts)).astype(np.int64)

    def common(self, number: np.ndarray, word: np.ndarray) -> np.ndarray:
        """How often the common next words of hot contexts occur there, -1 for others."""
        at = _place(self.hot.arcs, number * self.first_rare + word)
        return np.where((at >= 0) & (word < self.first_rare), np.append(self.hot.counts, -1)[at], -1)


@dataclass
class Records:
    """Tokens with the words before them, of texts of some batches."""

    w: list[np.ndarray]  # codes: the token, the word before it, the one before that, ...
    row: np.ndarray  # twice the place of the text in its batch, and one for a held-out text
    batch: np.ndarray  # place in batches
    batches: np.ndarray
    words: Words
    known: np.ndarray  # counts of the rare words, -1 where not known
    n: list[np.ndarray]  # for each length, how often the token follows the hot context

    def packed(self, dest: np.ndarray) -> Iterator[tuple[int, bool, list[bytes]]]:
        order = np.argsort(dest.astype(np.uint16) if dest.max(initial=0) < 1 << 16 else dest, kind="stable")
        first = self.words.first_rare
        borders = np.flatnonzero(np.diff(dest[order])) + 1
        for at in np.split(order, borders) if len(order) else []:
            w = [x[at] for x in self.w]
            used = np.unique(np.concatenate([x[x >= first] for x in w]))
            w = [np.where(x >= first, first + np.searchsorted(used, x), x) for x in w]
            n = [x[at].astype(np.int64) for x in self.n] if any(x[at].any() for x in self.n) else []
            batches, batch = np.unique(self.batch[at], return_inverse=True)
            row = np.diff(self.row[at].astype(np.uint32), prepend=np.uint32(0))
            arrays = [self.batches[batches], batch.astype(np.uint32), row, self.words.rare[used - first], self.known[used - first]]
            arrays += [x.astype(np.uint32) for x in w] + n
            yield int(dest[at[0]]), False, [_packed(x) for x in arrays]

    @classmethod
    def unpacked(cls, found: list[list[bytes]], base: Base, hot: Hot, before: int) -> Records:
        first = 1 + len(base.hashes)
        kinds = [np.int64, np.uint32, np.uint32, np.int64, np.int64, *[np.uint32] * (1 + before)]
        parts = [[_unpacked(x, kind) for x, kind in zip(data, kinds)] for data in found]
        join = lambda arrays, kind: np.concatenate([np.zeros(0, kind), *arrays])
        rare, codes = np.unique(join([x[3] for x in parts], np.int64), return_inverse=True)
        known = np.full(len(rare), -1)
        np.maximum.at(known, codes, join([x[4] for x in parts], np.int64))
        batches, places = np.unique(join([x[0] for x in parts], np.int64), return_inverse=True)
        w, batch, words_before, batches_before = [[] for _ in range(1 + before)], [], 0, 0
        for x in parts:
            code = first + codes[words_before : words_before + len(x[3])]
            for column, mine in zip(w, x[5:]):
                mine = mine.astype(np.int32)
                rarely = np.flatnonzero(mine >= first)
                mine[rarely] = code[mine[rarely] - first]
                column.append(mine)
            batch.append(places[batches_before : batches_before + len(x[0])][x[1]].astype(np.int32))
            words_before, batches_before = words_before + len(x[3]), batches_before + len(x[0])
        n = []
        for length in range(len(hot.keys)):
            at = len(kinds) + length
            n.append(join([_unpacked(d[at], np.int64) if at < len(d) else np.zeros(len(x[2]), np.int64) for d, x in zip(found, parts)], np.int64))
        row = join([np.cumsum(x[2], dtype=np.uint32) for x in parts], np.uint32)
        del parts
        for k, x in enumerate(w):
            w[k] = join(x, np.int32)
        return cls(w, row, join(batch, np.int32), batches, Words(base, hot, rare), known, n)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """Tokens of many texts, their numbers in each text, which texts are held out, and doc_ids."""
    parts, size = [], 0
    for batch in T.chunks(batches, "text"):
        tokens, bounds = _tokens(batch.column("text"))
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        parts.append((tokens, np.diff(bounds), held, batch.column("doc_id")))
        size += len(tokens)
        if size >= BATCH_TOKENS:
            yield _joined(parts)
            parts, size = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    tokens, sizes, held, ids = zip(*parts)
    return np.concatenate(tokens), np.concatenate(sizes), np.concatenate(held), pa.concat_arrays(ids)


def _with_before(tokens: np.ndarray, sizes: np.ndarray, before: int, none: int) -> list[np.ndarray]:
    """The tokens, the ones one place before in their text, two places before, ..."""
    place = T.ranges(np.zeros(len(sizes), np.int64), sizes)
    out = [tokens]
    for k in range(1, before + 1):
        x = np.full(len(tokens), none, tokens.dtype)
        x[k:] = tokens[:-k] if k <= len(tokens) else tokens[:0]
        out.append(np.where(place >= k, x, none).astype(tokens.dtype))
    return out


def _before(settings: Settings) -> int:
    """The tree of symbols looks at two words before."""
    return max(settings.depth, 2)


def _deal(shared: Broadcast, settings: Settings, parts: int, later: bool):
    """Tokens by `Words.buckets`, and each batch of texts; or, `later`, by themselves those of which a count is not known yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, hot, _ = shared.value
        logs = np.append(0.0, base.log10(base.counts[base.by_rank]))
        for number, (tokens, sizes, held, ids) in enumerate(_gathered(batches)):
            text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            code = base.codes(tokens).astype(np.int32)
            new = code == 0
            base_sums = [np.bincount(text, x, len(sizes)) for x in (~new, logs[code])] if not later else []
            rare, codes = np.unique(tokens[new], return_inverse=True)
            code[new] = 1 + len(base.hashes) + codes
            w = _with_before(code, sizes, _before(settings), 0)
            words = Words(base, hot, rare)
            missing, n = new, []
            for x in words.numbers(w):
                at = np.flatnonzero(x >= 0)
                common = words.common(x[at], w[0][at])
                missing = missing.copy()
                missing[at[common < 0]] = True
                n.append(np.zeros(len(x), np.int64))
                n[-1][at] = np.maximum(common, 0)
            chosen = np.flatnonzero(missing if later else ~missing & (w[1] > 0))
            content = zlib.crc32(tokens.tobytes(), zlib.crc32(sizes.tobytes() + held.tobytes()))
            batch = ((TaskContext.get().partitionId() << 16) + number << 32 | content) & (2**63 - 1)
            found = Records(
                [x[chosen] for x in w], text[chosen] * 2 + held[text[chosen]], np.zeros(len(chosen), np.int64), np.array([batch]),
                words, np.full(len(rare), -1), [x[chosen] for x in n],
            )
            if later:
                dest = (T.mix(tokens[chosen].view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            else:
                dest = words.buckets(found.w, words.numbers(found.w), parts)
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                arrays = [ids.fill_null(0).to_numpy(), known, held, sizes.astype(np.int64), base_sums[0].astype(np.int64), base_sums[1]]
                yield from _rows([(batch % parts, True, [str(batch).encode(), *map(_packed, arrays)])]).to_batches()
            for row in found.packed(dest):
                yield from _rows([row]).to_batches()

    return run


def _completed(shared: Broadcast, settings: Settings, parts: int):
    """Count rare tokens and uncommon next words of hot contexts, all of which are in one group, and deal them on."""

    def run(table: pa.Table) -> pa.Table:
        base, hot, _ = shared.value
        r = Records.unpacked(table.column("data").to_pylist(), base, hot, _before(settings))
        words, training = r.words, r.row % 2 == 0
        rare = r.w[0] >= words.first_rare
        r.known[np.unique(r.w[0][rare]) - words.first_rare] = 0
        r.known += np.bincount(r.w[0][rare & training] - words.first_rare, minlength=len(r.known)).astype(np.int64)
        numbers = words.numbers(r.w)
        for n, number in zip(r.n, numbers):
            at = np.flatnonzero(number >= 0)
            _, of = np.unique(number[at] * words.width + r.w[0][at], return_inverse=True)
            here = np.bincount(of, training[at], len(at)).astype(np.int64)[of]
            common = words.common(number[at], r.w[0][at])
            n[at] = np.where(common >= 0, common, here)
        return _rows(list(r.packed(words.buckets(r.w, numbers, parts))))

    return run


def _sums(shared: Broadcast, settings: Settings):
    """For each batch of texts what its tokens of this group add: (row, gain, base score and known ones among the rare words)."""

    def run(table: pa.Table) -> pa.Table:
        base, hot, tree = shared.value
        texts = table.column("texts").to_numpy().astype(bool)
        data = table.column("data").to_pylist()
        # What tells of the texts goes on as it came.
        out = [(int(x[0]), True, x[1:]) for x, whole in zip(data, texts) if whole]
        r = Records.unpacked([x for x, whole in zip(data, texts) if not whole], base, hot, _before(settings))
        del table, data
        count = np.concatenate([np.zeros(1, np.int64), base.counts[base.by_rank], r.known])[r.w[0]]
        rare = r.w[0] >= r.words.first_rare
        gain = _gains(r, base.p(count), hot, tree, base, settings)
        key = r.batch.astype(np.int64) << 32 | r.row >> 1
        first, of = _alike(key)
        key = key[first]
        columns = [gain, np.where(rare, base.log10(count), 0.0), rare & (count > 0)]
        columns = [np.bincount(of, x, len(key)) for x in columns]
        borders = np.searchsorted(key >> 32, np.arange(len(r.batches) + 1))
        for batch, first, end in zip(r.batches, borders[:-1], borders[1:]):
            row = np.diff((key[first:end] & (2**32 - 1)).astype(np.uint32), prepend=np.uint32(0))
            # Rounded to 2**-32, for the sake of their size.
            parts = [np.round(x[first:end] * 2.0**32) / 2.0**32 for x in columns[:2]]
            out.append((int(batch), False, [_packed(x) for x in (row, *parts, columns[2][first:end].astype(np.uint32))]))
        return _rows(out)

    return run


def _alike(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different key, and for each place the number of its key."""
    order = np.argsort(key)
    new = np.append(True, np.diff(key[order]) != 0)[: len(key)]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new) - 1
    return order[new], out


def _gains(r: Records, below: np.ndarray, hot: Hot, tree: Tree, base: Base, settings: Settings) -> np.ndarray:
    """What its contexts add to the log10 of each token's probability; below: the probability without context."""
    words, gain = r.words, np.zeros(len(below))
    training = r.row % 2 == 0
    numbers = words.numbers(r.w)
    at, context = np.arange(len(below)), np.zeros(len(below), np.int64)
    for length in range(1, settings.depth + 1):
        inside = r.w[length][at] > 0
        at, context = at[inside], context[inside]
        if not len(at):
            break
        first, context = _alike(context * words.width + r.w[length][at])
        arc_first, arc = _alike(context * words.width + r.w[0][at])
        of = context[arc_first]
        seen = np.bincount(arc, training[at], len(arc_first))
        total = np.bincount(of, seen, len(first))
        kinds = np.bincount(of, seen > 0, len(first))
        surprise = np.bincount(of, seen * np.log(np.maximum(seen, 1) / below[at[arc_first]]), len(first))
        with np.errstate(divide="ignore", invalid="ignore"):
            retained = surprise - total * np.log(total) > kinds
        n = seen[arc]
        if length <= len(numbers):
            number = numbers[length - 1][at[first]]
            known = np.flatnonzero(number >= 0)
            for mine, whole in ((total, hot.total), (kinds, hot.kinds), (retained, hot.retained)):
                mine[known] = whole[number[known]]
            n = np.where(number[context] >= 0, r.n[length - 1][at], n)
        enough = (total >= settings.least_context)[context]
        if length == 1:
            other = at[~enough]
            symbols = np.concatenate([np.zeros(1, np.int64), base.symbols[base.by_rank], np.zeros(len(words.rare), np.int64)])
            place = (r.w[1][other] > 0).astype(np.int64) + (r.w[2][other] > 0)
            gain[other] = tree.gain_after(*(symbols[x[other]] for x in r.w[:3]), place)
        at, context, n = at[enough], context[enough], n[enough]
        told = retained[context]
        mine = at[told]
        p = (n[told] + kinds[context[told]] * below[mine]) / (total + kinds)[context[told]]
        gain[mine] += np.log10(p / below[mine])
        below[mine] = p
    return gain


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scored(table: pa.Table) -> pa.Table:
    """The rows of a batch of texts."""
    texts = table.column("texts").to_pylist()
    data = table.column("data").to_pylist()
    if sum(texts) != 1:
        raise ValueError("the texts came in another order or in other batches when they were read again")
    kinds = [np.int64, bool, bool, np.int64, np.int64, np.float64]
    ids, valid, held, n_tokens, n_known, score = (_unpacked(x, kind) for x, kind in zip(data[texts.index(True)], kinds))
    gain, score, n_known = np.zeros(len(ids)), score.copy(), n_known.copy()
    for part in (x for x, whole in zip(data, texts) if not whole):
        row, *sums = (_unpacked(x, kind) for x, kind in zip(part, (np.uint32, np.float64, np.float64, np.uint32)))
        row = np.cumsum(row, dtype=np.uint32)
        for mine, x in zip((gain, score, n_known), sums):
            mine[row] += x.astype(mine.dtype)
    columns = [pa.array(ids, mask=~valid), pa.array(held), pa.array(n_tokens), pa.array(n_known), pa.array(score), pa.array(score + gain)]
    return pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def _hot_words(words: np.ndarray, settings: Settings):
    """Token hashes, and for each the numbers of the hot words before it, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        for batch in T.chunks(batches, "text"):
            tokens, bounds = _tokens(batch.column("text"))
            yield tokens, _with_before(1 + _place(words, tokens), np.diff(bounds), settings.depth, 0)[1:]

    return run


def _hot_runs(words: np.ndarray, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, before in _hot_words(words, settings)(batches):
            key, hot = before[0], before[0] > 0
            for length, word in enumerate(before[1:], 2):
                hot = hot & (word > 0)
                key = key + word * (len(words) + 1) ** (length - 1)
                keys, n = np.unique(key[hot], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), length)), pa.array(keys), pa.array(n)], ["length", "key", "n"])

    return run


def _hot_arcs(hot: Hot, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, before in _hot_words(hot.words, settings)(batches):
            words, word = np.unique(tokens, return_inverse=True)
            for number in hot.numbers(before):
                at = number >= 0
                keys, n = np.unique(number[at] * len(words) + word[at], return_counts=True)
                columns = [words[keys % max(len(words), 1)], keys // max(len(words), 1), n]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["word", "context", "n"])

    return run


def _surprise(hot: Hot, base: Base, length: int):
    """(context, kinds, surprise) of the hot contexts of this length, those of the shorter ones being known."""
    suffixes = hot.suffixes()
    first = sum(len(x) for x in hot.keys[: length - 1])
    end = first + len(hot.keys[length - 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arcs = batch.column("arcs")
            sizes = pc.list_value_length(arcs).to_numpy(zero_copy_only=False).astype(np.int64)
            word = np.repeat(np.arange(len(sizes)), sizes)
            context, n = (pc.struct_field(arcs.flatten(), x).to_numpy(zero_copy_only=False) for x in ("context", "n"))
            order = np.argsort(key := word * len(suffixes) + context)
            key, word, context, n = key[order], word[order], context[order], n[order].astype(np.float64)
            below = base.p(batch.column("count").to_numpy(zero_copy_only=False))[word]
            at = np.flatnonzero((context >= first) & (context < end))
            p = below[at]
            # The suffixes, from the shortest: a context's suffix has every next word of the context.
            chain = [context[at]]
            while len(at) and (suffix := suffixes[chain[-1]]).max() >= 0:
                chain.append(suffix)
            for suffix in reversed(chain[1:]):
                seen = n[_place(key, word[at] * len(suffixes) + suffix)]
                smoothed = (seen + hot.kinds[suffix] * p) / (hot.total[suffix] + hot.kinds[suffix])
                p = np.where(hot.retained[suffix], smoothed, p)
            own, of = np.unique(context[at], return_inverse=True)
            surprise = np.bincount(of, n[at] * np.log(n[at] / p), len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int64)), pa.array(np.bincount(of, minlength=len(own))), pa.array(surprise)], ["context", "kinds", "surprise"]
            )

    return run


def hot_contexts(training: DataFrame, counts: DataFrame, base: Base, settings: Settings) -> Hot:
    """Contexts of more tokens than one task takes, of which there are at most `depth` / `hot_share`."""
    least = max(settings.task_tokens, settings.hot_share * base.tokens)
    chosen = (base.counts > least) & (base.hashes != END)
    words, zero = base.hashes[chosen], np.zeros(0, np.int64)
    if not len(words):
        return Hot(zero, [], zero, zero, zero.astype(bool), zero, zero)
    # Longer contexts, whose keys would not fit 63 bits, are dealt whole.
    lengths = min(settings.depth, 62 // int(len(words) + 1).bit_length())
    settings = replace(settings, depth=lengths)
    keys, totals = [1 + np.arange(len(words))], [base.counts[chosen]]
    if lengths > 1:
        runs = training.mapInArrow(_hot_runs(words, settings), "length long, key long, n long").groupBy("length", "key")
        runs = runs.agg(F.sum("n").alias("n")).filter(F.col("n") > least).toPandas().sort_values(["length", "key"])
        for length in range(2, lengths + 1):
            mine = runs[runs["length"] == length]
            keys.append(mine["key"].to_numpy(np.int64))
            totals.append(mine["n"].to_numpy(np.int64))
    total = np.concatenate(totals)
    kinds, retained = np.zeros(len(total), np.int64), np.zeros(len(total), bool)
    hot = Hot(words, keys, total, kinds, retained, zero, zero)
    arcs = training.mapInArrow(_hot_arcs(hot, settings), "word long, context long, n long")
    arcs = arcs.groupBy("word", "context").agg(F.sum("n").alias("n"))
    arcs = arcs.groupBy("word").agg(F.collect_list(F.struct("context", "n")).alias("arcs"))
    arcs = written(arcs.join(counts.select(F.col("hash").alias("word"), F.col("n").alias("count")), "word"), "hot-arcs")
    for length in range(1, lengths + 1):
        if not len(keys[length - 1]):
            break
        found = arcs.mapInArrow(_surprise(hot, base, length), "context long, kinds long, surprise double").groupBy("context")
        found = found.agg(F.sum("kinds").alias("kinds"), F.sum("surprise").alias("surprise")).toPandas()
        at = found["context"].to_numpy(np.int64)
        kinds[at] = found["kinds"]
        retained[at] = found["surprise"].to_numpy() - total[at] * np.log(total[at]) > kinds[at]
    common = arcs.select("word", F.explode("arcs").alias("arc")).select("word", "arc.*").filter(F.col("n") >= least / COMMON_ARCS).toPandas()
    code = base.codes(common["word"].to_numpy(np.int64))
    key = common["context"].to_numpy(np.int64) * (1 + len(base.hashes)) + code
    order = np.argsort(key)
    order = order[code[order] > 0]
    return replace(hot, arcs=key[order], counts=common["n"].to_numpy(np.int64)[order])


def score(docs: DataFrame, settings: Settings = Settings(), reread: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`.

    Null and empty texts consist of their end alone. Rows without doc_id count as doc_id ''; repeated rows
    are scored one by one and all count in training. Without training texts every token has probability 1.
    Other columns are ignored; an empty table gives an empty result. Words are compared by 64-bit hashes.
    The texts are read several times. With `reread`, docs must give the same rows in the same order each time, as files
    do (the result fails otherwise); without, they are written first.
    """
    prepared = _prepared(docs)
    if not reread:
        prepared = written(prepared, "texts")
    training = prepared.filter("not held_out")
    counts = written(word_counts(prepared), "word-counts")
    base = base_model(counts, settings)
    tree = suffix_tree(written(training.mapInArrow(_code(base), CODED), "symbols"), base, settings)
    hot = hot_contexts(training, counts, base, settings)

    parts = 1 + int(base.tokens / max(settings.task_tokens, settings.hot_share * base.tokens))
    shared = docs.sparkSession.sparkContext.broadcast((base, hot, tree))
    later = prepared.mapInArrow(_deal(shared, settings, 1 + parts // 4, True), DEALT)
    later = later.groupBy("dest").applyInArrow(_completed(shared, settings, parts), DEALT)
    dealt = prepared.mapInArrow(_deal(shared, settings, parts, False), DEALT).unionByName(later)
    sums = dealt.groupBy("dest").applyInArrow(_sums(shared, settings), DEALT)
    return sums.groupBy("dest").applyInArrow(_scored, SCORED).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(base.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
