"""Benchmark passages in documents, by the q-gram lemma in diagonal bands and banded alignment.

Texts are compared as UTF-8 bytes with A-Z lowered and every run of white space made one space. Items are cut
into overlapping passages. A passage of m bytes with at most k edits in a document shares at least
m - q + 1 - k * q grams of q bytes with it, on diagonals at most 2k apart. Bands of diagonals overlap by more
than that, so every such region fills one band, and bands with enough shared grams are aligned.

Items shorter than `min_passage` allow no edit and must stand between word borders: they are looked up whole, by a gram
of their own length. An item of less than q bytes has no gram and is not looked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import text as T

#: Between texts, and outside of them; no byte of a text is it.
_BORDER = 0xFF
_HASH_BITS = 20
#: Letters, digits and all bytes of longer characters; a short item may not begin or end inside a run of them.
_IN_WORD = np.array([chr(b).isalnum() if b < 128 else b != _BORDER for b in range(256)])


@dataclass(frozen=True)
class Settings:
    passage: int = 100
    stride: int = 20
    q: int = 12
    #: Edits allowed for each byte of a passage.
    edit_share: float = 0.05
    #: Shorter items are found without edits only, from q bytes on.
    min_passage: int = 40
    #: Items are sent to the tasks in blocks of about so many bytes, each block with a pass over the documents.
    block_bytes: int = 4 << 20

    def budget(self, m: int) -> int:
        """Edits allowed in m bytes, no more than leave a shared gram."""
        return min(math.floor(self.edit_share * m), (m - self.q) // self.q)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowered bytes with single spaces, a border before and after each text, and where the texts begin."""
    low = T._LOWER[data]
    gap = T._IS_SEPARATOR[low]
    low = np.where(gap, np.uint8(32), low)
    keep = np.ones(len(low), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    inner = offsets[1:-1]
    keep[inner[inner < len(keep)]] = True
    before = np.append(0, np.cumsum(keep))
    sizes = np.diff(before[offsets])
    starts = np.cumsum(sizes + 1) - sizes
    out = np.full(int(sizes.sum()) + len(sizes) + 1, _BORDER, np.uint8)
    out[T.ranges(starts, sizes)] = low[keep]
    return out, starts


class Index:
    """The passages of one block of items and where their grams stand."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.settings, s = settings, settings
        self.items, passages = [], []
        short: list[tuple[int, np.ndarray]] = []
        for item, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            whole = normalised(data, np.array([0, len(data)]))[0][1:-1]
            if len(whole) < s.min_passage:
                whole = np.frombuffer(whole.tobytes().strip(b" "), np.uint8)
                if len(whole) >= s.q:
                    short.append((item, whole))
                continue
            last = max(len(whole) - s.passage, 0)
            for at in sorted({*range(0, last, s.stride), last}):
                self.items.append(item)
                passages.append(whole[at : at + s.passage])
        # Short items follow the passages in `items`; of each length their hashes, sorted, and their numbers.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.short_text = {len(self.items) + i: whole for i, (_, whole) in enumerate(short)}
        self.items += [item for item, _ in short]
        for m in sorted({len(x) for x in self.short_text.values()}):
            numbers = np.array([i for i, x in self.short_text.items() if len(x) == m], np.int64)
            hashes = np.array([T.gram_hashes(T._BYTE_VALUES[self.short_text[i]], m)[0] for i in numbers], np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.short[m] = (hashes[order], numbers[order])
        self.sizes = np.array([len(p) for p in passages], np.int64)
        self.budgets = np.array([s.budget(len(p)) for p in passages], np.int64)
        self.needed = self.sizes - s.q + 1 - self.budgets * s.q
        self.passages = np.full((len(passages), s.passage), _BORDER, np.uint8)
        grams, owners, places = [np.zeros(0, np.uint64)], [], []
        for i, p in enumerate(passages):
            self.passages[i, : len(p)] = p
            h = T.gram_hashes(T._BYTE_VALUES[p], s.q)
            grams.append(h)
            owners += [i] * len(h)
            places += range(len(h))
        every = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.argsort(every, kind="stable")
        self.grams, first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.first = first
        self.owner = np.array(owners, np.int64)[order]
        self.place = np.array(places, np.int64)[order]
        self.present = np.zeros(1 << _HASH_BITS, bool)
        self.present[(self.grams >> np.uint64(64 - _HASH_BITS)).astype(np.int64)] = True

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, first diagonal) of the bands of the text with enough shared grams."""
        s = self.settings
        hashes = T.gram_hashes(T._BYTE_VALUES[text], s.q)
        at = np.flatnonzero(self.present[(hashes >> np.uint64(64 - _HASH_BITS)).astype(np.int64)])
        gram = np.minimum(np.searchsorted(self.grams, hashes[at]), max(len(self.grams) - 1, 0))
        same = self.grams[gram] == hashes[at]
        at, gram = at[same], gram[same]
        hit = T.ranges(self.first[gram], self.times[gram])
        owner = self.owner[hit]
        diagonal = np.repeat(at, self.times[gram]) - self.place[hit] + s.passage
        band = diagonal // self.half
        keys = np.concatenate([owner * self.far(text) + band, owner * self.far(text) + band - 1])
        keys, n = np.unique(keys, return_counts=True)
        passage, band = keys // self.far(text), keys % self.far(text)
        enough = n >= self.needed[passage]
        return passage[enough], band[enough] * self.half - s.passage

    @property
    def half(self) -> int:
        """Half the width of a band; no less than the reach of the edits, so bands overlap by as much."""
        return 2 * max(int(self.budgets.max(initial=0)), 1) + 1

    def far(self, text: np.ndarray) -> int:
        return (len(text) + 2 * self.settings.passage) // self.half + 2

    def align(self, text: np.ndarray, passage: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each passage against the text inside its band, and where that match ends."""
        reach = int(self.budgets.max(initial=0))
        width = 2 * self.half + 2 * reach
        low = low - reach
        column = np.arange(width)
        cost = np.zeros((len(passage), width), np.int32)
        found, ends = np.full(len(passage), 1 << 20), np.zeros(len(passage), np.int64)
        patterns, sizes = self.passages[passage], self.sizes[passage]
        for i in range(int(sizes.max(initial=0))):
            at = low[:, None] + i + column
            inside = (at >= 0) & (at < len(text))
            letters = np.where(inside, text[np.clip(at, 0, len(text) - 1)], _BORDER)
            changed = cost + ((letters != patterns[:, i : i + 1]) | (letters == _BORDER))
            changed[:, :-1] = np.minimum(changed[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(changed - column, axis=1) + column
            done = sizes == i + 1
            if done.any():
                found[done] = cost[done].min(axis=1)
                ends[done] = low[done] + i + 1 + cost[done].argmin(axis=1)
        return found, ends

    def exact(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number) of the short items that stand in the text between word borders."""
        out = [(np.zeros(0, np.int64),) * 2]
        in_word = _IN_WORD[text]
        for m, (hashes, numbers) in self.short.items():
            if len(text) < m + 2:
                continue
            # A border stands before and after all texts.
            grams = T.gram_hashes(T._BYTE_VALUES[text], m)
            at = 1 + np.flatnonzero(np.isin(grams[1:-1], hashes))
            at = at[~(in_word[at - 1] & in_word[at]) & ~(in_word[at + m - 1] & in_word[at + m])]
            low, high = (np.searchsorted(hashes, grams[at], side) for side in ("left", "right"))
            number = numbers[T.ranges(low, high - low)]
            at = np.repeat(at, high - low)
            same = [bool((text[a : a + m] == self.short_text[i]).all()) for a, i in zip(at.tolist(), number.tolist())]
            out.append((at[np.array(same, bool)], number[np.array(same, bool)]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def matches(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, passage, edits) of all verified regions in a column of texts."""
        t = column.cast(pa.large_binary()).to_pylist()
        offsets = np.append(0, np.cumsum([len(x or b"") for x in t])).astype(np.int64)
        text, starts = normalised(np.frombuffer(b"".join(x for x in t if x), np.uint8), offsets)
        if len(text) < self.settings.q:
            return (np.zeros(0, np.int64),) * 3
        place, number = self.exact(text)
        out = [(np.searchsorted(starts, place, side="right") - 1, number, np.zeros(len(place), np.int64))]
        passage, low = self.find(text) if len(self.sizes) else (np.zeros(0, np.int64),) * 2
        for at in range(0, len(passage), 4096):
            p, lo = passage[at : at + 4096], low[at : at + 4096]
            edits, ends = self.align(text, p, lo)
            good = edits <= self.budgets[p]
            # A match that ends on a border has its last byte before it.
            row = np.searchsorted(starts, ends[good] - 1, side="right") - 1
            out.append((row, p[good], edits[good]))
        return tuple(np.concatenate(x) for x in zip(*out))


def _blocks(benchmark: DataFrame, settings: Settings) -> list[list[tuple[int, str]]]:
    """The items in blocks of bounded size, each read on its own."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / settings.block_bytes))
    block = F.pmod(F.xxhash64("text"), F.lit(n))
    return [[tuple(r) for r in rows.filter(block == b).collect()] for b in range(n)]


def _leaks(items: list[tuple[int, str]], settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in T.chunks(batches, "text"):
            index = index or Index(items, settings)
            row, passage, edits = index.matches(batch.column("text"))
            best: dict[tuple[int, int | None], list] = {}
            for r, p, e in zip(row.tolist(), passage.tolist(), edits.tolist()):
                seen = best.setdefault((r, index.items[p]), [set(), e])
                seen[0].add(p)
                seen[1] = min(seen[1], e)
            keys = list(best)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array([r for r, _ in keys], pa.int64())),
                    pa.array([i for _, i in keys], pa.int64()),
                    pa.array([len(best[k][0]) for k in keys], pa.int64()),
                    pa.array([best[k][1] for k in keys], pa.int64()),
                ],
                ["doc_id", "item_id", "n_passages", "edits"],
            )

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, n_passages, edits): items found in each row of `docs` (doc_id, text).

    n_passages counts the item's passages found, edits is the least of their distances. Null and empty texts
    hold nothing; null texts of the benchmark (item_id, text) and items below q bytes are not looked for, items
    below `min_passage` bytes only as they are. Rows without doc_id and items without item_id are reported with null, repeated rows once
    each. Other columns are ignored; an empty table gives an empty result. Memory follows the longest text.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, n_passages long, edits long"
    found = [rows.mapInArrow(_leaks(items, settings), schema) for items in _blocks(benchmark, settings)]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _clean(items: list[tuple[int, str]], settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in T.chunks(batches, "text"):
            index = index or Index(items, settings)
            keep = np.ones(len(batch), bool)
            keep[index.matches(batch.column("text"))[0]] = False
            yield batch.filter(pa.array(keep))

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no item is found. Nothing is shuffled."""
    for items in _blocks(benchmark, settings):
        docs = docs.mapInArrow(_clean(items, settings), docs.schema)
    return docs
