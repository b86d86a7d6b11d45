"""Words, hashes and windows of many texts at once, as numpy arrays inside a task."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

# The bytes that separate words (space, tab to carriage return).
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"

CHUNK_BYTES = 2 << 20

_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_WORD_BASE = 0x9E3779B97F4A7C15
_GRAM_BASE = 0xD1342543DE82EF95
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self._base, self._inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (self._run(b, n) for b in (self._base, self._inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)


_WORD_POWERS, _GRAM_POWERS = Powers(_WORD_BASE), Powers(_GRAM_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each hold about `size` bytes; a longer text stays whole, alone."""
    for batch in batches:
        offsets = np.append(0, np.cumsum(_lengths(batch.column(column))))
        at = 0
        while at < len(batch):
            end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            end = min(max(end, at + 1), len(batch))
            yield batch.slice(at, end - at)
            at = end


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each begins, without a copy; a null has none."""
    a = texts.cast(pa.large_binary())
    if a.null_count:
        a = pa.compute.fill_null(a, b"")
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = a.buffers()
    offsets = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def _lengths(texts: pa.Array) -> np.ndarray:
    return np.diff(_bytes(texts)[1])


class Texts:
    """The bytes of a column of texts and where its words lie. A null text has no words."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.bytes, self.offsets = _bytes(column)
        if lower:
            self.bytes = _LOWER[self.bytes]
        self.data = self.bytes.tobytes()
        inside = np.ones(len(self.bytes) + 2, bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = ~_IS_SEPARATOR[self.bytes]
        begins = inside[1:] & ~inside[:-1]
        ends = inside[:-1] & ~inside[1:]
        # A text's end also ends its last word.
        inner = self.offsets[1:-1]
        joint = inner[inside[inner] & inside[inner + 1]] if len(inner) else inner
        begins[joint] = ends[joint] = True
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends)
        #: Number of the first word of each text, and the number of all words at the end.
        self.first = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def _sums(self) -> np.ndarray:
        sums = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.bytes] * _WORD_POWERS.upto(len(self.bytes))[0], out=sums[1:])
        return sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes from each start to its end."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        return mix((self._sums[ends] - self._sums[starts]) * _WORD_POWERS.upto(len(self.bytes))[1][starts])

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; grams run over text borders."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = _GRAM_POWERS.upto(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of start, start+1, ... of each count."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)
