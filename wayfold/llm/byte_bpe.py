"""Byte-level BPE by recursive DuckDB queries inside each partition.

A text is split by the pattern into pieces, which are merged on their own. The distinct pieces of a chunk
of texts become rows of token ids; a recursive query unnests them into token positions, joins neighbours with
the merge table, takes each piece's pair of least rank, leftmost first, and replaces it, until no pair is
left. Ids are decoded by a join with the vocabulary and an aggregation in the order of positions.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import text as T

CHUNK_BYTES = 4 << 20
#: Pieces of a task whose ids are remembered; beyond it the memory is emptied.
REMEMBERED = 400_000
#: A round of the query merges one pair per piece, so pieces of more bytes are merged with a heap instead.
LONG_PIECE = 256
#: Pieces that are encoded at once, and tokens that are decoded at once; longer texts take several turns.
PIECES_AT_ONCE = 250_000
TOKENS_AT_ONCE = 250_000
PART_TOKENS = 50_000
#: New pieces that one query merges; it keeps every round's ids of all of them.
MERGED_AT_ONCE = 50_000
#: Characters of a text whose pieces are listed at once.
LISTED_CHARS = 1 << 20

MERGE = """
WITH RECURSIVE step(piece, ids) AS (
  SELECT piece, ids FROM pieces
  UNION ALL
  SELECT s.piece, s.ids[:place - 1] || [rank] || s.ids[place + 2:]
  FROM (
    SELECT piece, (min(best) >> 32)::INT AS rank, (min(best) & 4294967295)::INT AS place
    FROM (
      SELECT piece, (m.rank::BIGINT << 32) | place AS best
      FROM (
        SELECT piece, unnest(range(1, len(ids)))::INT AS place, (unnest(ids[:-2])::BIGINT << 32) | unnest(ids[2:]) AS pair
        FROM step
      ) AS position
      JOIN merges AS m USING (pair)
    )
    GROUP BY piece
  ) AS least JOIN step AS s USING (piece)
)
SELECT piece, arg_min(ids, len(ids)) AS ids FROM step GROUP BY piece ORDER BY piece
"""

DECODE = """
SELECT row, unhex(string_agg(hex, '' ORDER BY place)) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY row ORDER BY row
"""


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id and the pairs of tokens that make another token; bounded by the rank file."""

    pattern: str
    tokens: list[bytes]
    ids: np.ndarray
    merges: np.ndarray

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        pairs = (
            (ranks.get(t[:i], -1), ranks.get(t[i:], -1), rank) for t, rank in ranks.items() for i in range(1, len(t))
        )
        merges = np.array([p for p in pairs if p[0] >= 0 <= p[1]], np.int32).reshape(-1, 3)
        return Vocabulary(pattern, list(ranks), np.array(list(ranks.values()), np.int32), merges)


class Coder:
    """Encodes and decodes inside one task, with one DuckDB connection."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self._pattern = regex.compile(v.pattern)
        self._rank = dict(zip(v.tokens, v.ids.tolist()))
        self._tokens, self._token_ids = pa.array(v.tokens, pa.binary()), v.ids
        self._byte = np.array([self._rank.get(bytes([b]), -1) for b in range(256)], np.int32)
        self._con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        left, right, rank = v.merges.astype(np.int64).T
        self._keep("merges", pa.table({"pair": (left << 32) | right, "rank": rank}))
        self._keep("vocabulary", pa.table({"id": pa.array(v.ids), "hex": [t.hex() for t in v.tokens]}))
        self._forget()

    def _keep(self, name: str, table: pa.Table) -> None:
        self._con.register("given", table)
        self._con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self._con.unregister("given")

    def _ask(self, name: str, table: pa.Table, sql: str) -> pa.Table:
        self._con.register(name, table)
        try:
            return self._con.sql(sql).to_arrow_table()
        finally:
            self._con.unregister(name)

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        self._ids = np.zeros(0, np.int32)
        self._sizes = np.zeros(0, np.int64)

    def _long(self, piece: bytes) -> list[int]:
        """The same merges with a heap of pairs, for pieces that would take too many rounds."""
        ids = self._byte[np.frombuffer(piece, np.uint8)].tolist()
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(parts):
                both = parts[i] + parts[after[i]]
                if both in self._rank:
                    heapq.heappush(heap, (self._rank[both], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            rank, i, both = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != both:
                continue
            ids[i], parts[i], parts[j], after[i] = rank, both, None, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x, p in zip(ids, parts) if p is not None]

    def _learn(self, pieces: list[str]) -> None:
        new = list(set(pieces).difference(self._number))
        if not new:
            return
        data = pa.array(new, pa.string()).cast(pa.binary())
        token = pc.index_in(data, self._tokens).fill_null(-1).to_numpy(zero_copy_only=False)
        is_long = (token < 0) & (T._lengths(data) > LONG_PIECE)
        whole, long, merged = (np.flatnonzero(x) for x in (token >= 0, is_long, (token < 0) & ~is_long))
        by_heap = [self._long(data[i].as_py()) for i in long.tolist()]
        out = self._merge(data.take(pa.array(merged)))
        number = range(len(self._sizes), len(self._sizes) + len(new))
        self._number.update(zip((new[i] for g in (whole, long, merged) for i in g.tolist()), number))
        sizes = pc.list_value_length(out).to_numpy(zero_copy_only=False)
        self._sizes = np.concatenate([self._sizes, np.ones(len(whole), np.int64), np.array([len(x) for x in by_heap], np.int64), sizes])
        heap_ids = np.array([x for ids in by_heap for x in ids], np.int32)
        self._ids = np.concatenate([self._ids, self._token_ids[token[whole]], heap_ids, out.flatten().to_numpy(zero_copy_only=False)])

    def _merge(self, data: pa.Array) -> pa.Array:
        """Token ids of pieces by the recursive query, a part of them at a time."""
        parts = [self._merge_part(data.slice(at, MERGED_AT_ONCE)) for at in range(0, len(data), MERGED_AT_ONCE)]
        return pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *parts])

    def _merge_part(self, data: pa.Array) -> pa.Array:
        flat = self._byte[np.frombuffer(b"".join(data.to_pylist()), np.uint8)]
        ends = np.append(0, np.cumsum(T._lengths(data)))
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        table = pa.table({"piece": pa.array(np.arange(len(data), dtype=np.int32)), "ids": ids})
        return self._ask("pieces", table, MERGE)["ids"].combine_chunks().cast(pa.list_(pa.int32()))

    def _pieces(self, texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
        """The texts' pieces in parts of about PIECES_AT_ONCE, each with how many are of which text."""
        part, counts = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t and len(t) > LISTED_CHARS:
                matches = self._pattern.finditer(t)
                found = iter(lambda: [m.group() for m in islice(matches, PIECES_AT_ONCE)], [])
            else:
                found = [self._pattern.findall(t)] if t else []
            for some in found:
                part += some
                counts[i] += len(some)
                if len(part) >= PIECES_AT_ONCE:
                    yield part, counts
                    part, counts = [], np.zeros(len(texts), np.int64)
        yield part, counts

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        ids, totals = [], np.zeros(len(texts), np.int64)
        for pieces, counts in self._pieces(texts):
            if len(self._number) > REMEMBERED:
                self._forget()
            self._learn(pieces)
            number = np.fromiter(map(self._number.__getitem__, pieces), np.int64, len(pieces))
            sizes = self._sizes[number]
            starts = np.cumsum(self._sizes) - self._sizes
            ids.append(self._ids[T.ranges(starts[number], sizes)])
            ends = np.append(0, np.cumsum(sizes))
            text_ends = np.cumsum(counts)
            totals += ends[text_ends] - ends[text_ends - counts]
        offsets = pa.array(np.append(0, np.cumsum(totals)), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Bytes of each row; an id outside the vocabulary is an error, null counts as no ids."""
        sizes = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = ids.flatten().cast(pa.int32())
        unknown = pc.invert(pc.is_in(pc.unique(flat), pa.array(list(self._rank.values()), pa.int32())))
        if pc.any(unknown).as_py():
            raise ValueError("token ids outside the vocabulary")
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        lengths, data = np.zeros(len(ids), np.int64), []
        for at in range(0, len(flat), TOKENS_AT_ONCE):
            part = slice(at, at + TOKENS_AT_ONCE)
            # A row is decoded in parts of its own where it is long, so that no string holds a whole long text.
            rows = owner[part].astype(np.int64) << 32 | np.arange(len(owner[part])) // PART_TOKENS
            tokens = pa.table({"row": rows, "place": np.arange(len(rows), dtype=np.int32), "id": flat[part]})
            out = self._ask("tokens", tokens, DECODE)
            some = out["bytes"].combine_chunks().cast(pa.binary())
            np.add.at(lengths, out["row"].to_numpy() >> 32, T._lengths(some))
            data.append(T._bytes(some)[0].tobytes())
        ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(data))])


def _encoded(vocabulary: Vocabulary, and_decode: bool):
    names = ["doc_id", "ids", "decoded"][: 3 if and_decode else 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in T.chunks(batches, "text", CHUNK_BYTES):
            coder = coder or Coder(vocabulary)
            ids = coder.encode(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), ids] + ([coder.decode(ids)] if and_decode else [])
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _decoded(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or Coder(vocabulary)
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), coder.decode(part.column("ids"))], ["doc_id", "decoded"]
                )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids) for each row of `docs` (doc_id, text).

    Null and empty texts have no ids. Rows without doc_id and repeated rows are encoded like any other. Other
    columns are ignored; an empty table gives an empty result. A text of any length is encoded in parts; besides
    these a task holds the longest text, its ids and its bytes.
    """
    return _texts(docs).mapInArrow(_encoded(vocabulary, False), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, decoded bytes) for each row of `encoded` (doc_id, ids). Null ids give no bytes."""
    rows = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(_decoded(vocabulary), "doc_id long, decoded binary")


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, decoded): `encode`, and `decode` of its ids in the same task."""
    return _texts(docs).mapInArrow(_encoded(vocabulary, True), "doc_id long, ids array<int>, decoded binary")
