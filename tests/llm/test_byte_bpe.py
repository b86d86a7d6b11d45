"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from wayfold.llm import byte_bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.read(PATH, P.PATTERN)


def test_query_equals_library(spark, small, library):
    from wayfold.llm.queries import op10_byte_bpe

    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        expected[r.doc_id] = (len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode()))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op10_byte_bpe(spark, small).collect()}
    assert got == expected


def test_odd_texts(spark, library, vocabulary):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\n \t x", "a" * 3000, "=" * 700 + " " * 300, "ab" * 400, "日本語" * 200, "\U0001f600 don't 12345 ÄÖ\x00<|endoftext|>"]
    texts += ["".join(rng.choice("ab é日 \n'st1!") for _ in range(rng.randrange(400))) for _ in range(100)]
    texts += ["".join(rng.choice("aet") for _ in range(rng.randrange(200, 600))) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "x"), (3, "x")], "doc_id long, text string")
    docs = docs.withColumn("ids", F.lit("clash"))
    got = byte_bpe.round_trip(docs, vocabulary).collect()
    expected = sorted((i if i is not None else -1, library.encode_ordinary(t or "")) for i, t in [*enumerate(texts), (None, "x"), (3, "x")])
    assert sorted((r.doc_id if r.doc_id is not None else -1, list(r.ids)) for r in got) == expected
    assert all(bytes(r.decoded) == library.decode_bytes(r.ids) for r in got)
    again = byte_bpe.decode(byte_bpe.encode(docs, vocabulary), vocabulary).collect()
    assert sorted(bytes(r.decoded) for r in again) == sorted(bytes(r.decoded) for r in got)


def test_remembered_pieces_are_dropped(library, vocabulary, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    coder = byte_bpe.Coder(vocabulary)
    for text in ["one two three four", "five six seven", "one seven eight nine"] * 3:
        assert coder.encode([text]).to_pylist() == [library.encode_ordinary(text)]


def test_parts_of_any_size_give_the_same_ids(library, vocabulary, monkeypatch):
    for name in ("PIECES_AT_ONCE", "TOKENS_AT_ONCE", "PART_TOKENS", "LISTED_CHARS"):
        monkeypatch.setattr(byte_bpe, name, 7)
    texts = ["one two  three", None, "", "日本語 " * 30, "a b c d e f g h i j k l", "", "don't " * 40 + "x" * 300]
    coder = byte_bpe.Coder(vocabulary)
    ids = coder.encode(texts)
    assert ids.to_pylist() == [library.encode_ordinary(t or "") for t in texts]
    assert coder.decode(ids).to_pylist() == [(t or "").encode() for t in texts]
    assert coder.decode(ids.slice(2, 3)).to_pylist() == [(t or "").encode() for t in texts[2:5]]


def test_a_text_of_64_megabytes(library, vocabulary):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeiou") for _ in range(rng.randrange(1, 9))) for _ in range(50_000)]
    block = " ".join(words)
    text = block * (1 + (64 << 20) // len(block))
    coder = byte_bpe.Coder(vocabulary)
    ids = coder.encode(["x", text, None])
    head = len(block) * 2 // 3
    first = library.encode_ordinary(text[:head])[:-5]
    assert ids[1].values[: len(first)].to_pylist() == first
    decoded = coder.decode(ids)
    assert len(text) >= 64 << 20 and decoded.to_pylist() == [b"x", text.encode(), b""]


def test_empty_and_unknown(spark, vocabulary):
    assert byte_bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), vocabulary).count() == 0
    with pytest.raises(ValueError):
        import pyarrow as pa

        byte_bpe.Coder(vocabulary).decode(pa.array([[1, 999_999]], pa.list_(pa.int32())))


def test_queries_get_bounded_parts(library, vocabulary, monkeypatch):
    """However many new pieces and tokens a chunk has, a query sees a part of them."""
    coder = byte_bpe.Coder(vocabulary)
    seen = {"pieces": [], "tokens": []}
    ask = coder._ask
    monkeypatch.setattr(coder, "_ask", lambda name, table, sql: (seen[name].append(len(table)), ask(name, table, sql))[1])
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("qxzjkv", k=7)) for _ in range(90_000))
    ids = coder.encode([text])
    assert ids.to_pylist() == [library.encode_ordinary(text)]
    assert coder.decode(ids).to_pylist() == [text.encode()]
    assert max(seen["pieces"]) <= 50_000 and max(seen["tokens"]) <= 250_000
