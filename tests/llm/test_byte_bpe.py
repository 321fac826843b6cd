import random

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from txlake.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Letters of late versions of Unicode, odd spaces, combining marks, contractions, strings of special tokens.
PARTS = ["a", "b", "é", "the", " ", "\n", "  ", "東京", "한국", "\U0001f600", "'s", "'LL", "12", "३", "ſ", "՘", "࢏", "꟝", "\x00", "\x1c", "\x85", "\xa0", "İ", "ing", "tion", "́", "<|endoftext|>"]


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.read_vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = byte_bpe.Codec.of(vocabulary).machine.ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def soup(rng):
    def some():
        return rng.choice(PARTS) if rng.random() < 0.7 else chr(rng.choice([rng.randrange(0x20, 0x17F), rng.randrange(0x400, 0xD7FF), rng.randrange(0xE000, 0x110000)]))

    return "".join(some() for _ in range(rng.randint(0, 25)))


def test_equals_the_library(spark, vocabulary, library):
    rng = random.Random(5)
    rows = cases.documents() + [(1000 + i, soup(rng), None, None, None) for i in range(3000)]
    df = cases.clashing(spark, rows)
    both = df.select("doc_id", "text", byte_bpe.round_trip(F.col("text"), vocabulary).alias("r")).select("doc_id", "text", "r.ids", F.col("r.text").alias("back")).collect()
    assert len(both) == len(rows)
    for r in both:
        assert r["ids"] == library.encode_ordinary(r["text"] or "")
        assert r["back"] == (r["text"] or "")
    apart = df.select("text", byte_bpe.encode(F.col("text"), vocabulary).alias("ids")).select("text", "ids", byte_bpe.decode(F.col("ids"), vocabulary).alias("back"), byte_bpe.decimal_ids(F.col("ids")).alias("d")).collect()
    assert sorted((r["text"] or "", r["ids"], r["back"]) for r in apart) == sorted((r["text"] or "", r["ids"], r["back"]) for r in both)
    assert all(r["d"] == ",".join(map(str, r["ids"])) for r in apart)


def test_long_pieces(vocabulary, library):
    rng = random.Random(6)
    codec = byte_bpe.Codec(vocabulary)
    for text in ("a" * 100_000, "aaab" * 20_000, " " * 50_000 + "x", "é" * 30_000, "".join(rng.choice("abcdeé") for _ in range(100_000)), "word " * 300_000):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_small_tables(monkeypatch, vocabulary, library):
    for name, size in (("MAX_STATES", 7), ("MAX_PAIRS", 5), ("MAX_PIECES", 3), ("LONG_PIECE", 4), ("BLOCK", 3), ("LONG_TEXT", 100)):
        monkeypatch.setattr(byte_bpe, name, size)
    rng = random.Random(7)
    codec = byte_bpe.Codec(vocabulary)
    for text in [r[1] or "" for r in cases.documents()[:20]] + [soup(rng) for _ in range(200)]:
        ids = codec.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text
    assert len(codec.machine.guesses) <= 7 and len(codec.pieces) <= 3


def test_bounded_lookahead(vocabulary):
    """However long a piece, few tokens wait and few guesses are alive."""
    rng = random.Random(8)
    machine = byte_bpe.Codec(vocabulary).machine
    for text in ("a" * 5000, "".join(rng.choice("abcdefghij") for _ in range(20_000))):
        machine.encode(text.encode())
    longest = max(map(len, machine.ranks))
    assert max(map(len, machine.guesses)) <= longest
    waiting = (machine.trails.tokens(g >> byte_bpe.NODE_BITS)[1] for state in machine.guesses for g in state)
    assert max(map(len, waiting)) <= 2 * longest


def test_decoding_of_any_bytes(vocabulary, library):
    rng = random.Random(9)
    codec = byte_bpe.Codec(vocabulary)
    for _ in range(2000):
        ids = [rng.randrange(50_256) for _ in range(rng.randint(0, 12))]
        assert codec.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, errors="replace")
    odd = [0xE0, 0xED, 0xF0, 0xF4, 0xC2, 0x80, 0x9F, 0xA0, 0xBF, 0x41, 0xFF, 0xF5, 0xC0, 0xE1, 0x90, 0x8F]
    for k in range(5000):
        data = bytes(rng.choice(odd) for _ in range(rng.randint(0, 9)))
        stream, step = byte_bpe.Utf8Stream(), 1 + k % 3
        assert "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.close() == data.decode("utf-8", "replace")


def test_empty_table_and_nulls(spark, vocabulary):
    assert cases.frame(spark, []).select(byte_bpe.encode(F.col("text"), vocabulary)).count() == 0
    row = spark.range(1).select(byte_bpe.encode(F.lit(None), vocabulary).alias("ids"), byte_bpe.decode(F.lit(None).cast("array<int>"), vocabulary).alias("text")).first()
    assert (row["ids"], row["text"]) == ([], None)


def test_vocabulary_without_a_byte():
    with pytest.raises(ValueError):
        byte_bpe.Transducer({b"a": 0, b"b": 1})
