"""SentencePiece encoding and decoding through a table of distinct chunks.

The pieces of the model hold white-space markers only at their beginning, so none crosses the place
where a marker follows another character. A marked text falls into chunks there (markers, then all up
to the next marker); merges in one chunk do not touch another, and each distinct chunk is segmented
once. The ids of a text are its chunks' ids in the order of their positions.

A task looks at a block of texts at a time: it lists the chunks its table does not hold yet, segments
those, and joins the ids back. The table is emptied when it has grown over ``TABLE_CHUNKS`` entries, so
memory is bounded whatever the vocabulary; that costs time only. No shuffle, nothing is sent to the
driver; the model file goes to the tasks as bytes.
"""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.llm.common import text_of

MARK = "▁"
TABLE_CHUNKS = 200_000
BLOCK_CHUNKS = 100_000
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class Codec:
    """A model with its chunk table, one per worker process."""

    _loaded: dict[int, Codec] = {}

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.table: dict[str, bytes] = {}
        self.begin = np.array([self.model.bos_id()], dtype="<u4").tobytes()
        self.end = np.array([self.model.eos_id()], dtype="<u4").tobytes()

    @classmethod
    def of(cls, model: bytes) -> Codec:
        key = hash(model)
        if key not in cls._loaded:
            cls._loaded[key] = cls(model)
        return cls._loaded[key]

    def segment(self, chunks: list[str]) -> None:
        """Add chunks to the table. The library puts one marker in front of what it gets, but not of
        an empty string: a chunk of one marker alone is looked up as a piece."""
        ids = self.model.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        for chunk, found in zip(chunks, ids):
            if chunk == MARK:
                found = [self.model.piece_to_id(MARK)]
            self.table[chunk] = np.array(found, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        block: list[list[str]] = []
        held = 0
        for text in texts:
            block.append(CHUNK.findall(MARK + text.replace(" ", MARK)) if text else [])
            held += len(block[-1])
            if held >= BLOCK_CHUNKS:
                out += self._join(block)
                block, held = [], 0
        return out + self._join(block)

    def _join(self, block: list[list[str]]) -> list[bytes]:
        """The ids of the texts of a block, given as lists of chunks."""
        distinct = set().union(*block)
        new = [c for c in distinct if c not in self.table]
        if len(self.table) + len(new) > TABLE_CHUNKS:
            self.table.clear()
            new = list(distinct)
        self.segment(new)
        return [b"".join([self.begin, *map(self.table.__getitem__, chunks), self.end]) for chunks in block]

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, dtype="<u4").tolist())


def check_model(model: bytes) -> None:
    """Raise if pieces of the model can cross a white-space marker."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_proto=model)
    if any(MARK in m.id_to_piece(i).lstrip(MARK) for i in range(m.vocab_size())):
        raise ValueError("the model has pieces with a marker inside or at the end; chunks would not be independent")


def read_model(path: str) -> bytes:
    """The model file, read on the driver."""
    model = Path(path).read_bytes()
    check_model(model)
    return model


def encode(text: Column, model: bytes) -> Column:
    """The ids of a text between the begin and end ids, as little-endian unsigned 32-bit integers.

    Null is an empty text, which has the two outer ids only.
    """

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(Codec.of(model).encode(texts.tolist()))

    return ids(text_of(text))


def decode(ids: Column, model: bytes) -> Column:
    """The text of ids as ``encode`` gives them; null for null."""

    @F.pandas_udf("string")
    def texts(batch: pd.Series) -> pd.Series:
        codec = Codec.of(model)
        return pd.Series([None if x is None else codec.decode(x) for x in batch], dtype=object)

    return texts(ids)


def round_trip(text: Column, model: bytes) -> Column:
    """(ids, text): the ids as ``encode`` gives them and what ``decode`` makes of these ids, in one pass
    through one worker."""

    @F.pandas_udf("ids binary, text string")
    def both(texts: pd.Series) -> pd.DataFrame:
        codec = Codec.of(model)
        ids = codec.encode(texts.tolist())
        return pd.DataFrame({"ids": ids, "text": [codec.decode(x) for x in ids]}, dtype=object)

    return both(text_of(text))


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def end_id(model: bytes) -> int:
    """The id that ``encode`` puts last, found nowhere else."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model).eos_id()
