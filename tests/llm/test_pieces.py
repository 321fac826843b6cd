import cases
import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from txlake.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "a\tb\nc", "ﬁ Å ﬂ①", "▁a ▁▁", "a　b c", "<s> x </s>", "\x00a\x00", "\U0001f600 \U0001f1e9\U0001f1ea", "a" * 5000, " " * 3000 + "x"]


def test_equals_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = cases.documents() + [(500 + i, t, None, None, None) for i, t in enumerate(ODD)]
    model = pieces.read_model(PATH)
    df = cases.frame(spark, rows).select("doc_id", "text", pieces.encode(F.col("text"), model).alias("ids"))
    both = cases.frame(spark, rows).select(pieces.round_trip(F.col("text"), model).alias("r")).select("r.*").collect()
    got = df.select("*", pieces.n_ids(F.col("ids")).alias("n"), pieces.decode(F.col("ids"), model).alias("back")).collect()
    assert len(got) == len(rows)
    assert sorted((bytes(r["ids"]), r["text"]) for r in both) == sorted((bytes(r["ids"]), r["back"]) for r in got)
    for r in got:
        ids = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["n"] == len(ids)
        assert r["back"] == lib.decode(ids)


def test_small_table(monkeypatch):
    model = open(PATH, "rb").read()
    codec, lib = pieces.Codec(model), sentencepiece.SentencePieceProcessor(model_file=PATH)
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 5)
    monkeypatch.setattr(pieces, "BLOCK_CHUNKS", 3)
    texts = [r[1] or "" for r in cases.documents()[:20]]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [lib.encode(t, add_bos=True, add_eos=True) for t in texts]
