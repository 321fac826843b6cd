import hashlib
import random
import re

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from txlake.llm import fill_middle as fim

UNITS = {"line": r"[^\n]*\n|[^\n]+", "character": r"(?s).", "word": r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"}


def expected(key, text, unit="line", rate=100, spm_rate=50, seed=7):
    text = text or ""
    found = re.findall(UNITS[unit], text)
    n = len(found)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(found[:a]), "".join(found[a:b]), "".join(found[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows():
    rng = random.Random(4)
    parts = ["a", "b c", "\n", " ", "\r", "\t", "é", "\U0001f600", "<", "<P", "<S>", ">", "M>", "S>", "\x0b", "\x85", "\xa0"]
    soup = [(2000 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 20))), None, None, None) for i in range(1500)]
    # Very many lines, and one line that is longer than a block.
    return cases.documents() + soup + [(5000, "a\n" * 300_000, None, None, None), (5001, "x" * 5_000_000, None, None, None), (-5, "minus\none", None, None, None)]


@pytest.mark.parametrize("recipe", [fim.Recipe(), fim.Recipe("word", 3, 60, 20), fim.Recipe("character", 7, 100, 0)])
def test_equals_brute_force(spark, recipe):
    some = rows()
    made = cases.clashing(spark, some).select("doc_id", "text", fim.fill_in_middle(F.col("doc_id"), F.col("text"), recipe).alias("r")).select("doc_id", "text", "r.*")
    got = made.select("*", fim.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(got) == len(some)
    for r in got:
        want = expected(r["doc_id"], r["text"], recipe.unit, recipe.rate, recipe.spm_rate, recipe.seed)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["back"] == (r["text"] or "")


def test_ranks():
    rng = np.random.default_rng(2)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        matrix = fim.WaveletMatrix(symbols, 3)
        at = np.arange(size + 1)
        for s in range(8):
            assert matrix.rank(s, at).tolist() == [0, *np.cumsum(symbols == s).tolist()]


def test_small_blocks(monkeypatch):
    some = rows()[:400]
    keys, texts = ["" if r[0] is None else str(r[0]) for r in some], [r[1] or "" for r in some]
    monkeypatch.setattr(fim, "BLOCK_CHARS", 50)
    got = [x for part in fim.blocks(keys, texts) for x in fim.transform_block(*part, fim.Recipe())]
    assert got == [expected(k, t) for k, t in zip(keys, texts)]


def test_wrong_forms_and_units():
    for output, form in (("abc", "psm"), ("<P>a", "psm"), ("<S>a<P>b", "spm")):
        with pytest.raises(ValueError):
            fim.restored(output, form)
    with pytest.raises(ValueError):
        fim.Boundaries(["a"], "verse")


def test_empty_table_and_nulls(spark):
    df = cases.frame(spark, [])
    assert df.select(fim.fill_in_middle(F.col("doc_id"), F.col("text"))).count() == 0
    assert spark.range(1).select(fim.restore(F.lit(None).cast("string"), F.lit("psm")).alias("t")).first()["t"] is None
