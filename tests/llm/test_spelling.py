import random
import re
import zlib
from collections import Counter

import cases
import pytest

from txlake.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def counted(rows, min_chars, min_count, drop_every):
    seen = Counter()
    for i, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            draw = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and draw % drop_every == 0:
                run = run[: draw % len(run)] + run[draw % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_chars and n >= min_count}


def expected(rows, min_chars=5, min_count=3, drop_every=None):
    n = counted(rows, min_chars, min_count, drop_every)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if one_edit(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def misspelt(seed=1, n=60):
    """Chains of variants, doubled letters, letters beyond A-Z, words that share a half, ties."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéñÿ") for _ in range(rng.randint(4, 11))) for _ in range(25)] + ["aaaaaa", "baaaaab", "abababab"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(80):
            w = rng.choice(stems) if rng.random() < 0.7 else rng.choice(stems[:4])
            while rng.random() < 0.35:
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + rng.choice("abé") + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice("abé") + w[k + 1 :]]) or w
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1"]).join(words), None, None, None))
    return rows


@pytest.mark.parametrize("key_pairs", [spelling.KEY_PAIRS, 0])
def test_equals_brute_force(spark, key_pairs):
    """With no pair allowed to a key, every hole is halved to the end."""
    rows = misspelt() + cases.documents()
    df = cases.clashing(spark, rows)
    got = spelling.variant_groups(df, min_chars=4, drop_every=97, key_pairs=key_pairs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = expected(rows, 4, 3, 97)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert max(x[4] for x in want) > 5 and any(x[1] and x[1] != x[2] for x in want)


def test_each_pair_once(spark):
    """Doubled letters at the border of the halves, and all words that one pattern with a gap gives."""
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(5, 9))) for _ in range(300)}
    words |= {f"prefix{x}suffix" for x in "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõö"} | {"prefixsuffix", "x" * 3000, "x" * 3001, "y" + "x" * 3000}
    df = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    want = sorted(tuple(sorted((a, b))) for a in words for b in words if a < b and one_edit(a, b))
    for key_pairs in (10, 0, 10**9):
        got = [tuple(sorted((r["word"], r["near"]))) for r in spelling.near_pairs(df, key_pairs).collect()]
        assert sorted(got) == want


def test_many_words_of_one_half(spark):
    """What meets follows the near pairs, not the square of the words that begin alike."""
    rng = random.Random(3)
    words = {"beginning" + "".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(3000)}
    changed = ((w, w[:k] + c + w[k + 1 :]) for w in words for k in range(9, 18) for c in "abcdefghij")
    want = {(a, b) for a, b in changed if a < b and b in words}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = [tuple(sorted((r["word"], r["near"]))) for r in spelling.near_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_odd_tables(spark):
    assert spelling.variant_groups(cases.frame(spark, [])).count() == 0
    rows = [(None, None, None, None, None), (1, "", None, None, None), (2, "Other other OTHER othér othér othér two", None, None, None)]
    got = spelling.variant_groups(cases.frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == [("other", None, "other", 3, 1, None), ("othér", None, "othér", 3, 1, None)]
    with pytest.raises(ValueError):
        spelling.variant_groups(cases.frame(spark, rows), ratio=1)
