import time
from collections import defaultdict

import cases

from txlake.llm.line_dedup import drop_repeated_lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    holders, first = defaultdict(set), {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            holders[key].add((i, text or ""))
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        keys = [x.strip(SPACE).translate(LOWER) for x in lines]
        gone = [len(k) >= 10 and len(holders[k]) >= 2 and k in first and first[k] != i for k in keys]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rows = cases.documents()
    got = drop_repeated_lines(cases.frame(spark, rows)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_other_columns_stay(spark):
    rows = cases.documents()
    df = cases.clashing(spark, rows)
    got = drop_repeated_lines(df)
    assert got.columns == [*df.columns, "n_lines_", "n_dropped_"]
    assert {r["n_lines"] for r in got.select("n_lines").collect()} == {"keep"}
    assert sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines_", "n_dropped_").collect()), key=repr) == expected(rows)


def test_very_many_lines(spark):
    """200,000 lines, of which some go: the text is split once, not once per line."""
    lines = [f"a line of its own, number {k}" for k in range(200_000)]
    rows = [(1, "a line that both of them hold\nx", None, None, None), (2, "\n".join([*lines, "a line that both of them hold", "end"]), None, None, None)]
    began = time.monotonic()
    got = {r["doc_id"]: r for r in drop_repeated_lines(cases.frame(spark, rows)).collect()}
    assert got[2]["text"] == "\n".join([*lines, "end"]) and got[2]["n_dropped"] == 1
    assert time.monotonic() - began < 60


def test_empty_table(spark):
    assert drop_repeated_lines(cases.frame(spark, [])).count() == 0


def test_threshold(spark):
    rows = [(i, "a line that three hold\nown line number %d" % i, None, None, None) for i in range(3)]
    got = drop_repeated_lines(cases.frame(spark, rows), min_documents=4)
    assert {r["n_dropped"] for r in got.collect()} == {0}
