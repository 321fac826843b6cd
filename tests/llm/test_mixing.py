import re
from collections import Counter, defaultdict

import cases
from pyspark.sql import functions as F
import pytest

from txlake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Share out in rounds: the plain reading of the rule."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > most * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free -= set(over)
    return target


def check(rows, got, slack=1.0):
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    target = water(sizes)
    assert sorted(((r["id"], r["source"], r["size"]) for r in got), key=repr) == sorted(
        ((i, s, len(WORD.findall(t or ""))) for i, t, _, s, _ in rows), key=repr
    )
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= slack


def test_targets_and_taken(spark):
    rows = cases.documents()
    check(rows, mixing.taken_words(cases.clashing(spark, rows), block_words=16).collect())


def test_one_source_and_no_words(spark):
    rows = [(i, "a b c", None, "s", 0) for i in range(5)]
    check(rows, mixing.taken_words(cases.frame(spark, rows)).collect())
    rows = [(1, None, None, "s", 0), (2, "", None, None, 0)]
    got = mixing.taken_words(cases.frame(spark, rows)).collect()
    assert [(r["taken"], r["target"]) for r in got] == [(0, 0.0), (0, 0.0)]
    assert mixing.taken_words(cases.frame(spark, [])).count() == 0


def test_reruns_agree(spark):
    df = cases.frame(spark, cases.documents())
    one, two = (sorted(map(repr, mixing.taken_words(x).collect())) for x in (df, df.repartition(3)))
    assert one == two


def test_blocks_are_equal_and_in_order(spark):
    df = cases.frame(spark, cases.documents())
    units = mixing.units(df)
    goals = mixing.targets(units)
    mixed = mixing.mix(units, goals, 16).collect()
    filled = Counter()
    for r in mixed:
        filled[(r["nth"], r["rank"])] += r["n"]
        assert 0 <= r["first_word"] and r["first_word"] + r["n"] <= r["size"]
    need = {r["nth"]: r["goal"] for r in goals.collect()}
    for (nth, rank), n in filled.items():
        assert n == min(16, need[nth] - 16 * rank)
    # Along the schedule every source keeps its share: low discrepancy.
    slots = sorted({(r["slot"], r["nth"]) for r in mixed})
    total, seen, all_words = sum(need.values()), Counter(), len(slots)
    for k, (_, nth) in enumerate(slots, 1):
        seen[nth] += 1
        if k <= all_words * 0.9:
            assert abs(seen[nth] - k * need[nth] / total) < 8


def test_mixed_documents(spark):
    rows = cases.documents()
    df = cases.clashing(spark, rows)
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    taken = Counter()
    for r in mixing.taken_words(df).collect():
        taken[(r["id"], r["source"])] += -(-r["taken"] // max(1, r["size"]))
    count = Counter((r["doc_id"], r["source"]) for r in got.collect())
    for key, n in count.items():
        assert n >= taken[key] > 0
    assert set(count) == {k for k, n in taken.items() if n}


def test_column_of_the_copies_name_stays(spark):
    df = cases.frame(spark, cases.documents()).withColumn("mix_copy", F.lit("keep"))
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns and {r["mix_copy"] for r in got.select("mix_copy").collect()} == {"keep"}
