"""Merged daily sketches against exact figures, and offset ranges of a log."""

import random

import pytest
from pyspark.sql import functions as F

from txlake.operators import sketches
from txlake.schemas import LOG_SCHEMA
from txlake.sources import topics

TX = "tx_time_days long, customer_id long, tx_amount double, tx_fraud int"


def test_error_bounds(spark):
    """Every range of days: exact counts, quantiles within 2% of the ranks, distinct cards within 8%."""
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, rng.randrange(9000)]), rng.choice([None, rng.lognormvariate(3, 1)]), rng.choice([0, 0, 1, None])) for _ in range(30_000)]
    daily = sketches.daily_sketches(spark.createDataFrame(rows, TX)).cache()
    assert daily.count() == 12
    spans = [(a, b) for a in range(12) for b in range(a, 12, 3)]
    out = sketches.merged_ranges(daily, spark.createDataFrame(spans, "first long, last long")).collect()
    assert len(out) == len(spans)
    for r in out:
        inside = [x for x in rows if x[0] is not None and r["first"] <= x[0] <= r["last"]]
        assert (r.n, r.frauds) == (len(inside), sum(x[3] or 0 for x in inside))
        amounts = sorted(x[2] for x in inside if x[2] is not None)
        for q in (25, 50, 75):
            rank = sum(a <= r[f"p{q}"] for a in amounts) / len(amounts)
            assert abs(rank - q / 100) < 0.02
        cards = {x[1] for x in inside} - {None}
        bad = {x[1] for x in inside if x[3] == 1} - {None}
        assert abs(r.cards - len(cards)) <= 0.08 * len(cards) and abs(r.bad_cards - len(bad)) <= 0.08 * len(bad)


def test_days_without_values_and_ranges_without_days(spark):
    daily = sketches.daily_sketches(spark.createDataFrame([(3, None, None, None)], TX))
    out = sketches.merged_ranges(daily, spark.createDataFrame([(1, 5), (7, 9)], "first long, last long")).collect()
    assert [tuple(r) for r in out] == [(1, 5, 1, 0, None, None, None, 0, 0)]
    empty = sketches.daily_sketches(spark.createDataFrame([], TX))
    assert sketches.merged_ranges(empty, spark.createDataFrame([(1, 5)], "first long, last long")).count() == 0


def test_ranges_do_not_read_transactions(spark, tmp_path):
    tx = spark.createDataFrame([(d, c, 1.0 * c, 0) for d in range(5) for c in range(50)], TX)
    sketches.daily_sketches(tx).write.parquet(f"{tmp_path}/daily")
    daily = spark.read.parquet(f"{tmp_path}/daily")
    plan = sketches.merged_ranges(daily, spark.createDataFrame([(0, 4)], "first long, last long"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and str(tmp_path / "daily")[:20] in plan


def log(spark):
    rows = [(None, b"x", "t", p, o, None) for p in range(3) for o in range(10, 20 + p)]
    return spark.createDataFrame(rows, LOG_SCHEMA)


@pytest.mark.parametrize(
    ("start", "end", "want"),
    [
        ({0: topics.EARLIEST, 1: topics.EARLIEST, 2: topics.EARLIEST}, {}, {0: (10, 20), 1: (10, 21), 2: (10, 22)}),
        ({0: 12, 2: 21}, {0: 15}, {0: (12, 15), 2: (21, 22)}),
        ({0: 12, 1: 11}, {0: 12, 1: topics.LATEST}, {1: (11, 21)}),
        ({7: 0}, {}, {}),
    ],
)
def test_offset_ranges(spark, start, end, want):
    got = topics.between_offsets(log(spark), start, end).select("partition", "offset").collect()
    assert sorted(tuple(r) for r in got) == [(p, o) for p, (a, b) in sorted(want.items()) for o in range(a, b)]


def test_reading_goes_on_at_the_ends(spark, tmp_path):
    """What a first read has seen is not seen again by the next one, whatever was added in between."""
    path = str(tmp_path / "log")
    log(spark).where("offset < 16").write.parquet(path)
    every = {p: topics.EARLIEST for p in range(3)}
    first = topics.read_log_files(spark, path)
    ends = topics.next_offsets(first)
    assert ends == {0: 16, 1: 16, 2: 16}
    one = topics.between_offsets(first, every, ends).select("partition", "offset").collect()
    log(spark).where("offset >= 16").write.mode("append").parquet(path)
    again = topics.between_offsets(topics.read_log_files(spark, path), ends)
    two = again.select("partition", "offset").collect()
    assert sorted(map(tuple, one + two)) == sorted(map(tuple, log(spark).select("partition", "offset").collect()))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,16)" in plan
    assert topics.next_offsets(first.where(F.lit(False))) == {}
