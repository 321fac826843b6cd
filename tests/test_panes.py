"""Daily panes against the rolling windows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txlake.operators import panes
from txlake.operators.rolling import customer_rolling_features, terminal_risk_features
from txlake.plans import catalog, views
from txlake.schemas import CUSTOMER_FEATURES, TERMINAL_FEATURES

TX = "tx_id long, tx_datetime timestamp, customer_id long, terminal_id long, tx_amount decimal(10,2), tx_fraud int"


def transactions(spark, seed=1, n=600):
    """Nulls everywhere, ties, midnights and moments exactly a window apart."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(60), hours=rng.choice([0, 0, 12, 23]), microseconds=rng.choice([0, 0, 1, 999_999]))
        rows.append((i, rng.choice([at] * 30 + [None]), rng.choice([1, 1, 1, 2, 3, None]), rng.choice([7, 8, None]),
                     rng.choice([Decimal("1.25"), Decimal("99.99"), None]), rng.choice([0, 0, 1, None])))
    return spark.createDataFrame(rows, TX)


def both(tx, customers, terminals):
    return panes.customer_features(tx, customers, tx), panes.terminal_features(tx, terminals, tx)


def by_rolling(tx):
    return customer_rolling_features(tx), terminal_risk_features(tx)


def values(frames):
    """All 12 features by transaction; each kind leaves out rows without its entity."""
    kinds = zip(frames, (CUSTOMER_FEATURES, TERMINAL_FEATURES), strict=True)
    return [sorted(map(tuple, df.select("tx_id", *names).collect()), key=repr) for df, names in kinds]


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_the_rolling_ones(spark, seed):
    tx = transactions(spark, seed)
    got = both(tx, panes.panes_of(tx, "customer_id"), panes.panes_of(tx, "terminal_id"))
    assert values(got) == values(by_rolling(tx))


def test_parity_after_three_batches(spark, sf_dir, tmp_path):
    """All 12 window features of training, from panes that changes have kept up to date, also after
    compactions and batches that ran twice."""
    tx = views.transactions(spark, sf_dir).select("tx_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount", "tx_fraud")
    stores = [panes.PaneStore(spark, str(tmp_path / e), e) for e in ("customer_id", "terminal_id")]
    for epoch, batch in enumerate(catalog._change_batches(tx)):
        for store in stores:
            store.apply(batch, epoch)
            store.apply(batch, epoch)
            if epoch:
                store.compact()
    for store in stores:
        assert {tuple(r) for r in store.panes().collect()} == {tuple(r) for r in panes.merged(panes.panes_of(tx, store.entity), store.entity).collect()}
        with pytest.raises(ValueError):
            store.apply(tx, 2)
    assert values(both(tx, *[s.panes() for s in stores])) == values(by_rolling(tx))


def test_serving_reads_few_days(spark):
    """A batch gets its features from panes and the rows of the edge days alone, equal to those of training."""
    tx = transactions(spark, 3)
    batch = tx.where("tx_id >= 550")
    all_panes = panes.panes_of(tx, "customer_id"), panes.panes_of(tx, "terminal_id")
    near = lambda delay: tx.where(F.to_date("tx_datetime").isin(panes.edge_days(batch, delay=delay)))
    got = panes.customer_features(batch, all_panes[0], near(0)), panes.terminal_features(batch, all_panes[1], near(7))
    assert values(got) == values([df.where("tx_id >= 550") for df in by_rolling(tx)])
    one = tx.where("tx_datetime IS NOT NULL").limit(1)
    assert len(panes.edge_days(one, delay=7)) == 4


def test_store_stays_small(spark, tmp_path):
    """Many batches leave few folders, and a base that is not whole does not count."""
    store = panes.PaneStore(spark, str(tmp_path / "s"), "customer_id")
    assert store.panes().count() == 0
    tx = transactions(spark, 4, 80)
    for epoch in range(12):
        store.apply(tx.where(F.col("tx_id") % 12 == epoch), epoch)
        if epoch % 3 == 2:
            store.compact()
    (tmp_path / "s" / "base=99").mkdir()
    names = sorted(p.name for p in (tmp_path / "s").iterdir())
    assert names == ["base=11", "base=8", "base=99", "epoch=10", "epoch=11", "epoch=9"]
    want = {tuple(r) for r in panes.merged(panes.panes_of(tx, "customer_id"), "customer_id").collect()}
    assert {tuple(r) for r in store.panes().collect()} == want


def test_empty(spark):
    tx = transactions(spark, 1, 5).where("false")
    assert values(both(tx, panes.panes_of(tx, "customer_id"), panes.panes_of(tx, "terminal_id"))) == [[], []]


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_few_and_many_moments(spark, monkeypatch, few):
    """Whether or not the history is cut to the asked days first, and however many tasks there are, the windows
    equal the rolling ones; the moments may come from a cheaper frame."""
    monkeypatch.setattr(panes, "FEW_MOMENTS", few)
    monkeypatch.setattr(panes, "TASK_ROWS", 100)
    tx = transactions(spark, 5)
    rows = panes.customer_features(tx.where("tx_id % 5 != 2"), panes.panes_of(tx, "customer_id"), tx, asked_in=tx)
    got = rows, panes.terminal_features(rows, panes.panes_of(tx, "terminal_id"), tx, asked_in=tx)
    want = [df.where("tx_id % 5 != 2") for df in by_rolling(tx)]
    want[1] = want[1].where("customer_id IS NOT NULL")
    assert values(got) == values(want)


def test_tasks_follow_the_rows(spark, monkeypatch):
    """The moments of one entity are spread by their number, over more tasks than the session has partitions."""
    monkeypatch.setattr(panes, "TASK_ROWS", 500, raising=False)
    tx = spark.range(3000).selectExpr(
        "id AS tx_id", "timestamp_seconds(1704067200 + id * 900) AS tx_datetime", "1L AS customer_id", "7L AS terminal_id",
        "CAST(1.5 AS decimal(10,2)) AS tx_amount", "CAST(id % 2 AS int) AS tx_fraud",
    )
    sums = panes.window_sums(tx, panes.panes_of(tx, "customer_id"), tx, "customer_id")
    sizes = [r["count"] for r in sums.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 250
    rows = panes.customer_features(tx, panes.panes_of(tx, "customer_id"), tx)
    tasks = rows.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert max(r["count"] for r in tasks) <= 250
