"""Loads and streams that must not lose rows, and plans that must not read too much."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from txlake.operators import cdc, models, snapshots
from txlake.operators.rolling import customer_rolling_features, terminal_risk_features
from txlake.plans import views
from txlake.schemas import CUSTOMER_FEATURES, TABLES, TERMINAL_FEATURES
from txlake.sources import tables
from txlake.streaming import ingest, scoring

DAY = dt.datetime(2024, 1, 1)


def rows(spark, ids):
    data = [(i, DAY + dt.timedelta(days=i % 3), i, i, None) for i in ids]
    return spark.createDataFrame(data, "tx_id int, tx_datetime timestamp, customer_id int, terminal_id int, tx_amount decimal(10,2)")


def test_untouched_days_survive_in_a_static_session(spark):
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    table = tables.load_table(rows(spark, [0, 1, 2]), "txlake_static", "transactions")
    try:
        tables.load_table(rows(spark, [3]), "txlake_static", "transactions")
        assert {r.tx_id for r in spark.table(table).collect()} == {0, 1, 2, 3}
        assert {r.tx_id for r in spark.table(table).where("dt = '2024-01-01'").collect()} == {0, 3}
    finally:
        tables.drop_table(spark, table)


def test_a_table_that_would_lose_days_is_refused(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS txlake_static")
    spark.sql(f"CREATE TABLE txlake_static.made_elsewhere ({TABLES['transactions'][0]}) USING parquet PARTITIONED BY (dt)")
    try:
        source = rows(spark, [1]).withColumn("dt", F.to_date("tx_datetime")).withColumns(
            {c: F.current_timestamp() for c in ("row_created_timestamp", "row_updated_timestamp")}
        )
        with pytest.raises(ValueError, match="untouched"):
            tables.upsert_table(source, "txlake_static.made_elsewhere", ["tx_id"], "dt")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        tables.upsert_table(source, "txlake_static.made_elsewhere", ["tx_id"], "dt")
        assert spark.table("txlake_static.made_elsewhere").count() == 1
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        tables.drop_table(spark, "txlake_static.made_elsewhere")


def _tx_stream(spark, path, ids):
    rows(spark, ids).write.mode("append").parquet(path)
    return scoring.stream_table(spark, path, rows(spark, []).schema)


def _features(spark):
    cust = spark.createDataFrame([], "customer_id int, dt date, " + ", ".join(f"{c} double" for c in CUSTOMER_FEATURES))
    term = spark.createDataFrame([], "terminal_id int, " + ", ".join(f"{c} double" for c in TERMINAL_FEATURES))
    return cust, term


def test_a_second_checkpoint_on_a_filled_output_is_refused(spark, tmp_path):
    def append(checkpoint, ids):
        stream = _tx_stream(spark, f"{tmp_path}/in", ids)
        scoring.start_append(stream, f"{tmp_path}/a", f"{tmp_path}/{checkpoint}", interval=None).awaitTermination()

    def score(checkpoint, ids):
        stream = _tx_stream(spark, f"{tmp_path}/in", ids)
        scoring.start_scoring(
            stream, lambda: _features(spark), lambda r: r.withColumn("prediction", F.lit(0.0)), f"{tmp_path}/b",
            f"{tmp_path}/{checkpoint}", interval=None,
        ).awaitTermination()

    log = spark.createDataFrame([], "key binary, value binary, partition int, offset long")
    log.write.parquet(f"{tmp_path}/log")

    def land(checkpoint, ids):
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
        ingest.start_ingest(stream, cdc.CUSTOMERS, f"{tmp_path}/c", f"{tmp_path}/{checkpoint}", interval=None).awaitTermination()

    append("c1", [1, 2])
    append("c1", [3])
    assert spark.read.parquet(f"{tmp_path}/a").count() == 3
    score("s1", [])
    score("s1", [4])
    assert spark.read.parquet(f"{tmp_path}/b").count() == 4
    rows(spark, [1]).write.parquet(f"{tmp_path}/c/epoch=0")
    for start, name in ((append, "c2"), (score, "s2"), (land, "l2")):
        with pytest.raises(RuntimeError, match="another checkpoint"):
            start(name, [9])
    assert spark.read.parquet(f"{tmp_path}/a").count() == 3
    assert spark.read.parquet(f"{tmp_path}/b").count() == 4


def test_a_timed_trigger_runs_until_stopped(spark, tmp_path):
    query = scoring.start_append(_tx_stream(spark, f"{tmp_path}/in", [1]), f"{tmp_path}/a", f"{tmp_path}/c", interval="1 second")
    try:
        for n in (1, 2):
            end = time.time() + 60
            while time.time() < end and not (query.lastProgress and spark.read.schema(rows(spark, []).schema).parquet(f"{tmp_path}/a").count() == n):
                time.sleep(0.5)
            assert spark.read.parquet(f"{tmp_path}/a").count() == n
            _tx_stream(spark, f"{tmp_path}/in", [n + 1])
        assert query.isActive
    finally:
        query.stop()


@pytest.mark.parametrize("day", [dt.date(2024, 1, 30), dt.date(2024, 1, 9)])
def test_snapshots_equal_the_rolling_rows(spark, sf_dir, day):
    tx = views.transactions(spark, sf_dir)
    rolled = customer_rolling_features(tx)
    want = snapshots.latest_features(rolled, "customer_id", CUSTOMER_FEATURES, day)
    assert sorted(snapshots.customer_snapshot(tx, until=day).collect()) == sorted(want.collect())
    want = snapshots.first_features_on(rolled, "customer_id", CUSTOMER_FEATURES, day)
    assert sorted(snapshots.customer_snapshot(tx, first_on=day).collect()) == sorted(want.collect())
    want = snapshots.latest_features(terminal_risk_features(tx), "terminal_id", TERMINAL_FEATURES)
    assert sorted(snapshots.terminal_snapshot(tx).collect()) == sorted(want.collect())


def test_snapshots_push_the_days_to_the_reader(spark, sf_dir, capsys):
    tx = views.transactions(spark, sf_dir)
    snapshots.customer_snapshot(tx, first_on=dt.date(2024, 1, 20)).explain("formatted")
    plan = capsys.readouterr().out
    pushed = [x for x in plan.split("\n") if "PushedFilters" in x]
    assert pushed and all("GreaterThanOrEqual(ts" in x and "LessThan(ts" in x for x in pushed) and "Window" not in plan
    snapshots.customer_snapshot(tx, until=dt.date(2024, 1, 20)).explain("formatted")
    plan = capsys.readouterr().out
    assert all("LessThan(ts" in x for x in plan.split("\n") if "PushedFilters" in x) and "Window" not in plan


def test_best_parameters_come_from_one_row(spark):
    names = [f"m_{k}{s}" for k in ("validation", "test") for s in ("", "_std")]
    data = [("b", 0.5, 0.1, 0.3, 0.01), ("a", 0.5 + 1e-13, 0.2, 0.4, 0.02), ("c", 0.4, 0.3, 0.4, 0.03), ("d", None, 0.3, None, 0.03)]
    df = spark.createDataFrame(data, "parameters string, " + ", ".join(f"{n} double" for n in names))
    for part in (df, df.orderBy(F.desc("parameters")), df.repartition(3)):
        r = models.best_parameters(part, ["m"]).first()
        assert (r.best_estimated_parameters, r.validation_std, r.test_performance, r.test_std) == ("a", 0.2, 0.4, 0.02)
        assert (r.optimal_parameters, r.optimal_test_std) == ("a", 0.02)


def test_missing_features_are_zero_in_training_and_serving(spark):
    data = [(float(i % 7), None if i % 2 else float(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(data, "a double, b double, tx_fraud int")
    learner = models.classifiers()["logistic_regression"]
    one, two = (models.fit(learner, x, ["a", "b"]) for x in (df, df.fillna(0.0)))
    scores = [sorted(r.prediction for r in models.score(m, x).collect()) for m, x in ((one, df), (two, df.fillna(0.0)))]
    assert scores[0] == pytest.approx(scores[1])
    assert all(0 <= s <= 1 for s in scores[0])


def test_cross_validation_reports_times(spark, sf_dir):
    rule = lambda train, params: lambda rows: rows.withColumn("score", F.lit(0.5))
    r = models.cross_validate(views.transactions(spark, sf_dir), rule, k=2, features=["tx_amount"]).first()
    assert r.fit_time >= 0 and r.score_time > 0 and r.auc_roc == pytest.approx(0.5)


def test_the_walk_sees_frauds_and_suspects_only(spark):
    """Many days with many cards and few frauds: the rows in question follow the compromised cards."""
    import random

    from txlake.operators import metrics

    rng = random.Random(6)
    bad = {c: rng.randrange(20) for c in range(8)}
    data = [
        (d, c, round(rng.random(), 2), int(c in bad and d >= bad[c] and (d - bad[c]) % 5 == 0))
        for d in range(30) for c in range(200)
    ]
    cards = spark.createDataFrame(data, "tx_time_days int, customer_id int, score double, label int")
    assert metrics.rows_in_question(cards, [], 20).count() <= 30 * len(bad)
    gone, want = set(), set()
    for d in range(30):
        pool = sorted(((-s, c, y) for e, c, s, y in data if e == d and c not in gone))[:20]
        found = {c for _, c, y in pool if y}
        want |= {(d, c) for c in found}
        gone |= found
    got = metrics.detected_cards(cards.withColumn("m", F.lit(1)), ["m"], 20)
    assert {(r.tx_time_days, r.customer_id) for r in got.collect()} == want and want


def test_pairs_within_radius(spark):
    import random

    from txlake.operators import radius

    rng = random.Random(2)
    place = lambda: (rng.choice([None, -0.0, 0.0, 1.0, round(rng.uniform(-3, 3), 1)]), round(rng.uniform(-3, 3), 1))
    cust, term = [(i, *place()) for i in range(80)], [(i, *place()) for i in range(60)]
    got = radius.pairs_within_radius(
        spark.createDataFrame(cust, "customer_id long, x_location double, y_location double"),
        spark.createDataFrame(term, "terminal_id long, x_location double, y_location double"), 1.0,
    ).collect()
    want = {
        (a, b) for a, x, y in cust for b, u, w in term
        if x is not None and u is not None and ((x - u) ** 2 + (y - w) ** 2) ** 0.5 < 1.0
    }
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_calendar_features_of_many_dates(spark, sf_dir):
    tx = views.transactions(spark, sf_dir)
    days = [(dt.date(2024, 1, 9), 1), (dt.date(2024, 1, 20), 0), (dt.date(2024, 2, 9), 1)]
    got = sorted(snapshots.calendar_features_on(tx, days).collect())
    want = [r for day, end in days for r in snapshots.calendar_features(tx, day, end_offset=end).collect()]
    assert got == sorted(want)


def test_folds_push_the_days_to_the_reader(spark, sf_dir, capsys):
    from txlake.operators import splits

    splits.prequential_folds(views.transactions(spark, sf_dir), 15, 3, 5, 5, 5, origin=views.ORIGIN).explain("formatted")
    pushed = [x for x in capsys.readouterr().out.split("\n") if "PushedFilters" in x and "ts" in x]
    assert pushed and all("GreaterThanOrEqual(ts" in x and "LessThan(ts" in x for x in pushed)
