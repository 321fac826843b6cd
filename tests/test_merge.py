import datetime as dt

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txlake.operators import merge
from txlake.sources import tables

T1, T2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
COLS = "id long, v string, row_created_timestamp timestamp, row_updated_timestamp timestamp"


def frame(spark, rows, at):
    return spark.createDataFrame([(i, x, at, at) for i, x in rows], COLS)


@pytest.fixture(params=[0, 100], ids=["shuffle", "broadcast"])
def merged(spark, request):
    def run(old, new):
        out = merge.merge_upsert(
            frame(spark, old, T1), frame(spark, new, T2), ["id"], small_rows=request.param
        )
        return sorted(tuple(r) for r in out.collect())

    return run


def test_insert_update_and_untouched(merged):
    assert merged([(1, "a"), (2, "b")], [(2, "B"), (3, "c")]) == [
        (1, "a", T1, T1), (2, "B", T1, T2), (3, "c", T2, T2)
    ]


def test_insert_only_and_update_only(merged):
    assert merged([], [(1, "a")]) == [(1, "a", T2, T2)]
    assert merged([(1, "a")], [(1, "b")]) == [(1, "b", T1, T2)]


def test_update_to_null_is_an_update(merged):
    assert merged([(1, "a")], [(1, None)]) == [(1, None, T1, T2)]


@pytest.mark.parametrize(
    ("rows", "text"), [([(1, "a"), (1, "b")], "more than one row"), ([(None, "a")], "NULL key")]
)
def test_bad_source_fails(merged, rows, text):
    with pytest.raises(Exception, match=text):
        merged([(1, "a")], rows)


def test_bad_source_fails_even_if_no_value_is_read(spark):
    old, new = frame(spark, [(1, "a")], T1), frame(spark, [(1, "a"), (1, "b")], T2)
    for rows in (0, 100):
        with pytest.raises(Exception, match="more than one row"):
            merge.merge_upsert(old, new, ["id"], small_rows=rows).select("id").collect()


@pytest.mark.parametrize("rows", [0, 100])
def test_target_null_keys_pass(spark, rows):
    old, new = frame(spark, [(None, "x"), (1, "a")], T1), frame(spark, [(1, "b")], T2)
    out = merge.merge_upsert(old, new, ["id"], small_rows=rows)
    assert {(r.id, r.v) for r in out.collect()} == {(None, "x"), (1, "b")}


def test_small_source_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(100).selectExpr("id", "'a' AS v").write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    source = spark.createDataFrame([(5, "b"), (500, "c")], "id long, v string")
    out = merge.merge_upsert(target, source, ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Only the few matched keys are exchanged (for the distinct), never the target's rows.
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert out.count() == 101


@pytest.mark.parametrize("rows_", [0, 100])
def test_moved_date_is_inserted_again(spark, rows_):
    day = F.to_date(F.col("v"))
    old = frame(spark, [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-09")], T1).withColumn("dt", day)
    new = frame(spark, [(1, "2024-01-02"), (2, "2024-01-02")], T2).withColumn("dt", day)
    rows = merge.merge_touched_partitions(old, new, ["id"], small_rows=rows_).collect()
    # Only 2 January is touched: 1 is new there, 2 is updated; 1 January and 9 January stay as they are.
    assert sorted((r.id, r.v, r.row_created_timestamp, r.row_updated_timestamp) for r in rows) == [
        (1, "2024-01-02", T2, T2), (2, "2024-01-02", T1, T2)
    ]


@pytest.mark.parametrize("limit", [0, 100])
def test_untouched_partitions_are_not_read(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(merge, "MAX_PARTITIONS", limit)
    spark.range(30).selectExpr("id", "'a' AS v", "date_add(DATE'2024-01-01', cast(id % 10 AS int)) AS dt").write.partitionBy(
        "dt"
    ).parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    source = spark.createDataFrame([(3, "b", dt.date(2024, 1, 4))], "id long, v string, dt date")
    out = merge.merge_touched_partitions(target, source, ["id"])
    assert sorted((r.id, r.v) for r in out.collect()) == [(3, "b"), (13, "a"), (23, "a")]
    if limit:
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dt" in plan


def test_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS txlake_test CASCADE")
    name = tables.ensure_table(spark, "txlake_test", "transactions")
    assert tables.ensure_table(spark, "txlake_test", "transactions") == name
    assert tables.ensure_table(spark, "txlake_test", "customer") == "txlake_test.customer"
    make = lambda rows, at: spark.createDataFrame(
        [(i, dt.datetime(2024, 1, d), 1, 1, None, at, at, dt.date(2024, 1, d)) for i, d in rows],
        spark.table(name).schema,
    )
    tables.upsert_table(make([(1, 1), (2, 2)], T1), name, ["tx_id"], "dt")
    tables.upsert_table(make([(2, 2), (3, 3)], T2), name, ["tx_id"], "dt")
    got = sorted((r.tx_id, r.row_created_timestamp, r.row_updated_timestamp) for r in spark.table(name).collect())
    assert got == [(1, T1, T1), (2, T1, T2), (3, T2, T2)]
    for x in (0.0, 1.0):
        places = spark.createDataFrame([(1, x, 0.0)], "customer_id int, x_location double, y_location double")
        tables.load_table(places, "txlake_test", "customer")
    assert spark.table("txlake_test.customer").first().x_location == 1.0
    assert tables.run_sql(spark, "SELECT count(*) AS n FROM txlake_test.customer").first().n == 1
    tables.drop_table(spark, name)
    spark.sql("DROP DATABASE IF EXISTS txlake_test CASCADE")


@pytest.fixture
def places(spark):
    spark.sql("DROP DATABASE IF EXISTS txlake_versions CASCADE")
    make = lambda ids, x: spark.createDataFrame([(i, x, 0.0) for i in ids], "customer_id long, x_location double, y_location double")
    yield make
    spark.sql("DROP DATABASE IF EXISTS txlake_versions CASCADE")


def load(spark, rows):
    return tables.load_table(rows, "txlake_versions", "customer")


def held(spark):
    return {r.customer_id: r.x_location for r in spark.table("txlake_versions.customer").collect()}


@pytest.mark.parametrize("broken", ["write_version", "switch_version"])
def test_load_cut_off_leaves_the_old_rows(spark, places, monkeypatch, broken):
    load(spark, places(range(20), 1.0))
    right = getattr(tables, broken)

    def fails(*args):
        if broken == "write_version":
            right(*args)  # all is written, nothing is switched
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, broken, fails)
        with pytest.raises(RuntimeError):
            load(spark, places(range(10, 30), 2.0))
    assert held(spark) == dict.fromkeys(range(20), 1.0)
    load(spark, places(range(10, 30), 2.0))
    assert held(spark) == {i: 1.0 if i < 10 else 2.0 for i in range(30)}


def test_reader_of_the_old_version_goes_on(spark, places):
    load(spark, places(range(5), 1.0))
    begun = spark.table("txlake_versions.customer").select("customer_id", "x_location")
    begun._jdf.queryExecution().executedPlan()
    load(spark, places(range(5), 2.0))
    assert {r.x_location for r in begun.collect()} == {1.0} and set(held(spark).values()) == {2.0}


def test_versions_do_not_pile_up(spark, places):
    for x in range(5):
        load(spark, places(range(3), float(x)))
    where = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED txlake_versions.customer").collect()}["Location"]
    folder = Path(where.removeprefix("file:")).parent
    assert len(list(folder.glob("customer__version_*"))) == 2 and held(spark) == dict.fromkeys(range(3), 4.0)


@pytest.mark.parametrize("rows_", [0, 100])
def test_upsert_does_not_move_the_table(spark, places, rows_):
    """The target of a large and of a small source is read in its buckets, in order, without an exchange."""
    load(spark, places(range(500), 1.0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.table("txlake_versions.customer")
        source = merge.with_audit(places(range(400, 460), 2.0))
        out = merge.merge_upsert(target, source, ["customer_id"], small_rows=rows_)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        text = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 500 and "Scan parquet" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    for at, line in enumerate(lines):
        if "Scan parquet spark_catalog.txlake_versions" not in line:
            continue
        depth, above = len(line) - len(line.lstrip(" :|+-")), []
        for up in reversed(lines[:at]):
            indent = len(up) - len(up.lstrip(" :|+-"))
            if indent < depth:
                depth = indent
                above.append(up)
                if "Join" in up:
                    break
        assert "Bucketed: true" in line and not any("Exchange" in x for x in above), above
