"""Envelope cases, order of changes, and the ingest stream."""

import base64
import json

import pytest

from txlake.operators import cdc
from txlake.schemas import LOG_SCHEMA
from txlake.sources import topics
from txlake.streaming import ingest


def image(tx_id, cents=100, **over):
    raw = cents.to_bytes(5, "big", signed=True)
    return {
        "tx_id": tx_id, "tx_datetime": 1_704_067_200_000_000, "customer_id": 7, "terminal_id": 8,
        "tx_amount": base64.b64encode(raw).decode(), **over,
    }


def event(op, tx_id, lsn, cents=100, before=None, after="same"):
    after = image(tx_id, cents) if after == "same" else after
    return json.dumps(
        {"schema": {"type": "struct"}, "payload": {"op": op, "before": before, "after": after,
         "source": {"lsn": lsn, "ts_us": lsn, "table": "transactions"}, "ts_us": lsn, "extra": 1}}
    )


def log(spark, values, first=0):
    rows = [
        (None, v.encode() if v is not None else None, "t", 0, first + i, None) for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


CASES = [
    event("r", 1, 1),                                             # snapshot read
    event("c", 2, 2), event("u", 2, 3, 250),                      # create, update
    event("c", 3, 4), event("d", 3, 5, before=image(3), after=None), None,  # delete, tombstone
    "{not json", event("c", 4, 6, after=None), event("x", 5, 7),  # malformed, no image, unknown
]


def test_parse(spark):
    rows = cdc.parse_changes(log(spark, CASES), cdc.TRANSACTIONS).collect()
    assert sorted((r.tx_id, r._op, str(r.tx_amount)) for r in rows) == [
        (1, "r", "1.00"), (2, "c", "1.00"), (2, "u", "2.50"), (3, "c", "1.00"), (3, "d", "1.00")
    ]
    assert {(r.customer_id, r.terminal_id) for r in rows} == {(7, 8)}


def test_rejected(spark):
    rows = cdc.rejected_events(log(spark, CASES), cdc.TRANSACTIONS).collect()
    assert sorted(r.offset for r in rows) == [6, 7, 8]


def test_amounts_that_do_not_fit_are_rejected(spark):
    wide = base64.b64encode((10**12).to_bytes(12, "big")).decode()
    values = [
        event("c", 1, 1), event("u", 1, 2, 10**11), event("u", 1, 3, after=image(1, tx_amount=wide)),
        event("c", 2, 4, after=image(2, tx_amount=None)), event("d", 3, 5, before=image(3, tx_amount=wide), after=None),
    ]
    rows = cdc.parse_changes(log(spark, values), cdc.TRANSACTIONS).collect()
    assert sorted((r.tx_id, r._op, str(r.tx_amount)) for r in rows) == [(1, "c", "1.00"), (2, "c", "None"), (3, "d", "None")]
    assert sorted(r.offset for r in cdc.rejected_events(log(spark, values), cdc.TRANSACTIONS).collect()) == [1, 2]


def test_state(spark):
    rows = cdc.current_state(log(spark, CASES), cdc.TRANSACTIONS).collect()
    assert sorted((r.tx_id, str(r.tx_amount)) for r in rows) == [(1, "1.00"), (2, "2.50")]


def test_same_time_different_lsn(spark):
    values = [event("c", 1, 10, 100), event("u", 1, 12, 300), event("u", 1, 11, 200)]
    rows = cdc.current_state(log(spark, values), cdc.TRANSACTIONS).collect()
    assert [str(r.tx_amount) for r in rows] == ["3.00"]


def test_locations(spark):
    value = json.dumps({"payload": {"op": "c", "after": {"customer_id": 3, "x_location": 1.5, "y_location": -2.0},
                                    "source": {"lsn": 1}}})
    assert cdc.current_state(log(spark, [value]), cdc.CUSTOMERS).collect() == [(3, 1.5, -2.0)]


def test_one_json_parse_in_the_plan(spark):
    df = cdc.parse_changes(log(spark, CASES), cdc.TRANSACTIONS)
    assert df._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def run(spark, base, **options):
    stream = topics.stream_log_files(spark, f"{base}/log", **options)
    ingest.start_ingest(
        stream, cdc.TRANSACTIONS, f"{base}/changes", f"{base}/offsets", interval=None
    ).awaitTermination()
    rows = ingest.table_state(spark, cdc.TRANSACTIONS, f"{base}/changes").collect()
    return sorted((r.tx_id, str(r.tx_amount)) for r in rows)


def test_stream(spark, tmp_path):
    base = str(tmp_path)
    log(spark, CASES).coalesce(1).write.mode("append").parquet(f"{base}/log")
    assert run(spark, base) == [(1, "1.00"), (2, "2.50")]
    # A restart with nothing new adds nothing.
    before = ingest.table_changes(spark, f"{base}/changes").count()
    assert run(spark, base) == [(1, "1.00"), (2, "2.50")]
    assert ingest.table_changes(spark, f"{base}/changes").count() == before
    # A later batch: an older change of 2 does not win, 1 is deleted, 6 is new.
    late = [event("u", 2, 2, 999), event("d", 1, 20, before=image(1), after=None), event("c", 6, 21, 600)]
    log(spark, late, 100).coalesce(1).write.mode("append").parquet(f"{base}/log")
    assert run(spark, base) == [(2, "2.50"), (6, "6.00")]


def test_compaction(spark, tmp_path):
    base = str(tmp_path)
    log(spark, CASES).coalesce(1).write.mode("append").parquet(f"{base}/log")
    run(spark, base)
    ingest.compact_changes(spark, cdc.TRANSACTIONS, f"{base}/changes", f"{base}/compact")
    state = lambda: sorted(
        (r.tx_id, str(r.tx_amount))
        for r in ingest.table_state(spark, cdc.TRANSACTIONS, f"{base}/changes", f"{base}/compact").collect()
    )
    assert state() == [(1, "1.00"), (2, "2.50")]
    # The deleted key is remembered: an older change of it that comes late does not bring it back.
    late = [event("u", 3, 4, 300), event("d", 1, 20, before=image(1), after=None), event("c", 6, 21, 600)]
    log(spark, late, 100).coalesce(1).write.mode("append").parquet(f"{base}/log")
    assert run(spark, base) == state() == [(2, "2.50"), (6, "6.00")]


@pytest.mark.parametrize("files", [1, 5])
def test_batches_do_not_matter(spark, tmp_path, files):
    log(spark, CASES).repartition(files).write.parquet(f"{tmp_path}/log")
    assert run(spark, str(tmp_path), max_files=1) == [(1, "1.00"), (2, "2.50")]


def test_merge_stream_hands_over_deletes(spark, tmp_path):
    log(spark, CASES).coalesce(1).write.parquet(f"{tmp_path}/log")
    seen = []
    ingest.start_merge_ingest(
        topics.stream_log_files(spark, f"{tmp_path}/log"), cdc.TRANSACTIONS,
        lambda batch, epoch: seen.extend((r.tx_id, r._op) for r in batch.collect()),
        f"{tmp_path}/offsets", interval=None,
    ).awaitTermination()
    assert sorted(seen) == [(1, "r"), (2, "u"), (3, "d")]


def test_many_batches_leave_few_folders(spark, tmp_path):
    """Batches are folded into bases; the state is that of all changes, a restart goes on, and a base that was
    cut off does not count."""
    base = str(tmp_path)
    want, values = {}, []
    for n in range(24):
        key = n % 5
        values.append(event("u" if n > 4 else "c", key, 100 + n, 100 * n) if n % 7 else event("d", key, 100 + n, before=image(key), after=None))
        if n % 7:
            want[key] = f"{n}.00"
        else:
            want.pop(key, None)
    for n, value in enumerate(values):
        log(spark, [value], 10 * n).coalesce(1).write.mode("append").parquet(f"{base}/log")

    def go():
        stream = topics.stream_log_files(spark, f"{base}/log", max_files=1)
        ingest.start_ingest(stream, cdc.TRANSACTIONS, f"{base}/changes", f"{base}/offsets", interval=None, compact_every=4).awaitTermination()

    go()
    (tmp_path / "changes" / "_bases" / "upto=99").mkdir()
    names = sorted(p.name for p in (tmp_path / "changes").iterdir() if p.name.startswith("epoch"))
    assert len(names) == 4 and len(list((tmp_path / "changes" / "_bases").iterdir())) <= 3
    state = lambda: {r.tx_id: str(r.tx_amount) for r in ingest.table_state(spark, cdc.TRANSACTIONS, f"{base}/changes").collect()}
    assert state() == want
    # The same fold again, as after a failure before the batch was committed.
    ingest.retire_epochs(spark, cdc.TRANSACTIONS, f"{base}/changes")
    assert state() == want
    log(spark, [event("c", 77, 500, 100)], 900).coalesce(1).write.mode("append").parquet(f"{base}/log")
    go()
    assert state() == want | {77: "1.00"}


def test_log_files_of_the_ingest_query_are_bounded(spark, sf_dir, monkeypatch):
    """Four batches whatever the size of the log, each of several files with an even share."""
    from txlake.plans import catalog

    given = []

    def stream(spark, path, max_files):
        given.append((path, max_files))
        return read(spark, path, max_files)

    read = catalog.topics.stream_log_files
    monkeypatch.setattr(catalog, "LOG_FILE_TX", 50)
    monkeypatch.setattr(catalog.topics, "stream_log_files", stream)
    n = catalog.v.table(spark, sf_dir, "events").count()
    rows = catalog.cdc_stream_ingest(spark, sf_dir)
    (path, max_files), = given
    assert max_files == -(-n // 200)
    sizes = [r["count"] for r in spark.read.parquet(path).selectExpr("_metadata.file_name AS f").groupBy("f").count().collect()]
    assert len(sizes) == 4 * max_files and max(sizes) < 3 * 50 * 1.7
    assert rows.count() == catalog.cdc_latest_image(spark, sf_dir).count()
