"""Every query by name, with the SQL that must give the same rows.

Results use plain types (integers, doubles, strings, timestamps) so two engines can be compared.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.scalars import decode_decimal, encode_decimal, from_seconds, predicted_class
from txlake.operators import cdc, labels, merge, metrics, models, panes, radius, sketches, snapshots, splits, stats
from txlake.operators.ordering import sequential_ids
from txlake.operators.rolling import customer_rolling_features, rolling_sums, terminal_risk_features
from txlake.plans import views as v
from txlake.plans.features import feature_frame, with_flags
from txlake.schemas import CUSTOMER_FEATURES, FEATURES, TERMINAL_FEATURES
from txlake.session import stage, staging_path
from txlake.sources import files, tables, topics
from txlake.sources.feature_store import FeatureStore
from txlake.streaming import ingest, scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CUST = ", ".join(CUSTOMER_FEATURES)
TERM = ", ".join(TERMINAL_FEATURES)


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, which any two engines print alike."""
    cols = []
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            cols.append(F.col(name).cast("double").alias(name))
        elif kind == "date":
            cols.append(F.date_format(name, "yyyy-MM-dd").alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


# --- features -------------------------------------------------------------------------------

WEEKEND_SQL = "CASE WHEN isodow(tx_datetime) >= 6 THEN 1 ELSE 0 END AS tx_during_weekend"
NIGHT_SQL = "CASE WHEN hour(tx_datetime) <= 6 THEN 1 ELSE 0 END AS tx_during_night"


@query(v.with_(v.TX, body=f"SELECT tx_id, {WEEKEND_SQL}, {NIGHT_SQL} FROM tx"))
def datetime_flags(spark, sf_dir):
    return with_flags(v.transactions(spark, sf_dir)).select(
        "tx_id", "tx_during_weekend", "tx_during_night"
    )


@query(v.with_(v.TX, v.customer_features_sql(), body=f"SELECT tx_id, customer_id, {CUST} FROM cust"))
def customer_rolling_features_q(spark, sf_dir):
    tx = v.transactions(spark, sf_dir).select("tx_id", "customer_id", "tx_datetime", "tx_amount")
    return customer_rolling_features(tx).select("tx_id", "customer_id", *CUSTOMER_FEATURES)


def _ties_sql(name: str, frame_end: str) -> str:
    day = v.DAY_US
    parts = [
        f"""(SELECT count(*) FROM o p WHERE p.o_custkey = o.o_custkey AND p.us > o.us - {n * day}
             AND (p.us < o.us OR (p.us = o.us AND {frame_end}))) AS nb_{n}"""
        for n in (1, 7, 30)
    ]
    return (
        "WITH o AS (SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) AS us FROM orders) "
        f"SELECT o_orderkey, {', '.join(parts)} FROM o"
    )


def _ties(spark, sf_dir, tie_break):
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return rolling_sums(
        o, "o_custkey", "o_orderdate", {"nb": F.lit(1)}, tie_break=tie_break
    ).select("o_orderkey", "nb_1", "nb_7", "nb_30")


@query(_ties_sql("peers", "TRUE"))
def rolling_ties_peers(spark, sf_dir):
    return _ties(spark, sf_dir, None)


@query(_ties_sql("by_id", "p.o_orderkey <= o.o_orderkey"))
def rolling_ties_by_id(spark, sf_dir):
    return _ties(spark, sf_dir, "o_orderkey")


@query(v.with_(v.TX, v.terminal_features_sql(), body=f"SELECT tx_id, terminal_id, {TERM} FROM term"))
def terminal_risk_features_q(spark, sf_dir):
    tx = v.transactions(spark, sf_dir).select("tx_id", "terminal_id", "tx_datetime", "tx_fraud")
    return terminal_risk_features(tx).select("tx_id", "terminal_id", *TERMINAL_FEATURES)


@query(
    v.with_(
        v.TX, v.customer_features_sql(), v.terminal_features_sql(source="cust"),
        body=f"""SELECT tx_id, customer_id, terminal_id, CAST(tx_amount AS DOUBLE) AS tx_amount, tx_fraud,
                 {WEEKEND_SQL}, {NIGHT_SQL}, {CUST}, {TERM} FROM term""",
    )
)
def feature_vector(spark, sf_dir):
    return _plain(
        feature_frame(v.transactions(spark, sf_dir)).select(
            "tx_id", "customer_id", "terminal_id", "tx_fraud", *FEATURES
        )
    )


@query(
    v.with_(
        v.TX, v.terminal_features_sql(),
        body=f"""SELECT terminal_id, {TERM} FROM (SELECT *, row_number() OVER
                 (PARTITION BY terminal_id ORDER BY us DESC, tx_id) AS rn FROM term) WHERE rn = 1""",
    )
)
def terminal_feature_snapshot(spark, sf_dir):
    rows = snapshots.terminal_snapshot(v.transactions(spark, sf_dir))
    kept = snapshots.matching(rows, "terminal_id.*")
    return snapshots.lower_names(rows.select(*kept))


SNAPSHOT_DAY = dt.date(2024, 1, 30)


@query(
    v.with_(
        v.TX, v.customer_features_sql(),
        body=f"""SELECT customer_id, {CUST} FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                 ORDER BY us, tx_id) AS rn FROM cust WHERE CAST(tx_datetime AS DATE) = DATE '2024-01-30')
                 WHERE rn = 1""",
    )
)
def customer_feature_snapshot_first(spark, sf_dir):
    return snapshots.customer_snapshot(v.transactions(spark, sf_dir), first_on=SNAPSHOT_DAY)


@query(
    v.with_(
        v.TX, v.customer_features_sql(),
        body=f"""SELECT customer_id, {CUST} FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                 ORDER BY us DESC, tx_id) AS rn FROM cust WHERE CAST(tx_datetime AS DATE) <= DATE '2024-01-30')
                 WHERE rn = 1""",
    )
)
def customer_feature_snapshot(spark, sf_dir):
    return snapshots.customer_snapshot(v.transactions(spark, sf_dir), until=SNAPSHOT_DAY)


CAL_DAY = dt.date(2024, 1, 25)


@query(
    v.with_(
        v.TX, v.calendar_sql("cal", "2024-01-25"),
        body=f"SELECT customer_id, strftime(dt, '%Y-%m-%d') AS dt, {CUST} FROM cal",
    )
)
def customer_calendar_features(spark, sf_dir):
    return _plain(snapshots.calendar_features(v.transactions(spark, sf_dir), CAL_DAY))


@query(
    v.with_(
        v.TX, v.calendar_sql("cal", "2024-01-25", 0),
        body=f"""SELECT customer_id, strftime(dt, '%Y-%m-%d') AS dt, {CUST} FROM cal
                 WHERE customer_id_nb_tx_1day_window > 0""",
    )
)
def customer_calendar_features_to_date(spark, sf_dir):
    return _plain(
        snapshots.calendar_features(
            v.transactions(spark, sf_dir), CAL_DAY, end_offset=0, drive_by_1day=True
        )
    )


# --- change capture and merge ---------------------------------------------------------------

ROW = "tx_id, tx_datetime, customer_id, terminal_id, CAST(tx_amount AS DOUBLE) AS tx_amount"


@query(v.with_(v.TX, v.CHANGES, body=f"SELECT op, lsn, {ROW} FROM changes"))
def cdc_parse(spark, sf_dir):
    """A log kept in files, read as a batch."""
    path = f"{staging_path(spark, 'log')}/log"
    v.cdc_log(spark, sf_dir).write.parquet(path)
    rows = cdc.parse_changes(topics.read_log_files(spark, path), cdc.TRANSACTIONS)
    return _plain(
        rows.select(F.col("_op").alias("op"), F.col("_lsn").alias("lsn"), *cdc.TRANSACTIONS.columns)
    )


@query(
    v.with_(
        v.TX,
        body="""SELECT tx_id, CAST(tx_amount AS DOUBLE) AS amount, CAST(-tx_amount AS DOUBLE) AS refund,
                CAST(tx_amount * 100000 - CAST(12345.67 AS DECIMAL(10,2)) AS DOUBLE) AS large FROM tx""",
    )
)
def cdc_decode_decimal(spark, sf_dir):
    tx = v.transactions(spark, sf_dir)
    amount = F.col("tx_amount")
    large = (amount * 100000).cast("decimal(14,2)") - F.lit("12345.67").cast("decimal(10,2)")
    sent = tx.select(
        "tx_id", encode_decimal(amount).alias("a"), encode_decimal(-amount).alias("r"),
        encode_decimal(large, precision=14).alias("l"),
    )
    return _plain(
        sent.select(
            "tx_id", decode_decimal(F.col("a")).alias("amount"),
            decode_decimal(F.col("r")).alias("refund"), decode_decimal(F.col("l")).alias("large"),
        )
    )


LATEST_SQL = v.with_(
    v.TX, v.CHANGES,
    body=f"""SELECT {ROW} FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY lsn DESC) AS rn
             FROM changes) WHERE rn = 1 AND op <> 'd'""",
)


@query(LATEST_SQL)
def cdc_latest_image(spark, sf_dir):
    return _plain(cdc.current_state(v.cdc_log(spark, sf_dir), cdc.TRANSACTIONS))


@query(LATEST_SQL)
def cdc_offset_ranges(spark, sf_dir):
    """The state from two reads of the log by offsets: up to half of each partition, then from there on."""
    path = f"{staging_path(spark, 'log')}/log"
    v.cdc_log(spark, sf_dir).write.parquet(path)
    log = topics.read_log_files(spark, path)
    ends = topics.next_offsets(log)
    half = {p: end // 2 for p, end in ends.items()}
    first = topics.between_offsets(log, dict.fromkeys(ends, topics.EARLIEST), half)
    rest = topics.between_offsets(log, half, ends)
    latest = [cdc.latest_image(cdc.parse_changes(part, cdc.TRANSACTIONS), cdc.TRANSACTIONS.keys, keep_deletes=True) for part in (first, rest)]
    state = cdc.latest_image(latest[0].unionByName(latest[1]), cdc.TRANSACTIONS.keys)
    return _plain(state.select(*cdc.TRANSACTIONS.columns))


LOG_FILE_TX = 100_000


@query(LATEST_SQL)
def cdc_stream_ingest(spark, sf_dir):
    """Log files in four micro-batches through the stream; the state read back at the end.

    A batch has a file per ``LOG_FILE_TX`` transactions, so no task writes or reads more, however long the log."""
    base = staging_path(spark, "ingest")
    per_batch = max(1, math.ceil(v.table(spark, sf_dir, "events").count() / (4 * LOG_FILE_TX)))
    v.cdc_log(spark, sf_dir).repartition(4 * per_batch, "key").write.parquet(f"{base}/log")
    log = topics.stream_log_files(spark, f"{base}/log", max_files=per_batch)
    ingest.start_ingest(
        log, cdc.TRANSACTIONS, f"{base}/changes", f"{base}/offsets", interval=None
    ).awaitTermination()
    return _plain(ingest.table_state(spark, cdc.TRANSACTIONS, f"{base}/changes"))


BEFORE, AFTER = dt.datetime(2024, 2, 1, tzinfo=dt.UTC), dt.datetime(2024, 2, 2, tzinfo=dt.UTC)
TX_ROW = ["tx_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount"]


def _merge_inputs(spark, sf_dir):
    """A table loaded up to 15 January, and a later load of everything from the 11th on."""
    tx = v.transactions(spark, sf_dir, ["event_type"])
    old = merge.with_audit(
        tx.where("tx_time_days <= 14").select(*TX_ROW), F.lit(BEFORE).cast("timestamp")
    )
    new = tx.where("tx_time_days >= 10").withColumn(
        "tx_amount", (F.col("tx_amount") + 1).cast("decimal(10,2)")
    )
    return old, new


AUDIT_SQL = (
    "CASE WHEN {old} THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS row_created_timestamp, "
    "CASE WHEN {new} THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS row_updated_timestamp"
)


@query(
    v.with_(
        v.TX,
        body=f"""SELECT tx_id, tx_datetime, customer_id, terminal_id,
                 CAST(tx_amount + CASE WHEN tx_time_days >= 10 THEN 1 ELSE 0 END AS DOUBLE) AS tx_amount,
                 {AUDIT_SQL.format(old="tx_time_days <= 14", new="tx_time_days >= 10")} FROM tx""",
    )
)
def merge_upsert(spark, sf_dir):
    old, new = _merge_inputs(spark, sf_dir)
    source = merge.with_audit(new.select(*TX_ROW), F.lit(AFTER).cast("timestamp"))
    return _plain(merge.merge_upsert(old, source, ["tx_id"]))


@query(
    v.with_(
        v.TX, v.calendar_sql("a", "2024-01-20"), v.calendar_sql("b", "2024-01-25"),
        v.calendar_sql("b2", "2024-01-25", 0), v.calendar_sql("c", "2024-01-28"),
        body=f"""SELECT strftime(dt, '%Y-%m-%d') AS dt, customer_id, {CUST},
                 {AUDIT_SQL.format(old="old = 1", new="new = 1")} FROM (
                   SELECT *, 1 AS old, 0 AS new FROM a
                   UNION ALL SELECT b2.*, CASE WHEN b.customer_id IS NULL THEN 0 ELSE 1 END, 1
                     FROM b2 LEFT JOIN b ON b.customer_id = b2.customer_id
                   UNION ALL SELECT b.*, 1, 0 FROM b WHERE customer_id NOT IN (SELECT customer_id FROM b2)
                   UNION ALL SELECT *, 0, 1 FROM c)""",
    )
)
def merge_upsert_composite(spark, sf_dir):
    """Dated customer features: one date recomputed, one date new."""
    tx = v.transactions(spark, sf_dir)
    cal = lambda *days: snapshots.calendar_features_on(
        tx, [(dt.date(2024, 1, day), end) for day, end in days]
    )
    old = merge.with_audit(cal((20, 1), (25, 1)), F.lit(BEFORE).cast("timestamp"))
    new = merge.with_audit(cal((25, 0), (28, 1)), F.lit(AFTER).cast("timestamp"))
    return _plain(merge.merge_upsert(old, new, ["customer_id", "dt"]))


@query(
    v.with_(
        v.TX,
        """src AS (SELECT tx_id, CASE WHEN event_type = 'view' THEN tx_datetime + INTERVAL 1 DAY
             ELSE tx_datetime END AS tx_datetime, customer_id, terminal_id, tx_amount + 1 AS tx_amount
             FROM tx WHERE tx_time_days >= 10)""",
        """tgt AS (SELECT tx_id, tx_datetime, customer_id, terminal_id, tx_amount FROM tx WHERE tx_time_days <= 14
             AND CAST(tx_datetime AS DATE) IN (SELECT CAST(tx_datetime AS DATE) FROM src))""",
        body=f"""SELECT coalesce(s.tx_id, t.tx_id) AS tx_id, coalesce(s.tx_datetime, t.tx_datetime) AS tx_datetime,
                 coalesce(s.customer_id, t.customer_id) AS customer_id,
                 coalesce(s.terminal_id, t.terminal_id) AS terminal_id,
                 CAST(coalesce(s.tx_amount, t.tx_amount) AS DOUBLE) AS tx_amount,
                 {AUDIT_SQL.format(old="t.tx_id IS NOT NULL", new="s.tx_id IS NOT NULL")},
                 strftime(CAST(coalesce(s.tx_datetime, t.tx_datetime) AS DATE), '%Y-%m-%d') AS dt
                 FROM tgt t FULL OUTER JOIN src s ON s.tx_id = t.tx_id
                   AND CAST(s.tx_datetime AS DATE) = CAST(t.tx_datetime AS DATE)""",
    )
)
def merge_upsert_partitioned(spark, sf_dir):
    """Key (date, id): a row whose date moved is inserted again; untouched days are not read."""
    old, new = _merge_inputs(spark, sf_dir)
    moved = F.when(
        F.col("event_type") == "view", F.col("tx_datetime") + F.expr("INTERVAL 1 DAY")
    ).otherwise(F.col("tx_datetime"))
    source = merge.with_audit(
        new.withColumn("tx_datetime", moved).select(*TX_ROW), F.lit(AFTER).cast("timestamp")
    )
    day = F.to_date("tx_datetime")
    return _plain(
        merge.merge_touched_partitions(
            old.withColumn("dt", day), source.withColumn("dt", day), ["tx_id"]
        )
    )


@query(
    v.with_(
        v.TX,
        body=f"""SELECT tx_id, tx_datetime, customer_id, terminal_id,
                 CAST(tx_amount + CASE WHEN tx_time_days >= 10 THEN 1 ELSE 0 END AS DOUBLE) AS tx_amount,
                 {AUDIT_SQL.format(old="tx_time_days <= 14", new="tx_time_days >= 10")},
                 strftime(CAST(tx_datetime AS DATE), '%Y-%m-%d') AS dt FROM tx""",
    )
)
def bulk_load(spark, sf_dir):
    """The two loads into a partitioned catalog table, made on the way and read back by name."""
    base = staging_path(spark, "warehouse")
    database = "txlake_" + base.rsplit("-", 1)[1]
    old, new = _merge_inputs(spark, sf_dir)
    for rows, at in ((old, BEFORE), (new, AFTER)):
        as_of = F.lit(at).cast("timestamp")
        table = tables.load_table(rows.select(*TX_ROW), database, "transactions", as_of, base)
    return _plain(spark.table(table))


@query(
    v.with_(
        v.CUSTOMERS, v.TERMINALS,
        body=f"""SELECT 'customer' AS kind, customer_id AS id, x_location + customer_id % 2 AS x_location, y_location,
                 {AUDIT_SQL.format(old="customer_id % 3 > 0", new="customer_id % 2 = 1 OR customer_id % 3 = 0")} FROM customers
                 UNION ALL SELECT 'terminal', terminal_id, x_location + terminal_id % 2, y_location,
                 {AUDIT_SQL.format(old="terminal_id % 3 > 0", new="terminal_id % 2 = 1 OR terminal_id % 3 = 0")} FROM terminals""",
    )
)
def bulk_load_places(spark, sf_dir):
    """Customers and terminals: two thirds at first, then those that moved and those that are new."""
    base = staging_path(spark, "warehouse")
    database = "txlake_" + base.rsplit("-", 1)[1]
    out = []
    for kind, rows in (("customer", v.customers(spark, sf_dir)), ("terminal", v.terminals(spark, sf_dir))):
        key = F.col(f"{kind}_id")
        rows = rows.select(key, "x_location", "y_location")
        moved = rows.where((key % 2 == 1) | (key % 3 == 0)).withColumn("x_location", F.col("x_location") + key % 2)
        tables.load_table(rows.where(key % 3 > 0), database, kind, F.lit(BEFORE).cast("timestamp"), base)
        table = tables.load_table(moved, database, kind, F.lit(AFTER).cast("timestamp"), base)
        out.append(
            spark.table(table).select(
                F.lit(kind).alias("kind"), key.alias("id"), "x_location", "y_location",
                "row_created_timestamp", "row_updated_timestamp",
            )
        )
    return out[0].unionByName(out[1])


def _flat_sql(entity: str, value: str) -> str:
    return ", ".join(
        f"{entity}_id_nb_tx_{n}day_window AS nb_{n}, {entity}_id_{value}_{n}day_window AS value_{n}" for n in (1, 7, 30)
    )


@query(
    v.with_(
        v.TX, v.calendar_sql("a", "2024-01-20"), v.calendar_sql("b", "2024-01-25"), v.calendar_sql("c", "2024-01-28"),
        v.terminal_features_sql(),
        """last_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY terminal_id ORDER BY us DESC, tx_id) AS rn
             FROM term) WHERE rn = 1)""",
        body=f"""SELECT 'customer' AS kind, customer_id AS id, strftime(dt, '%Y-%m-%d') AS dt, {_flat_sql("customer", "avg_amount")},
                 {AUDIT_SQL.format(old="dt < DATE '2024-01-28'", new="dt > DATE '2024-01-20'")}
                 FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
                 UNION ALL SELECT 'terminal', terminal_id, NULL, {_flat_sql("terminal", "risk")},
                 {AUDIT_SQL.format(old="terminal_id % 2 = 0", new="TRUE")} FROM last_""",
    )
)
def bulk_load_features(spark, sf_dir):
    """Dated customer features and undated terminal features, each loaded twice."""
    base = staging_path(spark, "warehouse")
    database = "txlake_" + base.rsplit("-", 1)[1]
    tx = v.transactions(spark, sf_dir)
    days = lambda *days: snapshots.calendar_features_on(tx, [(dt.date(2024, 1, d), 1) for d in days])
    terms = stage(snapshots.terminal_snapshot(tx), "terminal-features")
    loads = {
        "feature_customer": (days(20, 25), days(25, 28)),
        "feature_terminal": (terms.where("terminal_id % 2 = 0"), terms),
    }
    out = []
    for name, (old, new) in loads.items():
        tables.load_table(old, database, name, F.lit(BEFORE).cast("timestamp"), base)
        table = spark.table(tables.load_table(new, database, name, F.lit(AFTER).cast("timestamp"), base))
        entity, value = ("customer", "avg_amount") if "customer" in name else ("terminal", "risk")
        day = F.date_format("dt", "yyyy-MM-dd") if "dt" in table.columns else F.lit(None).cast("string")
        flat = [
            F.col(f"{entity}_id_{v_}_{n}day_window").alias(f"{to}_{n}")
            for n in (1, 7, 30) for v_, to in (("nb_tx", "nb"), (value, "value"))
        ]
        out.append(
            table.select(
                F.lit(entity).alias("kind"), F.col(f"{entity}_id").alias("id"), day.alias("dt"), *flat,
                "row_created_timestamp", "row_updated_timestamp",
            )
        )
    return out[0].unionByName(out[1])


PLACES = ["id", "x_location", "y_location"]


@query(
    v.with_(
        v.CUSTOMERS, v.TERMINALS,
        body="""SELECT 'customer' AS kind, customer_id AS id, x_location + 1 AS x_location, y_location FROM customers
                UNION ALL SELECT 'terminal', terminal_id, x_location + 1, y_location FROM terminals""",
    )
)
def cdc_locations(spark, sf_dir):
    """Customers and terminals from their logs: a snapshot read, then every row moved by one."""

    def state(rows, spec, key):
        def event(op, step, x):
            after = F.struct(F.col(key), x.alias("x_location"), F.col("y_location"))
            position = (F.col(key) * 2 + step).alias("lsn")
            payload = F.struct(
                after.alias("after"), F.struct(position).alias("source"), F.lit(op).alias("op")
            )
            return F.to_json(F.struct(payload.alias("payload")))

        events = F.array(event("r", 0, F.col("x_location")), event("u", 1, F.col("x_location") + 1))
        log = rows.select(F.explode(events).alias("json")).select(
            F.lit(None).cast("binary").alias("key"), F.col("json").cast("binary").alias("value"),
            F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        )
        out = cdc.current_state(log, spec)
        return out.select(F.lit(spec.name.rstrip("s")).alias("kind"), F.col(key).alias("id"), *PLACES[1:])

    return state(v.customers(spark, sf_dir), cdc.CUSTOMERS, "customer_id").unionByName(
        state(v.terminals(spark, sf_dir), cdc.TERMINALS, "terminal_id")
    )


FOLD_DAY = 20


@query(
    v.with_(
        v.TX,
        body=f"""SELECT tx_id, tx_datetime, customer_id, terminal_id, CAST(tx_amount +
                 CASE WHEN tx_time_days >= {FOLD_DAY} AND event_type IN ('view', 'signup') THEN 1 ELSE 0 END AS DOUBLE) AS tx_amount,
                 {AUDIT_SQL.format(old="TRUE", new=f"tx_time_days >= {FOLD_DAY}")} FROM tx
                 WHERE NOT (tx_time_days >= {FOLD_DAY} AND event_type = 'error')""",
    )
)
def cdc_fold_snapshot(spark, sf_dir):
    """A full snapshot brought up to date by the last days' changes, deletes included."""
    tx = v.transactions(spark, sf_dir)
    snapshot = merge.with_audit(tx.select(*TX_ROW), F.lit(BEFORE).cast("timestamp"))
    changes = cdc.parse_changes(v.cdc_log(spark, sf_dir), cdc.TRANSACTIONS).where(
        F.col("tx_datetime") >= F.lit(v.ORIGIN + dt.timedelta(days=FOLD_DAY)).cast("timestamp")
    )
    return _plain(
        ingest.fold_into(snapshot, cdc.TRANSACTIONS, changes, F.lit(AFTER).cast("timestamp"))
    )


# --- serving joins --------------------------------------------------------------------------

SNAPSHOT_DATES = (8, 15, 22)


def _serving_features(spark, sf_dir):
    tx = v.transactions(spark, sf_dir)
    cust = snapshots.calendar_features_on(tx, [(dt.date(2024, 1, d), 1) for d in SNAPSHOT_DATES])
    risk = terminal_risk_features(tx.select("tx_id", "terminal_id", "tx_datetime", "tx_fraud"))
    term = snapshots.latest_features(
        risk, "terminal_id", TERMINAL_FEATURES, dt.date(2024, 1, 15)
    )
    return tx, cust, term


def _zero(names, alias):
    return ", ".join(f"coalesce({alias}.{c}, 0) AS {c}" for c in names)


ENRICH_SQL = v.with_(
    v.TX, *[v.calendar_sql(f"c{d}", f"2024-01-{d:02d}") for d in SNAPSHOT_DATES],
    "fc AS (" + " UNION ALL ".join(f"SELECT * FROM c{d}" for d in SNAPSHOT_DATES) + ")",
    v.terminal_features_sql(),
    """ft AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY terminal_id ORDER BY us DESC, tx_id) AS rn
       FROM term WHERE CAST(tx_datetime AS DATE) <= DATE '2024-01-15') WHERE rn = 1)""",
    "dated AS (SELECT *, CAST(tx_datetime AS DATE) AS d FROM tx)",
    body=f"""SELECT t.tx_id, {WEEKEND_SQL.replace('tx_datetime', 't.tx_datetime')},
             {NIGHT_SQL.replace('tx_datetime', 't.tx_datetime')},
             {_zero(CUSTOMER_FEATURES, 'fc')}, {_zero(TERMINAL_FEATURES, 'ft')},
             CASE WHEN fc.customer_id IS NULL THEN 1 ELSE 0 END
               + CASE WHEN ft.terminal_id IS NULL THEN 2 ELSE 0 END AS features_missing
             FROM dated t ASOF LEFT JOIN fc ON t.customer_id = fc.customer_id AND t.d > fc.dt
             LEFT JOIN ft ON t.terminal_id = ft.terminal_id""",
)
ENRICHED = ["tx_id", "tx_during_weekend", "tx_during_night", *CUSTOMER_FEATURES, *TERMINAL_FEATURES, "features_missing"]


@query(ENRICH_SQL)
def enrich_transactions(spark, sf_dir):
    tx, cust, term = _serving_features(spark, sf_dir)
    return snapshots.enrich(tx, cust, term).select(*ENRICHED)


def _feature_store(spark, sf_dir, base):
    """The transactions, and a store with one version per snapshot date."""
    tx, cust, term = _serving_features(spark, sf_dir)
    cust, term = stage(cust, "feature-customer"), stage(term, "feature-terminal")
    store = FeatureStore(spark, f"{base}/features")
    for d in SNAPSHOT_DATES:
        date = dt.date(2024, 1, d)
        store.publish(date, cust.where(F.col("dt") == date), term)
    return tx, store, cust, term


def _transaction_stream(spark, tx, base):
    tx.repartition(4, "tx_id").write.parquet(f"{base}/transactions")
    return scoring.stream_table(spark, f"{base}/transactions", tx.schema, max_files=2)


@query(ENRICH_SQL)
def stream_enrich(spark, sf_dir):
    """The same enrichment with the transactions arriving as a stream."""
    base = staging_path(spark, "enrich")
    tx, store, _, _ = _feature_store(spark, sf_dir, base)
    scoring.start_scoring(
        _transaction_stream(spark, tx, base), store, None, f"{base}/out", f"{base}/offsets", interval=None
    ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select(*ENRICHED)


@query(ENRICH_SQL)
def stream_append(spark, sf_dir):
    """The same enrichment as one append stream, triggered every second until all is read."""
    base = staging_path(spark, "append")
    tx, cust, term = _serving_features(spark, sf_dir)
    cust, term = stage(cust, "feature-customer"), stage(term, "feature-terminal")
    rows = snapshots.enrich(_transaction_stream(spark, tx, base), cust, term)
    running = scoring.start_append(rows, f"{base}/out", f"{base}/offsets", interval="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(f"{base}/out").select(*ENRICHED)


# --- features from daily panes ----------------------------------------------------------------


def _change_batches(tx):
    """Three batches of changes that end in ``tx``: rows with wrong values and dates, then the rest with
    the corrections, then what must not be there is taken away."""
    signed = lambda df, sign: df.withColumn("sign", F.lit(sign))
    early, wrong, ghost = F.col("tx_id") % 3 != 1, F.col("tx_id") % 4 == 0, F.col("tx_id") % 7 == 0
    amount = F.when(wrong, F.col("tx_amount") + 5).otherwise(F.col("tx_amount")).cast("decimal(10,2)")
    first = tx.where(early).withColumns({"tx_amount": amount, "tx_fraud": F.when(wrong, 1 - F.col("tx_fraud")).otherwise(F.col("tx_fraud"))})
    ghosts = tx.where(ghost).withColumn("tx_datetime", F.col("tx_datetime") - F.expr("INTERVAL 1 DAY"))
    second = signed(first.where(wrong), -1).unionByName(signed(tx.where(early & wrong), 1)).unionByName(signed(tx.where(~early), 1))
    return [signed(first, 1), second.unionByName(signed(ghosts, 1)), signed(ghosts, -1)]


@query(
    v.with_(
        v.TX, v.customer_features_sql(), v.terminal_features_sql(source="cust"),
        body=f"SELECT tx_id, {CUST}, {TERM} FROM term",
    )
)
def pane_features(spark, sf_dir):
    """All window features from panes that three batches of changes have brought up to date."""
    base = staging_path(spark, "panes")
    tx = v.transactions(spark, sf_dir).select("tx_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount", "tx_fraud")
    stores = {e: panes.PaneStore(spark, f"{base}/{e}", e) for e in ("customer_id", "terminal_id")}
    for epoch, batch in enumerate(_change_batches(tx)):
        for store in stores.values():
            store.apply(batch, epoch)
    rows = panes.customer_features(tx, stores["customer_id"].panes(), tx)
    rows = panes.terminal_features(rows, stores["terminal_id"].panes(), tx, asked_in=tx)
    return rows.select("tx_id", *CUSTOMER_FEATURES, *TERMINAL_FEATURES)


# --- statistics and sources -----------------------------------------------------------------

DAILY_SQL = """daily AS (SELECT tx_time_days, count(customer_id) AS nb_tx_per_day,
  CAST(sum(tx_fraud) AS BIGINT) AS nb_fraudulent_transactions_per_day,
  count(DISTINCT CASE WHEN tx_fraud = 1 THEN customer_id END) AS nb_compromised_cards_per_day
  FROM tx GROUP BY tx_time_days)"""


@query(
    v.with_(
        v.TX, DAILY_SQL,
        body="""SELECT *, strftime(DATE '2024-01-01' + CAST(tx_time_days AS INTEGER), '%Y-%m-%d') AS tx_date
                FROM daily""",
    )
)
def daily_stats(spark, sf_dir):
    return _plain(stats.daily_stats(v.transactions(spark, sf_dir), v.ORIGIN))


@query(
    v.with_(
        v.TX, DAILY_SQL,
        body="""SELECT tx_time_days, 'nb_tx_per_day' AS stat_type, nb_tx_per_day / CAST(50 AS DOUBLE) AS value FROM daily
                UNION ALL SELECT tx_time_days, 'nb_fraud_per_day', CAST(nb_fraudulent_transactions_per_day AS DOUBLE) FROM daily
                UNION ALL SELECT tx_time_days, 'nb_fraudcard_per_day', CAST(nb_compromised_cards_per_day AS DOUBLE) FROM daily""",
    )
)
def daily_stats_long(spark, sf_dir):
    return stats.daily_stats_long(stats.daily_stats(v.transactions(spark, sf_dir), v.ORIGIN))


RANGES = [(0, 9), (5, 25), (0, 29), (12, 12)]


@query(
    v.with_(
        v.TX, f"ranges AS (SELECT * FROM (VALUES {', '.join(map(str, RANGES))}) AS r(first, last))",
        body="""SELECT first, last, count(*) AS n, CAST(sum(tx_fraud) AS BIGINT) AS frauds, TRUE AS p25, TRUE AS p50, TRUE AS p75,
                TRUE AS cards, TRUE AS bad_cards FROM ranges JOIN tx ON tx_time_days BETWEEN first AND last GROUP BY first, last""",
    )
)
def sketch_ranges(spark, sf_dir):
    """Ranges of days from daily sketches: exact counts, and whether each estimate is within its bound of the
    exact figure (2% of the ranks, 8% of the distinct cards)."""
    tx = v.transactions(spark, sf_dir)
    daily = stage(sketches.daily_sketches(tx), "daily-sketches")
    ranges = spark.createDataFrame(RANGES, "first long, last long")
    found = sketches.merged_ranges(daily, ranges)
    inside = tx.join(F.broadcast(found), F.col("tx_time_days").between(F.col("first"), F.col("last")))
    share = lambda q: F.avg((F.col("tx_amount").cast("double") <= F.col(f"p{q}")).cast("double"))
    bad = F.when(F.col("tx_fraud") == 1, F.col("customer_id"))
    close = lambda name, exact: F.abs(F.max(name) - F.count_distinct(exact)) <= 0.08 * F.count_distinct(exact)
    return inside.groupBy("first", "last").agg(
        F.max("n").alias("n"), F.max("frauds").alias("frauds"),
        *[(F.abs(share(q) - q / 100) < 0.02 + 1 / F.count(F.lit(1))).alias(f"p{q}") for q in (25, 50, 75)],
        close("cards", F.col("customer_id")).alias("cards"), close("bad_cards", bad).alias("bad_cards"),
    )


PROFILED = ["tx_amount", "tx_fraud", "tx_time_days", "terminal_id"]


@query(
    v.with_(
        v.TX,
        "long AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM tx" for c in PROFILED)
        + ")",
        body="""SELECT "column", count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
                min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
                round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM long GROUP BY "column" """,
    )
)
def profile(spark, sf_dir):
    out = stats.profile(v.transactions(spark, sf_dir), PROFILED)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


RANGE_SQL = v.with_(
    v.TX,
    body="""SELECT tx_id, tx_datetime, CASE WHEN customer_id = -1 THEN 0 ELSE customer_id END AS customer_id, terminal_id,
            CAST(tx_amount AS DOUBLE) AS tx_amount,
            strftime(CAST(tx_datetime AS DATE), '%Y-%m-%d') AS dt FROM tx
            WHERE CAST(tx_datetime AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""",
)


@query(RANGE_SQL)
def load_date_range(spark, sf_dir):
    """The given rows by date range; the range on the raw time reaches the Parquet reader."""
    tx = v.transactions(spark, sf_dir).select(*TX_ROW)
    begin, end = dt.date(2024, 1, 8), dt.date(2024, 1, 21)
    rows = files.in_time_range(tx, begin, end + dt.timedelta(days=1))
    return _plain(rows.withColumn("dt", F.to_date("tx_datetime")).replace(-1, 0))


@query(RANGE_SQL)
def write_daily(spark, sf_dir):
    """All days written as daily partitions, then a range of days read back."""
    path = staging_path(spark, "daily")
    files.write_daily(v.transactions(spark, sf_dir).select(*TX_ROW), path)
    rows = files.read_range(spark, path, dt.date(2024, 1, 8), dt.date(2024, 1, 21))
    return _plain(rows)


@query(
    v.with_(
        v.TX,
        body="""SELECT customer_id, count(*) AS nb_tx, CAST(sum(tx_fraud) AS BIGINT) AS nb_fraud
                FROM tx GROUP BY customer_id HAVING sum(tx_fraud) > 0""",
    )
)
def adhoc_sql(spark, sf_dir):
    return tables.run_sql(
        spark,
        "SELECT customer_id, count(*) AS nb_tx, sum(tx_fraud) AS nb_fraud FROM {tx} "
        "GROUP BY customer_id HAVING sum(tx_fraud) > 0",
        tx=v.transactions(spark, sf_dir),
    )


@query(
    "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS transaction_id FROM orders"
)
def assign_sequential_ids(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return sequential_ids(o, ["o_orderdate", "o_orderkey"], "transaction_id").select(
        "o_orderkey", "transaction_id"
    )


@query(
    """SELECT event_id AS tx_id, TIMESTAMP '2024-01-01' + to_microseconds(CAST(floor(
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1000000) AS BIGINT) * 1000000) AS tx_datetime FROM events"""
)
def seconds_to_timestamp(spark, sf_dir):
    """Whole seconds since the first day, turned back into time."""
    tx = v.transactions(spark, sf_dir)
    origin = F.unix_seconds(F.lit(v.ORIGIN).cast("timestamp"))
    seconds = F.unix_seconds("tx_datetime") - origin
    return tx.select("tx_id", from_seconds(seconds, v.ORIGIN).alias("tx_datetime"))


# --- labels and places ----------------------------------------------------------------------

RADIUS = 5.0


@query(
    v.with_(
        v.CUSTOMERS, v.TERMINALS,
        body=f"""SELECT c.customer_id, coalesce(string_agg(CAST(t.terminal_id AS VARCHAR), ',' ORDER BY t.terminal_id), '')
                 AS available_terminals, count(t.terminal_id) AS nb_terminals
                 FROM customers c LEFT JOIN terminals t ON sqrt((c.x_location - t.x_location) * (c.x_location - t.x_location)
                   + (c.y_location - t.y_location) * (c.y_location - t.y_location)) < {RADIUS}
                 GROUP BY c.customer_id""",
    )
)
def within_radius(spark, sf_dir):
    out = radius.within_radius(v.customers(spark, sf_dir), v.terminals(spark, sf_dir), RADIUS)
    return out.select(
        "customer_id",
        F.array_join(F.col("available_terminals").cast("array<string>"), ",").alias(
            "available_terminals"
        ),
        F.col("nb_terminals").cast("long").alias("nb_terminals"),
    )


@query(
    v.with_(
        v.CUSTOMERS, v.TERMINALS,
        body=f"""SELECT c.customer_id, t.terminal_id FROM customers c JOIN terminals t
                 ON sqrt((c.x_location - t.x_location) * (c.x_location - t.x_location)
                   + (c.y_location - t.y_location) * (c.y_location - t.y_location)) < {RADIUS}""",
    )
)
def pairs_within_radius(spark, sf_dir):
    """One row per customer and terminal in reach."""
    return radius.pairs_within_radius(v.customers(spark, sf_dir), v.terminals(spark, sf_dir), RADIUS)


def _labelled(spark, sf_dir):
    tx = v.transactions(spark, sf_dir).drop("tx_fraud")
    return labels.label_scenarios(
        tx, v.compromises(tx, "terminal_id", 2), v.compromises(tx, "customer_id", 3)
    )


LABELS = (
    v.TX, v.compromises_sql("ct", "terminal_id", 2), v.compromises_sql("cc", "customer_id", 3),
    """inside AS (SELECT tx.tx_id, cc.start_day, row_number() OVER (PARTITION BY cc.start_day ORDER BY
         substr(md5(tx.tx_id || '|' || cc.start_day), 1, 8), tx.tx_id) AS rn, count(*) OVER (PARTITION BY cc.start_day) AS n
         FROM tx JOIN cc ON tx.customer_id = cc.customer_id
           AND tx.tx_time_days >= cc.start_day AND tx.tx_time_days < cc.start_day + 14)""",
    "hits AS (SELECT tx_id, count(*) AS h FROM inside WHERE rn <= n // 3 GROUP BY tx_id)",
    """flags AS (SELECT tx.*, CASE WHEN tx_amount > 220 THEN 1 ELSE 0 END AS scenario_1,
         CASE WHEN EXISTS (SELECT 1 FROM ct WHERE ct.terminal_id = tx.terminal_id AND tx.tx_time_days >= ct.start_day
           AND tx.tx_time_days < ct.start_day + 28) THEN 1 ELSE 0 END AS scenario_2,
         coalesce(h, 0) AS scenario_3_hits FROM tx LEFT JOIN hits ON hits.tx_id = tx.tx_id)""",
    """labelled AS (SELECT tx_id, CAST(CAST(cents AS HUGEINT) * CAST(pow(5, scenario_3_hits) AS HUGEINT) AS DOUBLE) / 100 AS tx_amount,
         CASE WHEN scenario_3_hits > 0 THEN 3 WHEN scenario_2 = 1 THEN 2 WHEN scenario_1 = 1 THEN 1 ELSE 0 END AS tx_fraud_scenario,
         scenario_1, scenario_2, scenario_3_hits FROM flags)""",
)


@query(
    v.with_(
        *LABELS,
        body="SELECT *, CASE WHEN tx_fraud_scenario > 0 THEN 1 ELSE 0 END AS tx_fraud FROM labelled",
    )
)
def label_scenarios(spark, sf_dir):
    return _plain(
        _labelled(spark, sf_dir).select(
            "tx_id", "tx_amount", "tx_fraud", "tx_fraud_scenario", "scenario_1", "scenario_2",
            "scenario_3_hits",
        )
    )


@query(
    v.with_(
        *LABELS,
        body="""SELECT count(*) AS nb_tx, count(*) FILTER (WHERE tx_fraud_scenario > 0) AS nb_fraud,
                count(*) FILTER (WHERE tx_fraud_scenario > 0) / CAST(count(*) AS DOUBLE) AS fraud_ratio,
                count(*) FILTER (WHERE tx_fraud_scenario = 1) AS nb_scenario_1,
                count(*) FILTER (WHERE tx_fraud_scenario = 2) AS nb_scenario_2,
                count(*) FILTER (WHERE tx_fraud_scenario = 3) AS nb_scenario_3,
                count(*) FILTER (WHERE scenario_1 = 1) AS added_by_scenario_1,
                count(*) FILTER (WHERE scenario_2 = 1 AND scenario_1 = 0) AS added_by_scenario_2,
                count(*) FILTER (WHERE scenario_3_hits > 0 AND scenario_2 = 0 AND scenario_1 = 0) AS added_by_scenario_3
                FROM labelled""",
    )
)
def fraud_summary(spark, sf_dir):
    return labels.fraud_summary(_labelled(spark, sf_dir))


# --- splits ---------------------------------------------------------------------------------

FOLDS, START = 3, 8


def _folds_tables(starts: list[int], with_delay: bool, days: int = 7) -> list[str]:
    """Tables ending in ``split_``: the rows of each fold; train, delay and test take ``days`` each."""
    folds = ", ".join(f"({i}, {s})" for i, s in enumerate(starts))
    delay = "" if with_delay else " AND split <> 'delay'"
    return [
        v.TX, f"folds AS (SELECT * FROM (VALUES {folds}) AS f(fold, b))",
        f"""rows_ AS (SELECT tx.*, fold, b, CASE WHEN tx_time_days < b + {days} THEN 'train'
             WHEN tx_time_days < b + {2 * days} THEN 'delay' ELSE 'test' END AS split
             FROM tx JOIN folds ON tx_time_days >= b AND tx_time_days < b + {3 * days})""",
        f"""split_ AS (SELECT * FROM rows_ r WHERE NOT (split = 'test' AND EXISTS (
                 SELECT 1 FROM tx k WHERE k.customer_id = r.customer_id AND k.tx_fraud = 1
                   AND k.tx_time_days >= r.b AND k.tx_time_days <= r.tx_time_days - {days + 1})){delay})""",
    ]


def _folds_sql(starts: list[int], with_delay: bool, days: int = 7) -> str:
    return v.with_(*_folds_tables(starts, with_delay, days), body="SELECT tx_id, fold, split FROM split_")


@query(_folds_sql([START], True).replace("SELECT tx_id, fold, split", "SELECT tx_id, split"))
def split_train_delay_test(spark, sf_dir):
    tx = v.transactions(spark, sf_dir)
    return splits.split_train_delay_test(tx, START, origin=v.ORIGIN).select("tx_id", "split")


@query(_folds_sql([15, 10, 5], False, 5))
def prequential_folds(spark, sf_dir):
    """Three whole folds of 15 days."""
    folds = splits.prequential_folds(v.transactions(spark, sf_dir), 15, FOLDS, 5, 5, 5, origin=v.ORIGIN)
    return folds.select("tx_id", "fold", "split")


HASH = "CAST(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE)"


@query(
    v.with_(
        v.TX,
        body=f"""SELECT tx_id, tx_fraud FROM tx WHERE {HASH.format("tx_id || '|7'")} <
                 CASE WHEN tx_fraud = 1 THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END""",
    )
)
def stratified_sample(spark, sf_dir):
    return splits.stratified_sample(v.transactions(spark, sf_dir), {0: 0.1, 1: 0.8}, seed=7).select(
        "tx_id", "tx_fraud"
    )


@query(
    v.with_(
        v.TX,
        body="""SELECT tx_id, tx_fraud, (row_number() OVER (PARTITION BY tx_fraud ORDER BY
                substr(md5(tx_id || '|0'), 1, 8), tx_id) - 1) % 5 AS fold FROM tx""",
    )
)
def stratified_folds(spark, sf_dir):
    tx = v.transactions(spark, sf_dir).select("tx_id", "tx_fraud")
    return splits.stratified_folds(tx, 5)


# --- metrics --------------------------------------------------------------------------------

TOP = 20
THRESHOLDS = [round(0.1 * i, 1) for i in range(12)]

RANKING = """hist AS (SELECT model, score, sum(tx_fraud) AS p, sum(1 - tx_fraud) AS n FROM model_scores GROUP BY model, score),
cum AS (SELECT *, coalesce(sum(p) OVER w, 0) AS tp0, coalesce(sum(n) OVER w, 0) AS fp0 FROM hist
  WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ranking AS (SELECT model, round(sum(CAST(n AS DOUBLE) * (tp0 + p * CAST(0.5 AS DOUBLE))) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS auc_roc,
  round(sum(CAST(p AS DOUBLE) * (CAST(tp0 + p AS DOUBLE) / (tp0 + p + fp0 + n))) / sum(p), 6) AS average_precision
  FROM cum GROUP BY model)"""
# Unrounded; without frauds the area is null and the precision 0.
RANKING_RAW = (
    RANKING.replace("round(sum(", "(sum(").replace(", 6) AS", ") AS")
    .replace("/ (CAST(sum(p) AS DOUBLE) * sum(n))", "/ nullif(CAST(sum(p) AS DOUBLE) * sum(n), 0)")
    .replace("/ sum(p))", "/ greatest(sum(p), 1))")
)


@query(v.with_(v.TX, v.SCORED, v.MODEL_SCORES, RANKING, body="SELECT * FROM ranking"))
def ranking_metrics(spark, sf_dir):
    out = metrics.ranking_metrics(v.model_scores(spark, sf_dir), ["model"])
    return out.withColumns({c: F.round(c, 6) for c in ("auc_roc", "average_precision")})


@query(
    v.with_(
        v.TX, v.SCORED, v.MODEL_SCORES,
        "cuts AS (SELECT CAST(unnest([" + ", ".join(map(str, THRESHOLDS)) + "]) AS DOUBLE) AS threshold)",
        """m AS (SELECT model, threshold, CAST(count(*) FILTER (WHERE score < threshold AND tx_fraud = 0) AS DOUBLE) AS tn,
             CAST(count(*) FILTER (WHERE score >= threshold AND tx_fraud = 0) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE score < threshold AND tx_fraud = 1) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (WHERE score >= threshold AND tx_fraud = 1) AS DOUBLE) AS tp
             FROM model_scores, cuts GROUP BY model, threshold)""",
        """r AS (SELECT model, threshold, (fp + fn) / (tn + fp + fn + tp) AS mme, tp / nullif(tp + fn, 0) AS tpr,
             tn / nullif(tn + fp, 0) AS tnr, fp / nullif(tn + fp, 0) AS fpr, fn / nullif(tp + fn, 0) AS fnr,
             CASE WHEN tp + fp = 0 THEN 1 ELSE tp / (tp + fp) END AS precision,
             CASE WHEN tn + fn = 0 THEN 1 ELSE tn / (tn + fn) END AS npv,
             CASE WHEN tp + fp = 0 THEN 1 ELSE fp / (tp + fp) END AS fdr,
             CASE WHEN tn + fn = 0 THEN 1 ELSE fn / (tn + fn) END AS "for" FROM m)""",
        body="""SELECT model, threshold, mme, tpr, tnr, fpr, fnr, CAST(0.5 AS DOUBLE) * (fpr + fnr) AS ber,
                sqrt(tpr * tnr) AS g_mean, precision, npv, fdr, "for",
                CASE WHEN precision + tpr = 0 THEN NULL ELSE CAST(2 AS DOUBLE) * (precision * tpr) / (precision + tpr) END AS f1
                FROM r""",
    )
)
def threshold_metrics(spark, sf_dir):
    return metrics.threshold_metrics(v.model_scores(spark, sf_dir), ["model"], THRESHOLDS)


@query(
    v.with_(
        v.TX, v.SCORED,
        body="SELECT tx_id, score, CASE WHEN score < CAST(0.5 AS DOUBLE) THEN 0 ELSE 1 END AS predicted FROM scored",
    )
)
def classify_threshold(spark, sf_dir):
    return v.scored(spark, sf_dir).select(
        "tx_id", "score", predicted_class(F.col("score"), 0.5).alias("predicted")
    )


CARDS = """cards AS (SELECT model, tx_time_days, customer_id, max(score) AS score, max(tx_fraud) AS label
  FROM model_scores GROUP BY model, tx_time_days, customer_id)"""


@query(v.with_(v.TX, v.SCORED, v.MODEL_SCORES, CARDS, body="SELECT * FROM cards"))
def card_day_scores(spark, sf_dir):
    return metrics.card_day_scores(v.model_scores(spark, sf_dir), ["model"])


@query(
    v.with_(
        v.TX, v.SCORED, v.MODEL_SCORES, CARDS,
        f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY model, tx_time_days ORDER BY score DESC, customer_id) AS rn
             FROM cards)""",
        body=f"""SELECT model, tx_time_days, CAST(sum(label) AS BIGINT) AS nb_compromised_cards,
                 count(*) FILTER (WHERE rn <= {TOP} AND label = 1) AS nb_detected_cards,
                 count(*) FILTER (WHERE rn <= {TOP} AND label = 1) / CAST({TOP} AS DOUBLE) AS card_precision
                 FROM ranked GROUP BY model, tx_time_days""",
    )
)
def card_precision_topk_day(spark, sf_dir):
    return metrics.card_precision_per_day(v.model_scores(spark, sf_dir), ["model"], TOP, False)


# Day by day: each step takes the day's best cards among those not detected before.
WALK = f"""dayno AS (SELECT model, tx_time_days, row_number() OVER (PARTITION BY model ORDER BY tx_time_days) AS i
  FROM (SELECT DISTINCT model, tx_time_days FROM cards)),
byday AS (SELECT cards.*, dayno.i FROM cards JOIN dayno USING (model, tx_time_days)),
walk(model, i, gone, pool, found) AS (
  SELECT DISTINCT model, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM cards
  UNION ALL
  SELECT w.model, w.i + 1, list_concat(w.gone, x.f), x.pool, CAST(len(x.f) AS BIGINT) FROM walk w, LATERAL (
    SELECT coalesce(list(customer_id) FILTER (WHERE rn <= {TOP} AND label = 1), []) AS f,
           count(*) FILTER (WHERE label = 1) AS pool FROM (
      SELECT customer_id, label, row_number() OVER (ORDER BY score DESC, customer_id) AS rn
      FROM byday b WHERE b.model = w.model AND b.i = w.i + 1 AND NOT list_contains(w.gone, b.customer_id))) x
  WHERE w.i < (SELECT max(i) FROM dayno)),
per_day AS (SELECT walk.model, tx_time_days, pool AS nb_compromised_cards, found AS nb_detected_cards,
  found / CAST({TOP} AS DOUBLE) AS card_precision FROM walk JOIN dayno ON walk.model = dayno.model AND walk.i = dayno.i)"""


@query(v.with_(v.TX, v.SCORED, v.MODEL_SCORES, CARDS, WALK, body="SELECT * FROM per_day", recursive=True))
def card_precision_topk(spark, sf_dir):
    return metrics.card_precision_per_day(v.model_scores(spark, sf_dir), ["model"], TOP)


@query(
    v.with_(
        v.TX, v.SCORED, v.MODEL_SCORES, CARDS, WALK, RANKING,
        body=f"""SELECT ranking.model, auc_roc, average_precision, round(avg(card_precision), 6) AS card_precision_at_{TOP}
                 FROM ranking JOIN per_day ON per_day.model = ranking.model
                 GROUP BY ranking.model, auc_roc, average_precision""",
        recursive=True,
    )
)
def performance_report(spark, sf_dir):
    out = metrics.performance_report(v.model_scores(spark, sf_dir), ["model"], [TOP], decimals=None)
    return out.select("model", *[F.round(c, 6).alias(c) for c in out.columns if c != "model"])


@query(
    v.with_(
        v.TX, v.SCORED, v.MODEL_SCORES, CARDS, WALK, RANKING,
        body=f"""SELECT ranking.model, round_even(auc_roc, 3) AS auc_roc, round_even(average_precision, 3) AS average_precision,
                 round_even(avg(card_precision), 3) AS card_precision_at_{TOP}
                 FROM ranking JOIN per_day ON per_day.model = ranking.model
                 GROUP BY ranking.model, auc_roc, average_precision""",
        recursive=True,
    )
)
def performance_report_rounded(spark, sf_dir):
    """The report as it is printed: three digits, half to even."""
    return metrics.performance_report(v.model_scores(spark, sf_dir), ["model"], [TOP])


@query(
    v.with_(
        v.TX, v.SCORED, v.MODEL_SCORES, CARDS, WALK,
        body="SELECT model, round(avg(card_precision), 6) AS card_precision FROM per_day GROUP BY model", recursive=True,
    )
)
def card_precision_separate(spark, sf_dir):
    """Card precision of predictions that are kept apart from their transactions, model by model."""
    tx, scores = v.transactions(spark, sf_dir), v.model_scores(spark, sf_dir)
    models_ = ("amount", "constant", "hash")
    found = [(m, metrics.card_precision_of(tx, scores.where(F.col("model") == m).select("tx_id", "score"), TOP)) for m in models_]
    return spark.createDataFrame(found, "model string, card_precision double").withColumn("card_precision", F.round("card_precision", 6))


SCALED = ["tx_amount", "tx_during_weekend", "tx_during_night", "terminal_id"]


def _scaled_sql():
    return ", ".join(
        f"round((CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM train)) / "
        f"(SELECT coalesce(nullif(stddev_pop(CAST({c} AS DOUBLE)), 0), 1) FROM train), 6) + CAST(0 AS DOUBLE) AS {c}"
        for c in SCALED
    )


@query(
    v.with_(
        v.TX, f"f AS (SELECT tx_id, tx_time_days, tx_amount, terminal_id, {WEEKEND_SQL}, {NIGHT_SQL} FROM tx)",
        "train AS (SELECT * FROM f WHERE tx_time_days < 21)",
        body=f"SELECT tx_id, {_scaled_sql()} FROM f",
    )
)
def scale_features(spark, sf_dir):
    """Fitted on the first three weeks, applied to all rows."""
    rows = with_flags(v.transactions(spark, sf_dir)).select("tx_id", "tx_time_days", *SCALED)
    scaler = stats.fit_scaler(rows.where("tx_time_days < 21"), SCALED)
    out = stats.scale_features(rows, scaler)
    zero = F.lit(0.0).cast("double")
    return out.select("tx_id", *[(F.round(c, 6) + zero).alias(c) for c in SCALED])


# --- models (learners of two engines never agree bit by bit: facts about them, or a fixed rule) --


def _split_features(spark, sf_dir, start=START):
    # The days of the split and the 37 before them that features look back on.
    begin, end = (v.ORIGIN + dt.timedelta(days=d) for d in (start - 37, start + 21))
    tx = files.in_time_range(v.transactions(spark, sf_dir), begin, end)
    rows = splits.split_train_delay_test(feature_frame(tx), start, with_delay=False, origin=v.ORIGIN)
    rows = rows.select("tx_id", "customer_id", "tx_time_days", "tx_fraud", "split", *FEATURES)
    staged = stage(rows, "split-features", ["split"])
    return staged.where("split = 'train'"), staged.where("split = 'test'")


LEARNERS = ", ".join(f"('{name}')" for name in models.NAMES)


@query(
    v.with_(
        *_folds_tables([START], False),
        f"learners AS (SELECT * FROM (VALUES {LEARNERS}) AS l(model))",
        body=f"""SELECT model, count(*) FILTER (WHERE split = 'train') AS train_rows,
                 CAST(sum(tx_fraud) FILTER (WHERE split = 'train') AS BIGINT) AS train_frauds,
                 count(*) FILTER (WHERE split = 'test') AS scored_rows,
                 CAST(sum(tx_fraud) FILTER (WHERE split = 'test') AS BIGINT) AS scored_frauds,
                 {len(FEATURES)} AS features, TRUE AS in_range, TRUE AS timed,
                 CASE WHEN sum(tx_fraud) FILTER (WHERE split = 'test') > 0 THEN TRUE END AS better_than_chance
                 FROM split_, learners GROUP BY model""",
    )
)
def train_and_score(spark, sf_dir):
    """Five learners on the same split: what each was trained on and scored, and that its scores are
    probabilities, better than chance on the held-out rows."""
    train, test = _split_features(spark, sf_dir)
    _, scored, times = models.fit_and_score(models.classifiers(), train, test)
    seen = train.agg(F.count(F.lit(1)).alias("train_rows"), F.sum(F.col("tx_fraud").cast("long")).alias("train_frauds"))
    counted = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("scored_rows"), F.sum(F.col("tx_fraud").cast("long")).alias("scored_frauds"),
        F.every(F.col("score").between(0, 1)).alias("in_range"),
    )
    ranked = metrics.ranking_metrics(scored, ["model"]).select("model", (F.col("auc_roc") > 0.5).alias("better_than_chance"))
    timed = (F.col("training_execution_time") > 0) & (F.col("prediction_execution_time") > 0)
    # One row each: the training counts meet every learner.
    return (
        counted.join(ranked, "model").join(times.select("model", timed.alias("timed")), "model")
        .join(F.broadcast(seen), F.lit(True))
        .withColumn("features", F.lit(len(FEATURES)))
    )


# A fixed linear rule, standing for a model trained elsewhere.
WEIGHTS = {"tx_amount": 0.02, "tx_during_weekend": -0.5, "tx_during_night": 0.75}
BIAS = -3.0


def _load_linear_model():
    import numpy as np

    weights = np.array(list(WEIGHTS.values()))
    return lambda frame: 1.0 / (1.0 + np.exp(-(frame.to_numpy() @ weights + BIAS)))


@query(
    v.with_(
        v.TX, f"f AS (SELECT tx_id, CAST(tx_amount AS DOUBLE) AS tx_amount, {WEEKEND_SQL}, {NIGHT_SQL} FROM tx)",
        body="SELECT tx_id, round(1 / (1 + exp(-("
        + " + ".join(f"CAST({w} AS DOUBLE) * {c}" for c, w in WEIGHTS.items())
        + f" + CAST({BIAS} AS DOUBLE)))), 6) AS prediction FROM f",
    )
)
def score_foreign_model(spark, sf_dir):
    """A Python model applied by Arrow batches."""
    rows = with_flags(v.transactions(spark, sf_dir))
    out = models.score_with(rows, _load_linear_model, list(WEIGHTS))
    return out.select("tx_id", F.round("prediction", 6).alias("prediction"))


SERVED = {**WEIGHTS, "customer_id_avg_amount_7day_window": -0.01, "terminal_id_risk_30day_window": 4.0}


def _load_serving_model():
    import numpy as np

    weights = np.array(list(SERVED.values()))
    return lambda frame: 1.0 / (1.0 + np.exp(-(frame.to_numpy() @ weights + BIAS)))


@query(
    f"SELECT tx_id, features_missing, round(1 / (1 + exp(-("
    + " + ".join(f"CAST({w} AS DOUBLE) * {c}" for c, w in SERVED.items())
    + f" + CAST({BIAS} AS DOUBLE)))), 6) AS prediction FROM ("
    + ENRICH_SQL.replace("SELECT t.tx_id,", "SELECT t.tx_id, CAST(t.tx_amount AS DOUBLE) AS tx_amount,")
    + ")"
)
def stream_score_foreign_model(spark, sf_dir):
    """Stream, enrichment and a fixed Python model end to end."""
    base = staging_path(spark, "score")
    tx, store, _, _ = _feature_store(spark, sf_dir, base)
    scoring.start_scoring(
        _transaction_stream(spark, tx, base), store,
        lambda rows: models.score_with(rows, _load_serving_model, list(SERVED)),
        f"{base}/out", f"{base}/offsets", interval=None,
    ).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("tx_id", "features_missing", F.round("prediction", 6).alias("prediction"))


@query(
    f"SELECT tx_id, features_missing, TRUE AS in_range, TRUE AS processed, TRUE AS as_in_batch FROM ({ENRICH_SQL})"
)
def stream_score(spark, sf_dir):
    """Train on past days, store the model, load it and score the transactions as a stream; the same
    model in a batch gives the same scores."""
    base = staging_path(spark, "score")
    train, _ = _split_features(spark, sf_dir)
    logistic = models.classifiers()["logistic_regression"]
    fitted = models.fit(logistic, train)
    models.save(fitted, f"{base}/model")
    tx, store, cust, term = _feature_store(spark, sf_dir, base)
    scoring.start_scoring(
        _transaction_stream(spark, tx, base), store, models.load(f"{base}/model"),
        f"{base}/out", f"{base}/offsets", interval=None,
    ).awaitTermination()
    batch = scoring.scored(tx, cust, term, fitted).select("tx_id", F.col("prediction").alias("batch_prediction"))
    same = F.abs(F.col("prediction") - F.col("batch_prediction")) < 1e-12
    return spark.read.parquet(f"{base}/out").join(batch, "tx_id", "left").select(
        "tx_id", "features_missing", F.col("prediction").between(0, 1).alias("in_range"),
        F.col("processed_at").isNotNull().alias("processed"), same.alias("as_in_batch"),
    )


def _model_rows(spark, sf_dir):
    return feature_frame(v.transactions(spark, sf_dir)).select(
        "tx_id", "customer_id", "tx_time_days", "tx_fraud", *FEATURES
    )


# A fixed rule with one parameter stands for a learner, so that two engines agree on its scores.
LIMITS = (150.0, 300.0)


def _amount_rule(train, params):
    limit = F.lit(params.get("limit", LIMITS[1]))
    share = F.least(F.lit(1.0), F.col("tx_amount").cast("double") / limit)
    return lambda rows: rows.withColumn("score", F.round(share, 2))


def _rule_sql(limit: str) -> str:
    return f"round(least(CAST(1 AS DOUBLE), CAST(tx_amount AS DOUBLE) / CAST({limit} AS DOUBLE)), 2)"


EVAL_DAYS, EVAL_STARTS = 5, {"validation": 10, "test": 15}
EVAL_METRICS = ["auc_roc", "average_precision", f"card_precision_at_{TOP}"]


def _eval_sql() -> str:
    starts = [b - EVAL_DAYS * f for b in EVAL_STARTS.values() for f in range(2)]
    kinds = ", ".join(f"({2 * i + f}, '{kind}')" for i, kind in enumerate(EVAL_STARTS) for f in range(2))
    limits = ", ".join(f"({limit})" for limit in LIMITS)
    picks = []
    for m in EVAL_METRICS:
        def best(kind: str, m: str = m) -> str:
            return f"(SELECT * FROM wide ORDER BY round({m}_{kind}, 9) DESC NULLS LAST, parameters LIMIT 1)"

        picks.append(
            f"""SELECT '{m}' AS metric, e.parameters AS best_estimated_parameters,
                round(e.{m}_validation, 6) AS validation_performance, round(e.{m}_validation_std, 6) AS validation_std,
                round(e.{m}_test, 6) AS test_performance, round(e.{m}_test_std, 6) AS test_std,
                o.parameters AS optimal_parameters, round(o.{m}_test, 6) AS optimal_test_performance,
                round(o.{m}_test_std, 6) AS optimal_test_std
                FROM {best("validation")} e, {best("test")} o"""
        )
    wide = ", ".join(
        f"avg({m}) FILTER (WHERE kind = '{k}') AS {m}_{k}, stddev_pop({m}) FILTER (WHERE kind = '{k}') AS {m}_{k}_std"
        for m in EVAL_METRICS for k in EVAL_STARTS
    )
    return v.with_(
        *_folds_tables(starts, False, EVAL_DAYS),
        f"""model_scores AS (SELECT fold || '|limit=' || p.l AS model, tx_id, tx_time_days, customer_id, tx_fraud,
             {_rule_sql("p.l")} AS score FROM split_, (VALUES {limits}) AS p(l) WHERE split = 'test')""",
        CARDS, WALK, RANKING_RAW,
        f"""each AS (SELECT model, auc_roc, average_precision,
             (SELECT avg(card_precision) FROM per_day WHERE per_day.model = ranking.model) AS card_precision_at_{TOP}
             FROM ranking)""",
        f"kinds AS (SELECT * FROM (VALUES {kinds}) AS k(fold, kind))",
        f"""wide AS (SELECT split_part(model, '|', 2) AS parameters, {wide}
             FROM each JOIN kinds ON split_part(model, '|', 1) = CAST(kinds.fold AS VARCHAR) GROUP BY 1)""",
        body=" UNION ALL ".join(picks),
        recursive=True,
    )


@query(_eval_sql())
def prequential_eval(spark, sf_dir):
    """Two parameter values over two folds, for validation and for test; best by each metric."""
    tx = v.transactions(spark, sf_dir)
    results = models.model_selection(
        tx, _amount_rule, {"limit": list(LIMITS)}, start_day_valid=EVAL_STARTS["validation"],
        start_day_test=EVAL_STARTS["test"], n_folds=2, delta_train=EVAL_DAYS, delta_delay=EVAL_DAYS,
        delta_assessment=EVAL_DAYS, ks=(TOP,), features=["tx_amount"],
    )
    best = models.best_parameters(stage(results, "selection"), EVAL_METRICS)
    return best.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in best.dtypes])


def _cross_sql() -> str:
    names = ["auc_roc", "average_precision", "balanced_accuracy"]
    return v.with_(
        v.TX,
        f"""model_scores AS (SELECT (row_number() OVER (PARTITION BY tx_fraud ORDER BY
             substr(md5(tx_id || '|0'), 1, 8), tx_id) - 1) % 3 AS model, tx_fraud, {_rule_sql(str(LIMITS[1]))} AS score FROM tx)""",
        RANKING_RAW,
        """balanced AS (SELECT model, (avg(CASE WHEN tx_fraud = 1 THEN CAST(score >= CAST(0.5 AS DOUBLE) AS INT) END)
             + avg(CASE WHEN tx_fraud = 0 THEN 1 - CAST(score >= CAST(0.5 AS DOUBLE) AS INT) END)) / 2 AS balanced_accuracy
             FROM model_scores GROUP BY model)""",
        body="SELECT " + ", ".join(f"round(avg({n}), 6) AS {n}, round(stddev_samp({n}), 6) AS {n}_std" for n in names)
        + " FROM ranking JOIN balanced USING (model)",
    )


@query(_cross_sql())
def cross_validation(spark, sf_dir):
    """Three stratified folds."""
    out = models.cross_validate(v.transactions(spark, sf_dir), _amount_rule, k=3, features=["tx_amount"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns if not c.endswith("_time")])


for _name in [n for n in QUERIES if n.endswith("_q")]:
    QUERIES[_name[:-2]], SQL[_name[:-2]] = QUERIES.pop(_name), SQL.pop(_name)
