"""The engine's inputs as views over the given tables, in Spark and as SQL common tables.

Every query and its SQL counterpart start from the same definitions here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.scalars import day_index, encode_unscaled, hash_fraction, unscaled
from txlake.operators.ordering import top_k
from txlake.session import pin_utc

ORIGIN = dt.date(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, extra: list[str] | tuple = ()) -> DataFrame:
    """Labelled transactions: the ``events`` table under the names of the data model."""
    e = table(spark, sf_dir, "events")
    fraud = (F.col("value") > 220) | ((F.col("event_type") == "error") & (F.col("user_id") % 10 == 0))
    return e.select(
        F.col("event_id").alias("tx_id"),
        F.col("ts").cast("timestamp").alias("tx_datetime"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("long").alias("terminal_id"),
        F.col("value").cast("decimal(10,2)").alias("tx_amount"),
        fraud.cast("int").alias("tx_fraud"),
        day_index(F.col("ts"), ORIGIN).alias("tx_time_days"),
        *extra,
    )


TX = """tx AS (
  SELECT event_id AS tx_id, ts AS tx_datetime, user_id AS customer_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS terminal_id,
         CAST(value AS DECIMAL(10,2)) AS tx_amount,
         CAST(CAST(value AS DECIMAL(10,2)) * 100 AS BIGINT) AS cents,
         CASE WHEN value > 220 OR (event_type = 'error' AND user_id % 10 = 0) THEN 1 ELSE 0 END AS tx_fraud,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS tx_time_days,
         epoch_us(ts) AS us, event_type
  FROM events)"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        (F.col("c_custkey") * 37 % 1000 / F.lit(10.0).cast("double")).alias("x_location"),
        (F.col("c_custkey") * 91 % 1000 / F.lit(10.0).cast("double")).alias("y_location"),
    )


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("terminal_id"),
        (F.col("s_suppkey") * 53 % 1000 / F.lit(10.0).cast("double")).alias("x_location"),
        (F.col("s_suppkey") * 17 % 1000 / F.lit(10.0).cast("double")).alias("y_location"),
    )


CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, (c_custkey * 37 % 1000) / CAST(10 AS DOUBLE) AS x_location,
         (c_custkey * 91 % 1000) / CAST(10 AS DOUBLE) AS y_location FROM customer)"""
TERMINALS = """terminals AS (
  SELECT s_suppkey AS terminal_id, (s_suppkey * 53 % 1000) / CAST(10 AS DOUBLE) AS x_location,
         (s_suppkey * 17 % 1000) / CAST(10 AS DOUBLE) AS y_location FROM supplier)"""


def compromises(tx: DataFrame, entity: str, n: int) -> DataFrame:
    """Per day ``n`` of the entities seen that day, picked by hash; none on the last day."""
    seen = tx.groupBy(F.col("tx_time_days").alias("start_day"), entity).agg(F.lit(1).alias("_one"))
    drawn = seen.drop("_one").withColumn("_draw", hash_fraction(F.col("start_day"), F.col(entity)))
    last = tx.agg(F.max("tx_time_days")).first()[0]
    return top_k(
        drawn.where(F.col("start_day") < last), ["start_day"], ["_draw", entity], n, "_rank",
        entity, at_most=n,
    ).select("start_day", entity)


def compromises_sql(name: str, entity: str, n: int) -> str:
    return f"""{name} AS (
  SELECT start_day, {entity} FROM (
    SELECT start_day, {entity}, row_number() OVER (PARTITION BY start_day
             ORDER BY substr(md5(start_day || '|' || {entity}), 1, 8), {entity}) AS rn
    FROM (SELECT DISTINCT tx_time_days AS start_day, {entity} FROM tx)
    WHERE start_day < (SELECT max(tx_time_days) FROM tx)) WHERE rn <= {n})"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a reproducible score that has ties and some skill."""
    draw = hash_fraction(F.col("tx_id")) + F.col("tx_fraud") * F.lit(0.3).cast("double")
    return transactions(spark, sf_dir).withColumn(
        "score", F.round(F.least(draw, F.lit(1.0).cast("double")), 2)
    )


SCORED = """scored AS (
  SELECT *, round(least(CAST(CAST('0x' || substr(md5(CAST(tx_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE)
                        / CAST(4294967296 AS DOUBLE) + tx_fraud * CAST(0.3 AS DOUBLE), CAST(1 AS DOUBLE)), 2) AS score
  FROM tx)"""


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form scores of three rules: by hash, by amount, and the same for all."""
    s = scored(spark, sf_dir)
    by_amount = F.round(F.least(F.col("tx_amount").cast("double") / 500, F.lit(1.0).cast("double")), 3)
    rules = F.array(
        F.struct(F.lit("hash").alias("model"), F.col("score").alias("score")),
        F.struct(F.lit("amount").alias("model"), by_amount.alias("score")),
        F.struct(F.lit("constant").alias("model"), F.lit(0.5).cast("double").alias("score")),
    )
    return s.select("tx_id", "customer_id", "tx_time_days", "tx_fraud", F.inline(rules))


MODEL_SCORES = """model_scores AS (
  SELECT tx_id, customer_id, tx_time_days, tx_fraud, 'hash' AS model, score FROM scored
  UNION ALL SELECT tx_id, customer_id, tx_time_days, tx_fraud, 'amount',
    round(least(CAST(tx_amount AS DOUBLE) / 500, CAST(1 AS DOUBLE)), 3) FROM scored
  UNION ALL SELECT tx_id, customer_id, tx_time_days, tx_fraud, 'constant', CAST(0.5 AS DOUBLE) FROM scored)"""


def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log over the transactions, in the columns of a Kafka frame.

    Every event is created; ``view`` and ``signup`` events are then updated (amount + 1), ``error``
    events deleted, and each delete is followed by a tombstone.
    """
    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def once(df: DataFrame, **columns) -> DataFrame:
        """Add columns through a generator, so that later expressions do not repeat them."""
        made = F.struct(*[c.alias(n) for n, c in columns.items()])
        return df.select("*", F.inline(F.array(made)))

    def image(cents):
        return text(
            '{"tx_id":', F.col("tx_id"), ',"tx_datetime":', F.col("us"),
            ',"customer_id":', F.col("customer_id"), ',"terminal_id":', F.col("terminal_id"),
            ',"tx_amount":"', F.base64(encode_unscaled(cents)), '"}',
        )

    e = once(
        transactions(spark, sf_dir, ["event_type"]),
        us=F.unix_micros("tx_datetime"), cents=unscaled(F.col("tx_amount")),
    )
    e = once(e, old=image(F.col("cents")), new=image(F.col("cents") + 100))
    old, new, nothing = F.col("old"), F.col("new"), F.lit("null")

    def change(step: int, op: str, before, after, when):
        at = F.col("us") + step
        json = text(
            '{"payload":{"before":', before, ',"after":', after,
            ',"source":{"lsn":', F.col("tx_id") * 3 + step, ',"ts_us":', at,
            ',"table":"transactions","snapshot":"false"},"op":"' + op + '","ts_us":', at, "}}",
        )
        return F.struct(
            when.alias("keep"), F.lit(step).alias("step"), F.when(when, json).alias("json")
        )

    kind = F.col("event_type")
    deleted = kind == "error"
    steps = F.array(
        change(0, "c", nothing, old, F.lit(True)),
        change(1, "u", old, new, kind.isin("view", "signup")),
        change(2, "d", old, nothing, deleted),
        F.struct(deleted.alias("keep"), F.lit(3).alias("step"), F.lit(None).cast("string").alias("json")),
    )
    return e.select("tx_id", "us", F.explode(steps).alias("c")).where("c.keep").select(
        F.to_json(F.struct("tx_id")).cast("binary").alias("key"),
        F.col("c.json").cast("binary").alias("value"),
        F.lit("payment.transactions").alias("topic"),
        F.pmod("tx_id", F.lit(8)).cast("int").alias("partition"),
        (F.col("tx_id") * 4 + F.col("c.step")).alias("offset"),
        F.timestamp_micros(F.col("us") + F.col("c.step")).alias("timestamp"),
    )


CHANGES = """changes AS (
  SELECT tx_id, 'c' AS op, tx_id * 3 AS lsn, tx_datetime, customer_id, terminal_id, tx_amount FROM tx
  UNION ALL SELECT tx_id, 'u', tx_id * 3 + 1, tx_datetime, customer_id, terminal_id, tx_amount + 1 FROM tx
    WHERE event_type IN ('view', 'signup')
  UNION ALL SELECT tx_id, 'd', tx_id * 3 + 2, tx_datetime, customer_id, terminal_id, tx_amount FROM tx
    WHERE event_type = 'error')"""

DAY_US = 86_400_000_000


def customer_features_sql(name: str = "cust", source: str = "tx") -> str:
    cols, wins = [], []
    for n in (1, 7, 30):
        cols.append(f"count(tx_amount) OVER w{n} AS customer_id_nb_tx_{n}day_window")
        cols.append(
            f"CAST(sum(cents) OVER w{n} AS DOUBLE) / CAST(100 AS DOUBLE) / count(tx_amount) OVER w{n} "
            f"AS customer_id_avg_amount_{n}day_window"
        )
        wins.append(
            f"w{n} AS (PARTITION BY customer_id ORDER BY us "
            f"RANGE BETWEEN {n * DAY_US - 1} PRECEDING AND CURRENT ROW)"
        )
    return f"{name} AS (SELECT *, {', '.join(cols)} FROM {source} WINDOW {', '.join(wins)})"


def terminal_features_sql(name: str = "term", source: str = "tx", delay: int = 7) -> str:
    cols, wins = [], []
    for n in (1, 7, 30):
        cols.append(f"count(tx_fraud) OVER t{n} AS terminal_id_nb_tx_{n}day_window")
        cols.append(
            f"CASE WHEN count(tx_fraud) OVER t{n} = 0 THEN CAST(0 AS DOUBLE) ELSE "
            f"CAST(sum(tx_fraud) OVER t{n} AS DOUBLE) / count(tx_fraud) OVER t{n} END "
            f"AS terminal_id_risk_{n}day_window"
        )
        wins.append(
            f"t{n} AS (PARTITION BY terminal_id ORDER BY us RANGE BETWEEN "
            f"{(delay + n) * DAY_US - 1} PRECEDING AND {delay * DAY_US} PRECEDING)"
        )
    return f"{name} AS (SELECT *, {', '.join(cols)} FROM {source} WINDOW {', '.join(wins)})"


def calendar_sql(name: str, as_of: str, end_offset: int = 1) -> str:
    cols = []
    for n in (1, 7, 30):
        last = n if n == 1 else end_offset
        inside = f"CAST(tx_datetime AS DATE) BETWEEN DATE '{as_of}' - {n} AND DATE '{as_of}' - {last}"
        cols.append(f"count(*) FILTER (WHERE {inside}) AS customer_id_nb_tx_{n}day_window")
        cols.append(
            f"CAST(sum(cents) FILTER (WHERE {inside}) AS DOUBLE) / CAST(100 AS DOUBLE) / "
            f"nullif(count(*) FILTER (WHERE {inside}), 0) AS customer_id_avg_amount_{n}day_window"
        )
    return (
        f"{name} AS (SELECT customer_id, DATE '{as_of}' AS dt, {', '.join(cols)} FROM tx "
        f"WHERE CAST(tx_datetime AS DATE) BETWEEN DATE '{as_of}' - 30 AND DATE '{as_of}' - {min(1, end_offset)} "
        "GROUP BY customer_id)"
    )


def with_(*tables: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(tables) + "\n" + body
