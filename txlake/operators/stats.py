"""Daily statistics and column profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.scalars import from_day_index
from txlake.operators.ordering import running_totals

QUARTILES = (0.25, 0.5, 0.75)


def daily_stats(tx: DataFrame, origin: dt.date) -> DataFrame:
    """Per day: transactions, frauds and distinct cards with a fraud (0 on days without any)."""
    per_card = tx.groupBy("tx_time_days", "customer_id").agg(
        F.count("customer_id").alias("_n"),
        F.sum("tx_fraud").alias("_bad"),
        F.max("tx_fraud").alias("_hit"),
    )
    return per_card.groupBy("tx_time_days").agg(
        F.sum("_n").alias("nb_tx_per_day"),
        F.sum("_bad").alias("nb_fraudulent_transactions_per_day"),
        F.count_if((F.col("_hit") == 1) & F.col("customer_id").isNotNull()).alias(
            "nb_compromised_cards_per_day"
        ),
    ).withColumn("tx_date", from_day_index(F.col("tx_time_days"), origin))


def daily_stats_long(stats: DataFrame, scale: float = 50.0) -> DataFrame:
    """One row per day and statistic; transaction counts divided by ``scale``."""
    wide = stats.select(
        "tx_time_days",
        (F.col("nb_tx_per_day") / F.lit(float(scale))).alias("nb_tx_per_day"),
        F.col("nb_fraudulent_transactions_per_day").cast("double").alias("nb_fraud_per_day"),
        F.col("nb_compromised_cards_per_day").cast("double").alias("nb_fraudcard_per_day"),
    )
    names = ["nb_tx_per_day", "nb_fraud_per_day", "nb_fraudcard_per_day"]
    return wide.unpivot(["tx_time_days"], names, "stat_type", "value")


def profile(df: DataFrame, columns: list[str], quantiles=QUARTILES) -> DataFrame:
    """Count, mean, standard deviation, minimum, maximum and exact quantiles of each column.

    Quantiles interpolate linearly between the two neighbouring rows. They come from the running
    count over the distinct values, which are counted before they are shuffled and never held in
    one buffer.
    """
    named = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(F.explode(F.array(*named)).alias("_c")).select("_c.*").where("value IS NOT NULL")
    basics = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # -0.0 and 0.0 group as one value.
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counted, ["column"], ["value"], {"n": F.col("n")})
    sizes = basics.select(F.col("column").alias("_col"), F.col("count").alias("_size"))
    placed = ranked.join(F.broadcast(sizes), F.col("column") == F.col("_col"))
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1
    aggs = []
    for i, q in enumerate(quantiles):
        at = (F.col("_size") - 1) * F.lit(float(q))
        low, high = F.floor(at), F.ceil(at)
        aggs += [
            F.max(F.when((first <= low) & (low <= last), F.col("value"))).alias(f"_lo{i}"),
            F.max(F.when((first <= high) & (high <= last), F.col("value"))).alias(f"_hi{i}"),
            F.max(at - low).alias(f"_part{i}"),
        ]
    cuts = placed.groupBy("_col").agg(*aggs)
    return basics.join(cuts, F.col("column") == F.col("_col")).select(
        "column", "count", "mean", "std", "min",
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(
                f"p{round(q * 100)}"
            )
            for i, q in enumerate(quantiles)
        ],
        "max",
    )


def fit_scaler(train: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each feature: one aggregation, one row."""
    row = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in features],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in features],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in features}


def scale_features(rows: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """Standardise features with a fitted scaler; a constant feature is only centred."""
    return rows.withColumns(
        {
            c: (F.col(c).cast("double") - F.lit(mean).cast("double"))
            / F.lit(std if std else 1.0).cast("double")
            for c, (mean, std) in scaler.items()
        }
    )
