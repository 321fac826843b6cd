"""Daily sketches that merge into any range of days, beside the exact statistics.

A day becomes one row: counts, a KLL sketch of the amounts and theta sketches of the cards and of the cards
with a fraud. Sketches are a few kilobytes whatever the day holds, combine on the map side, and merge
without the transactions, so a quantile or a number of distinct cards over any days reads as many rows as
there are days. Counts stay exact; a quantile is off by a share of the ranks that falls with ``k``, a
distinct count by a share that falls with the root of the theta sketch's entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About 0.4% of the ranks at 99% confidence; 1.6% standard deviation of distinct counts above 4,096.
KLL_K = 800
THETA_ENTRIES = 12


def daily_sketches(tx: DataFrame, day: str = "tx_time_days", k: int = KLL_K) -> DataFrame:
    """Per day: ``n``, ``n_amounts``, ``frauds``, ``amounts`` (KLL), ``cards`` and ``bad_cards`` (theta).

    Rows without a day belong to none; null amounts, cards and labels are not counted. Days can be written
    as they end and never be read again as transactions.
    """
    bad = F.when(F.col("tx_fraud") == 1, F.col("customer_id"))
    return tx.where(F.col(day).isNotNull()).groupBy(day).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("tx_amount").alias("n_amounts"),
        F.coalesce(F.sum(F.col("tx_fraud").cast("long")), F.lit(0)).alias("frauds"),
        F.kll_sketch_agg_double(F.col("tx_amount").cast("double"), k).alias("amounts"),
        F.theta_sketch_agg("customer_id", THETA_ENTRIES).alias("cards"),
        F.theta_sketch_agg(bad, THETA_ENTRIES).alias("bad_cards"),
    )


def merged_ranges(
    sketches: DataFrame, ranges: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), day: str = "tx_time_days"
) -> DataFrame:
    """One row per (first, last) of ``ranges``, both days included: ``n``, ``frauds``, quantiles ``p25`` and so
    on, ``cards`` and ``bad_cards`` (distinct, estimated). Ranges without a day are left out.

    A range meets its days, not their transactions: days times ranges rows of a few kilobytes at most.
    """
    days = F.explode(F.sequence(F.col("first"), F.col("last"))).alias(day)
    met = ranges.select("first", "last", days).join(sketches, day)
    merged = met.groupBy("first", "last").agg(
        F.sum("n").alias("n"), F.sum("n_amounts").alias("n_amounts"), F.sum("frauds").alias("frauds"),
        F.kll_merge_agg_double("amounts").alias("amounts"),
        F.theta_sketch_estimate(F.theta_union_agg("cards", THETA_ENTRIES)).alias("cards"),
        F.theta_sketch_estimate(F.theta_union_agg("bad_cards", THETA_ENTRIES)).alias("bad_cards"),
    )
    found = [
        F.when(F.col("n_amounts") > 0, F.kll_sketch_get_quantile_double("amounts", F.lit(q))).alias(f"p{round(q * 100)}")
        for q in quantiles
    ]
    return merged.select("first", "last", "n", "frauds", *found, "cards", "bad_cards")
