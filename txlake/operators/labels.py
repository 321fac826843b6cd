"""Fraud labels from an amount rule and from lists of compromised terminals and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.scalars import hash_fraction
from txlake.operators.ordering import rank_in_group
from txlake.operators.skew import broadcast_if_small

# The fraud scenarios.
AMOUNT_LIMIT = 220
TERMINAL_DAYS = 28
CUSTOMER_DAYS = 14
AMOUNT_FACTOR = 5
ONE_IN = 3


def _starts(compromises: DataFrame, entity: str) -> DataFrame:
    """One row per entity with the array of its start days (at most one per calendar day)."""
    starts = compromises.groupBy(F.col(entity).alias(f"_{entity}")).agg(
        F.array_sort(F.collect_set("start_day")).alias(f"_{entity}_days")
    )
    return broadcast_if_small(starts)


def _covering(starts: str, day: str, length: int):
    return F.filter(F.col(starts), lambda s: (F.col(day) >= s) & (F.col(day) < s + length))


def label_scenarios(
    tx: DataFrame, terminal_compromises: DataFrame, customer_compromises: DataFrame
) -> DataFrame:
    """Add ``tx_fraud``, ``tx_fraud_scenario`` and the parts they come from; raise taken amounts.

    ``scenario_1``: amount above the limit. ``scenario_2``: on a terminal within the days after its
    compromise. ``scenario_3``: among the third of the compromised customers' transactions picked
    per start day by hash; each pick multiplies the amount again, so a row in several windows can
    be raised several times (``scenario_3_hits``). The highest scenario names the row.

    A row is joined to at most one list of start days per side, so rows never fan out, and the
    lists are broadcast if they are small. Only rows inside a customer window are ranked, over the
    sorted slices of all tasks.
    """
    terms = _starts(terminal_compromises, "terminal_id")
    cards = _starts(customer_compromises, "customer_id")
    windows = (
        tx.join(cards, F.col("customer_id") == F.col("_customer_id"))
        .select(
            "tx_id",
            F.explode(_covering("_customer_id_days", "tx_time_days", CUSTOMER_DAYS)).alias("_start"),
        )
        .withColumn("_draw", hash_fraction(F.col("tx_id"), F.col("_start")))
    )
    ranked = rank_in_group(windows, ["_start"], ["_draw", "tx_id"], "_rank")
    sizes = broadcast_if_small(
        ranked.groupBy(F.col("_start").alias("_s")).agg(F.count(F.lit(1)).alias("_size"))
    )
    hits = broadcast_if_small(
        ranked.join(sizes, F.col("_start") == F.col("_s"))
        .where(F.col("_rank") < F.floor(F.col("_size") / ONE_IN))
        .groupBy(F.col("tx_id").alias("_tx"))
        .agg(F.count(F.lit(1)).alias("_hits"))
    )
    joined = tx.join(terms, F.col("terminal_id") == F.col("_terminal_id"), "left").join(
        hits, F.col("tx_id") == F.col("_tx"), "left"
    )
    covered = F.size(_covering("_terminal_id_days", "tx_time_days", TERMINAL_DAYS)) > 0
    flagged = joined.withColumns(
        {
            "scenario_1": F.coalesce((F.col("tx_amount") > AMOUNT_LIMIT).cast("int"), F.lit(0)),
            "scenario_2": F.coalesce(covered.cast("int"), F.lit(0)),
            "scenario_3_hits": F.coalesce(F.col("_hits"), F.lit(0)),
        }
    )
    scenario = (
        F.when(F.col("scenario_3_hits") > 0, 3)
        .when(F.col("scenario_2") == 1, 2)
        .when(F.col("scenario_1") == 1, 1)
        .otherwise(0)
    )
    kept = [c for c in tx.columns if c not in ("tx_amount", "tx_fraud", "tx_fraud_scenario")]
    factor = F.pow(F.lit(AMOUNT_FACTOR), F.col("scenario_3_hits")).cast("decimal(18,0)")
    return flagged.select(
        *kept,
        (F.col("tx_amount") * factor).cast("decimal(20,2)").alias("tx_amount"),
        (scenario > 0).cast("int").alias("tx_fraud"),
        scenario.alias("tx_fraud_scenario"),
        "scenario_1",
        "scenario_2",
        "scenario_3_hits",
    )


def fraud_summary(labelled: DataFrame) -> DataFrame:
    """One row: totals, share, rows per final scenario and rows each scenario added."""
    one, two = F.col("scenario_1") == 1, F.col("scenario_2") == 1
    three = F.col("scenario_3_hits") > 0
    named = lambda n: F.count_if(F.col("tx_fraud_scenario") == n)
    return labelled.agg(
        F.count(F.lit(1)).alias("nb_tx"),
        F.sum("tx_fraud").alias("nb_fraud"),
        F.avg("tx_fraud").alias("fraud_ratio"),
        named(1).alias("nb_scenario_1"),
        named(2).alias("nb_scenario_2"),
        named(3).alias("nb_scenario_3"),
        F.count_if(one).alias("added_by_scenario_1"),
        F.count_if(two & ~one).alias("added_by_scenario_2"),
        F.count_if(three & ~two & ~one).alias("added_by_scenario_3"),
    )
