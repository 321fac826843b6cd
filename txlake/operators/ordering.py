"""Positions and running totals over a global order, without a single-task window.

The rows are range-sorted and checkpointed once. Each partition is then a slice of the order
whose size does not depend on any key's frequency; per-slice totals (one row per slice and group)
carry the running value from slice to slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.operators.skew import broadcast_if_small
from txlake.session import materialize, stage

_SLICE, _POS = "_slice", "_pos"
SLICE_ROWS = 4_000_000


def sorted_slices(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df`` sorted by ``order`` and fixed on disk, with ``_slice`` and the row's ``_pos`` in it.

    ``order`` must be total (end it with a unique column) for positions to be reproducible. The rows
    are written first: counting them and sampling their ranges then reads files instead of computing
    ``df`` again.
    """
    rows = stage(df, "to-sort")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = -(-rows.count() // SLICE_ROWS)
    # Beyond the session's number of partitions, as many slices as the rows ask for.
    sliced = rows.orderBy(*order) if parts <= least else (
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    )
    fixed = materialize(sliced)
    # Upper bits: partition number; lower 33 bits: row number within the partition.
    where = F.monotonically_increasing_id()
    return fixed.withColumn("_where", where).select(
        *fixed.columns,
        F.shiftright("_where", 33).alias(_SLICE),
        F.col("_where").bitwiseAND(F.lit((1 << 33) - 1)).alias(_POS),
    )


def _carry(per_slice: DataFrame, groups: list[str], values: list[Column]) -> DataFrame:
    """Per-slice values under keys of their own, broadcast where they are few as expected."""
    keys = [F.col(c).alias(f"_k{c}") for c in (_SLICE, *groups)]
    return broadcast_if_small(per_slice.select(*keys, *values))


def _same(groups: list[str]) -> Column:
    cond = F.col(_SLICE) == F.col(f"_k{_SLICE}")
    for name in groups:
        cond = cond & F.col(name).eqNullSafe(F.col(f"_k{name}"))
    return cond


def rank_in_group(df: DataFrame, groups: list[str], order: list, name: str) -> DataFrame:
    """Add the 0-based position of each row inside its group under ``order``."""
    rows = sorted_slices(df, *groups, *order)
    per_slice = rows.groupBy(_SLICE, *groups).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first")
    )
    earlier = Window.partitionBy(*groups).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    starts = _carry(per_slice, groups, [(before - F.col("_first")).alias("_shift")])
    return rows.join(starts, _same(groups)).select(
        *df.columns, (F.col(_POS) + F.col("_shift")).alias(name)
    )


def sequential_ids(df: DataFrame, order: list, name: str, start: int = 0) -> DataFrame:
    """Number all rows by ``order`` from ``start``."""
    ranked = rank_in_group(df, [], order, name)
    return ranked.withColumn(name, F.col(name) + start) if start else ranked


def running_totals(
    df: DataFrame, groups: list[str], order: list, values: dict[str, Column]
) -> DataFrame:
    """Add ``<name>_before``: the sum of the value over all earlier rows of the group.

    Rows with the same ``order`` come in any sequence; make it total, or such that it does not
    matter. The values are evaluated on the sorted copy, which holds only the columns of ``df``.
    """
    rows = sorted_slices(df, *groups, *order)
    per_slice = rows.groupBy(_SLICE, *groups).agg(
        *[F.sum(v).alias(f"_t_{n}") for n, v in values.items()]
    )
    earlier = Window.partitionBy(*groups).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carry(
        per_slice,
        groups,
        [F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}") for n in values],
    )
    inside = (
        Window.partitionBy(_SLICE, *groups).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_l_{n}") for n, v in values.items()]
    )
    return local.join(carried, _same(groups)).select(
        *df.columns, *[(F.col(f"_l_{n}") + F.col(f"_c_{n}")).alias(f"{n}_before") for n in values]
    )


def top_k(
    df: DataFrame, groups: list[str], order: list, k: Column | int, name: str, spread: str,
    at_most: int | None = None, salts: int = 64,
) -> DataFrame:
    """Rows with rank ``name`` <= ``k`` in their group.

    With ``at_most`` (an upper bound of ``k``) the ranking runs in two rounds, first in ``salts``
    parts of each group chosen by the hash of ``spread``, so that no task sorts a whole hot group:
    a row beyond rank ``at_most`` of its part is beyond it in the group as well.
    """
    if at_most is not None:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
        part = Window.partitionBy(*groups, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_r", F.row_number().over(part))
            .where(F.col("_r") <= at_most)
            .drop("_r", "_salt")
        )
    whole = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(name, F.row_number().over(whole)).where(F.col(name) <= k)
