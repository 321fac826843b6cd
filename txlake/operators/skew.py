"""Finding hot keys and leaving broadcasts to sizes that are known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.session import stage

MIN_HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``min_rows`` rows, which are too many for one task, or None.

    The limit does not grow with the table. The counts combine before their shuffle; the list is
    written to the shared folder, so joins broadcast a short one and shuffle a long one. The usual
    case, no hot key, is one pass over the key column.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    found = broadcast_if_small(counts.where(F.col("_rows") > min_rows).select(key))
    return found if found.take(1) else None


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder.

    Its size is then known before any plan is made, and Spark broadcasts it where its files are
    smaller than ``spark.sql.autoBroadcastJoinThreshold``; beyond it there is a shuffle join. Nothing
    reaches the driver to find out, and ``df`` is never computed twice.
    """
    return stage(df, "side")
