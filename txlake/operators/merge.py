"""Upsert of a source frame into a target frame or table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.session import stage

CREATED, UPDATED = "row_created_timestamp", "row_updated_timestamp"
MAX_PARTITIONS = 10_000
# A source of so many rows at most is met from the target's side.
SMALL_ROWS = 100_000


def with_audit(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add both audit columns; ``as_of`` fixes the time for reproducible runs."""
    now = F.current_timestamp() if as_of is None else as_of
    return df.withColumns({CREATED: now, UPDATED: now})


def _checked(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source, failing the job on a NULL or repeated key as MERGE does.

    The grouping hashes by key, which is also how the merge join wants its input, so the check
    adds no shuffle.
    """
    rest = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row")
    )
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    fail = lambda text: F.raise_error(F.lit(text)).cast("boolean")
    valid = (
        F.when(null_key, fail("merge source has a NULL key"))
        .when(F.col("_n") > 1, fail("merge source has more than one row for a key"))
        .otherwise(F.lit(True))
    )
    return grouped.where(valid).select(*keys, "_row")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str] | tuple[str, ...],
    keep: tuple[str, ...] = (CREATED,), small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Target after the upsert: matched rows take the source's columns but ``keep``.

    Columns the source lacks stay as they are (NULL on insert). Rows of the target with a NULL key
    match nothing and pass through.

    The checked source is written to the shared folder once. One of at most ``small_rows`` rows, the
    usual micro-batch, is joined to the target's rows, without a shuffle of the target while Spark
    finds the source's files under its broadcast threshold; a larger one meets it in a full outer
    join.
    """
    keys = list(keys)
    incoming = _checked(source, keys).select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], "_row", F.lit(1).alias("_in")
    )
    there = target.withColumn("_old", F.lit(1))
    cond = F.lit(True)
    for key in keys:
        cond = cond & (F.col(key) == F.col(f"_s_{key}"))
    out = []
    for name in target.columns:
        old = F.col(name)
        if name in keys:
            new = F.coalesce(F.col(f"_s_{name}"), old)
        elif name not in source.columns:
            new = old
        elif name in keep:
            new = F.when(F.col("_old").isNotNull(), old).otherwise(F.col(f"_row.{name}"))
        else:
            new = F.when(F.col("_in").isNotNull(), F.col(f"_row.{name}")).otherwise(old)
        out.append(new.alias(name))
    incoming = stage(incoming, "merge-source")
    if incoming.count() > small_rows:
        return there.join(incoming, cond, "full_outer").select(*out)
    # The target's matched keys are no more than the source's; they tell which rows to insert.
    taken = target.select(*keys).join(incoming, cond, "left_semi").distinct()
    fresh = incoming.join(taken, cond, "left_anti")
    inserts = fresh.select(
        "*", *[F.lit(None).cast(kind).alias(name) for name, kind in there.dtypes]
    )
    return there.join(incoming, cond, "left").select(*out).unionByName(inserts.select(*out))


def merge_touched_partitions(
    target: DataFrame, source: DataFrame, keys: list[str] | tuple[str, ...], partition: str = "dt",
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Merged rows of only those partitions the source touches.

    The partition column is part of the key, as with a MERGE on date and id: a row whose date
    changed is inserted under the new date. The touched dates, one value per partition, become a
    filter that keeps Spark from opening other files; write the result with dynamic partition
    overwrite to replace just these partitions.
    """
    days = [r[0] for r in source.select(partition).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(days) <= MAX_PARTITIONS:
        touched = target.where(F.col(partition).isin(days))
    else:
        touched = target.join(source.select(partition).distinct(), partition, "left_semi")
    touched = touched.select(*target.columns)
    every = [partition, *[k for k in keys if k != partition]]
    return merge_upsert(touched, source, every, small_rows=small_rows)


def merge_into_table(
    source: DataFrame, table: str, keys: list[str] | tuple[str, ...],
    keep: tuple[str, ...] = (CREATED,),
) -> None:
    """The same upsert as one row-level command, for catalogs whose tables support MERGE."""
    cond = F.lit(True)
    for key in keys:
        cond = cond & (F.col(f"target.{key}") == F.col(f"source.{key}"))
    changed = {
        c: F.col(f"source.{c}") for c in source.columns if c not in keys and c not in keep
    }
    (
        source.alias("source")
        .mergeInto(f"{table} AS target" if " " not in table else table, cond)
        .whenMatched()
        .update(changed)
        .whenNotMatched()
        .insert({c: F.col(f"source.{c}") for c in source.columns})
        .merge()
    )
