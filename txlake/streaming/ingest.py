"""Change streams into current-state tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlake.operators.cdc import META, TableSpec, latest_image, parse_changes
from txlake.operators.merge import merge_upsert, with_audit
from txlake.operators.skew import broadcast_if_small
from txlake.session import delete_folder, folders, materialize, refuse_new_checkpoint

INTERVAL = "5 seconds"
COMPACT_EVERY = 100
BASES = "_bases"


def _start(stream: DataFrame, each: Callable, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    # Without an interval: work off everything there is, then stop.
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_ingest(
    log: DataFrame, spec: TableSpec, changes_path: str, checkpoint: str,
    interval: str | None = INTERVAL, compact_every: int | None = COMPACT_EVERY,
) -> StreamingQuery:
    """Append each micro-batch's latest images to a change table.

    A batch writes its own ``epoch`` folder and replaces it if it is run again after a failure, so
    every change counts once. Images keep their log position: :func:`table_state` compares them
    across batches, and a late batch with older changes cannot overwrite newer ones. A change table
    that another checkpoint has filled is refused, since epochs begin at 0 with each checkpoint.

    Every ``compact_every`` batches the stream folds what there is into a base (:func:`retire_epochs`), so the
    number of folders does not grow with the batches; None leaves all epochs.
    """
    refuse_new_checkpoint(log.sparkSession, changes_path, checkpoint)

    def land(batch: DataFrame, epoch: int) -> None:
        latest = latest_image(batch, spec.keys, keep_deletes=True)
        latest.write.mode("overwrite").parquet(f"{changes_path}/epoch={epoch}")
        if compact_every and (epoch + 1) % compact_every == 0:
            retire_epochs(log.sparkSession, spec, changes_path)

    return _start(parse_changes(log, spec), land, checkpoint, interval)


def start_merge_ingest(
    log: DataFrame, spec: TableSpec, apply: Callable[[DataFrame, int], None], checkpoint: str,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Hand each micro-batch's latest images (deletes included, see ``_op``) to ``apply``.

    For tables with row-level commands, where ``apply`` runs the MERGE.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        apply(latest_image(batch, spec.keys, keep_deletes=True), epoch)

    return _start(parse_changes(log, spec), each, checkpoint, interval)


def table_changes(spark: SparkSession, changes_path: str) -> DataFrame:
    """All landed changes with the ``epoch`` of their batch, as far as they are not folded into a base."""
    paths = [f"{changes_path}/epoch={e}" for e in folders(spark, changes_path, "epoch=")]
    return spark.read.option("basePath", changes_path).parquet(*paths)


def _own_bases(spark: SparkSession, changes_path: str) -> list[int]:
    return folders(spark, f"{changes_path}/{BASES}", "upto=", whole=True)


def retire_epochs(spark: SparkSession, spec: TableSpec, changes_path: str) -> None:
    """Fold all batches landed so far into a base of one image per key, deletes included; then the batches in
    the base before and older bases go.

    The base before, and the batches behind it, stay until the next call, for readers that have just
    begun. A base counts once it is whole, so a call that is cut off changes nothing, and a batch that runs
    again is folded again.
    """
    epochs, bases = folders(spark, changes_path, "epoch="), _own_bases(spark, changes_path)
    if not epochs:
        return
    last = epochs[-1]
    earlier = [b for b in bases if b < last]
    folded = latest_image(_with_base(spark, changes_path, earlier[-1:]).drop("epoch"), spec.keys, keep_deletes=True)
    folded.write.mode("overwrite").parquet(f"{changes_path}/{BASES}/upto={last}")
    for old in earlier[:-1]:
        delete_folder(spark, f"{changes_path}/{BASES}/upto={old}")
    for old in (e for e in epochs if earlier and e <= earlier[-1]):
        delete_folder(spark, f"{changes_path}/epoch={old}")


def _with_base(spark: SparkSession, changes_path: str, base: list[int]) -> DataFrame:
    """The base, if there is one, and the batches after it."""
    if not base:
        return table_changes(spark, changes_path)
    done = base[-1]
    rows = spark.read.parquet(f"{changes_path}/{BASES}/upto={done}").withColumn("epoch", F.lit(done))
    later = [e for e in folders(spark, changes_path, "epoch=") if e > done]
    if not later:
        return rows
    changes = spark.read.option("basePath", changes_path).parquet(*[f"{changes_path}/epoch={e}" for e in later])
    return rows.unionByName(changes)


def compact_changes(spark: SparkSession, spec: TableSpec, changes_path: str, base_path: str) -> None:
    """Write one image per key, deletes included, of all batches landed so far to a new folder.

    The stream goes on while this runs. Read the result with :func:`table_state`.
    """
    changes = table_changes(spark, changes_path)
    last = changes.agg(F.max("epoch")).first()[0]
    folded = latest_image(changes.where(F.col("epoch") <= last).drop("epoch"), spec.keys, keep_deletes=True)
    folded.withColumn("epoch", F.lit(last)).write.mode("errorifexists").parquet(base_path)


def table_state(
    spark: SparkSession, spec: TableSpec, changes_path: str, base_path: str | None = None
) -> DataFrame:
    """Current rows: the latest change per key over all batches, deleted keys left out.

    Batches that the stream has folded into a base are read from there. With the ``base_path`` of a
    compaction only the batches after it are read from the changes.
    """
    changes = _with_base(spark, changes_path, _own_bases(spark, changes_path)[-1:])
    if base_path is not None:
        base = spark.read.parquet(base_path)
        done = base.agg(F.max("epoch")).first()[0]
        if done is not None:
            changes = base.unionByName(changes.where(F.col("epoch") > done))
    return latest_image(changes.drop("epoch"), spec.keys).select(*spec.columns)


def fold_into(
    snapshot: DataFrame, spec: TableSpec, changes: DataFrame, as_of=None
) -> DataFrame:
    """A snapshot with audit columns brought up to date by a set of changes.

    Deleted keys leave the snapshot; the rest is upserted. Write the result to a new folder.
    """
    # Used for the deletes and the upsert: parsed and reduced once.
    latest = materialize(latest_image(changes, spec.keys, keep_deletes=True))
    gone = broadcast_if_small(latest.where("_op = 'd'").select(*spec.keys))
    live = latest.where("_op != 'd'").drop(*META)
    keys = list(spec.keys)
    return merge_upsert(snapshot.join(gone, keys, "left_anti"), with_audit(live, as_of), keys)
