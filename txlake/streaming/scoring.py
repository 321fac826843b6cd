"""Scoring of a transaction stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from txlake.operators.models import score
from txlake.operators.snapshots import enrich
from txlake.session import refuse_new_checkpoint
from txlake.sources.feature_store import FeatureStore

INTERVAL = "10 seconds"

# A fitted pipeline, or a function that adds the prediction to enriched rows.
Model = PipelineModel | Callable[[DataFrame], DataFrame]


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Rows appended to a table folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def scored(
    tx: DataFrame, customer_features: DataFrame, terminal_features: DataFrame,
    model: Model,
) -> DataFrame:
    """Enrich and score; the same call serves batch and stream."""
    return _score(enrich(tx, customer_features, terminal_features), model)


def _score(rows: DataFrame, model: Model | None) -> DataFrame:
    rows = rows.withColumn("processed_at", F.current_timestamp())
    if model is None:
        return rows
    return score(model, rows) if isinstance(model, PipelineModel) else model(rows)


def start_append(
    rows: DataFrame, path: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row exactly once. Nothing is dropped on start.

    A folder that another checkpoint has filled is refused.
    """
    refuse_new_checkpoint(rows.sparkSession, path, checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def _of_batch(features: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The feature rows of the entities in a batch. The batch is cached, so Spark knows its size and
    broadcasts the ids while they are few: then this is a filtered scan."""
    return features.join(batch.select(key).distinct(), key, "left_semi")


def start_scoring(
    tx: DataFrame, features: FeatureStore | Callable[[], tuple[DataFrame, DataFrame]],
    model: Model | None, path: str, checkpoint: str, interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Score each micro-batch with the features as they are at that moment; without a model, only
    enrich it.

    From a store only the partitions that a batch's days need are read. A function returns the customer
    and terminal features and is called per batch; these are read whole. Either way new snapshots are
    used without a restart, and the features, large next to a batch, are reduced to its entities before
    the joins and never shuffled for it. A batch writes its own ``epoch`` folder and replaces it if it
    is run again, so each row is kept once. A folder that another checkpoint has filled is refused, since
    epochs begin at 0 with each checkpoint.
    """
    refuse_new_checkpoint(tx.sparkSession, path, checkpoint)

    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            if not batch.count():
                return
            if isinstance(features, FeatureStore):
                rows = _score(features.enrich(batch), model)
            else:
                customers, terminals = features()
                rows = scored(
                    batch,
                    _of_batch(customers, batch, "customer_id"),
                    _of_batch(terminals, batch, "terminal_id"),
                    model,
                )
            rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        finally:
            batch.unpersist()

    writer = tx.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
