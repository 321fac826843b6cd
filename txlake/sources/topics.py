"""Log topics as batch and streaming frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.schemas import LOG_SCHEMA


def read_topic(spark: SparkSession, topic: str, brokers: str) -> DataFrame:
    """The whole log of a topic; needs Spark's Kafka connector on the class path."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def stream_topic(
    spark: SparkSession, topic: str, brokers: str, max_offsets: int | None = None
) -> DataFrame:
    """A topic from its first event on; ``max_offsets`` bounds one micro-batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


# Offsets that stand for the ends of a partition, as Kafka's readers have them.
EARLIEST, LATEST = -2, -1


def between_offsets(log: DataFrame, start: dict[int, int], end: dict[int, int] | None = None) -> DataFrame:
    """The events of a log, batch or stream, from the offsets ``start`` up to and without ``end``, both by
    partition. Partitions that ``start`` does not name are left out; those that ``end`` does not name are
    read to their last event. The ranges reach the reader, which skips files and row groups outside."""
    end = end or {}
    parts = []
    for partition, first in sorted(start.items()):
        inside = F.col("partition") == partition
        if first != EARLIEST:
            inside = inside & (F.col("offset") >= first)
        if end.get(partition, LATEST) != LATEST:
            inside = inside & (F.col("offset") < end[partition])
        parts.append(inside)
    return log.where(reduce(lambda a, b: a | b, parts, F.lit(False)))


def next_offsets(log: DataFrame) -> dict[int, int]:
    """Where each partition of a batch frame ends: the ``start`` of what comes next. One row per partition."""
    rows = log.where("partition IS NOT NULL").groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()
    return {r["partition"]: r["next"] for r in rows}


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    """A log kept as Parquet files with the columns of a Kafka frame."""
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def stream_log_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New files of such a log as a stream."""
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
