"""Session factory and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_session(app: str = "txlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and zstd Parquet; ``conf`` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Checkpoint files go when the frames built on them are gone.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Calendar functions follow the session zone; every job here reads time as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only where the setting is missing and the master is local, a folder beside the warehouse serves.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or sc.getConf().get(CHECKPOINT_DIR)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/txlake-checkpoints")
    return sc.getCheckpointDir()


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, grouped by application for cleaning up afterwards."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/txlake/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows and partitions stay fixed when an executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For frames that several later jobs read: each job then scans only the columns and partitions
    it needs, and a lost executor costs nothing that was already written. Partitioned frames are
    rebalanced first, so that not every task writes a file into every partition; AQE splits the
    large partitions again.
    """
    path = staging_path(df.sparkSession, label)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether there is any file at ``path`` that Spark's readers see."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return bool(found.select("path").take(1))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str, prefix: str, whole: bool = False) -> list[int]:
    """The numbers of the folders ``<prefix><number>`` in ``path``, sorted; with ``whole`` only of those that a
    writer has finished."""
    at, fs = _file_system(spark, path)
    if not fs.exists(at):
        return []
    found = []
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        done = not whole or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
        if status.isDirectory() and name.startswith(prefix) and done:
            found.append(int(name.removeprefix(prefix)))
    return sorted(found)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def refuse_new_checkpoint(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Raise if a stream would begin anew (no checkpoint yet) on an output that holds data.

    Batch numbers restart with a new checkpoint, so earlier batches would be replaced or taken for
    already written.
    """
    if not holds_files(spark, f"{checkpoint.rstrip('/')}/metadata") and holds_files(spark, path):
        raise RuntimeError(f"{path} holds data of another checkpoint than {checkpoint}; use that one or a new folder")
