"""Catalog tables and ad-hoc SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.operators.merge import merge_touched_partitions, merge_upsert, with_audit
from txlake.schemas import TABLES
from txlake.session import delete_folder, stage

OVERWRITE = "partitionOverwriteMode"
BUCKETS = 8
# Between a table's folder and the name of a version, and the property that names the one before.
VERSION, PREVIOUS = "__version_", "txlake.previous.location"

# The key each table is loaded by; dated tables are merged partition by partition.
LOAD_KEYS = {
    "customer": ["customer_id"],
    "terminal": ["terminal_id"],
    "transactions": ["tx_id"],
    "feature_customer": ["customer_id"],
    "feature_terminal": ["terminal_id"],
}


def ensure_table(
    spark: SparkSession, database: str, name: str, using: str = "parquet",
    location: str | None = None, buckets: int = BUCKETS,
) -> str:
    """Create the database (at ``location``) and the table if they are not there.

    An existing table is never dropped. A partitioned table carries its overwrite mode with it:
    ``insertInto`` follows the table, whatever the session says. A table without partitions is bucketed
    and sorted by its key, so that an upsert moves the source and not the table; ``buckets`` should make a
    bucket some hundred megabytes.
    """
    columns, partition = TABLES[name]
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    if partition:
        layout = f" OPTIONS ('{OVERWRITE}'='dynamic') PARTITIONED BY ({partition})"
    elif name in LOAD_KEYS:
        keys = ", ".join(LOAD_KEYS[name])
        layout = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
    else:
        layout = ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING {using}{layout}")
    return f"{database}.{name}"


def overwrites_by_partition(spark: SparkSession, table: str) -> bool:
    """Whether an overwriting insert leaves the partitions alone that it has no rows for."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Storage Properties'")
    mode = f"{OVERWRITE}=dynamic"
    own = [row["data_type"] for row in described.collect()]
    if any(mode.lower() in (x or "").lower() for x in own):
        return True
    session = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    return session.lower() == "dynamic" and not any(OVERWRITE.lower() in (x or "").lower() for x in own)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def upsert_table(source: DataFrame, table: str, keys: list[str], partition: str | None = None) -> None:
    """Upsert into a table of a format without row-level commands.

    Without ``partition`` the merged rows become a new version of the table: they are written to a
    folder of their own, and the table is then switched to it in one step of the catalog. Readers see the old
    rows or the new ones; a load that is cut off before the switch leaves the table as it was, and a folder
    that the next load does not use.

    With ``partition`` only the partitions the source touches are read and rewritten, and a table that
    would lose the others is refused. These rows are written to the shared folder first, since the partitions
    are read and replaced; they stay there until the application's folder is deleted, so a load that
    is cut off in the middle of the replacement can be finished from them.
    """
    spark = source.sparkSession
    if partition and not overwrites_by_partition(spark, table):
        raise ValueError(
            f"{table} drops untouched partitions on overwrite: "
            f"ALTER TABLE {table} SET SERDEPROPERTIES ('{OVERWRITE}'='dynamic')"
        )
    target = spark.table(table)
    incoming = source.select(*target.columns)
    if partition:
        merged = merge_touched_partitions(target, incoming, keys, partition)
        # Each task would write a file into every day; AQE splits large days again.
        merged = merged.hint("rebalance", partition)
    else:
        merged = merge_upsert(target, incoming, keys)
    # The table's own types, as MERGE would cast on assignment.
    typed = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    if partition:
        fixed = stage(typed, f"upsert-{table.replace('.', '-')}").hint("rebalance", partition)
        fixed.write.insertInto(table, overwrite=True)
    else:
        switch_version(spark, table, write_version(typed, table))


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table, by name."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _bucket_columns(text: str) -> list[str]:
    return [c.strip(" `") for c in text.strip("[]").split(",") if c.strip(" `")]


def write_version(rows: DataFrame, table: str) -> str:
    """Write ``rows`` beside the table's folder, laid out as the table is; the table does not change."""
    spark = rows.sparkSession
    said = _described(spark, table)
    place = f"{said['Location'].split(VERSION)[0].rstrip('/')}{VERSION}{uuid.uuid4().hex}"
    buckets = int(said.get("Num Buckets") or 0)
    if not buckets:
        rows.write.format(said["Provider"]).save(place)
        return place
    keys = _bucket_columns(said["Bucket Columns"])
    # One task per bucket writes one file; the name is needed for the layout only, its table goes at once.
    name = f"{table}_version_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, *keys)
    dealt.write.format(said["Provider"]).bucketBy(buckets, *keys).sortBy(*keys).option("path", place).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    return place


def switch_version(spark: SparkSession, table: str, place: str) -> None:
    """Let the table be what lies in ``place``. The folder it was in until now stays for readers that have
    begun; the one before that goes."""
    now = _described(spark, table)["Location"]
    older = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(PREVIOUS)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{now}')")
    spark.sql(f"REFRESH TABLE {table}")
    if older and VERSION in older:
        delete_folder(spark, older)


def load_table(
    source: DataFrame, database: str, name: str, as_of: Column | None = None,
    location: str | None = None, buckets: int = BUCKETS,
) -> str:
    """Bulk load: make sure the table exists, add the audit columns and upsert.

    A transaction's partition is the day of its time.
    """
    spark = source.sparkSession
    table = ensure_table(spark, database, name, location=location, buckets=buckets)
    partition = TABLES[name][1]
    if partition and partition not in source.columns:
        source = source.withColumn(partition, F.to_date("tx_datetime"))
    upsert_table(with_audit(source, as_of), table, LOAD_KEYS[name], partition)
    return table


def run_sql(spark: SparkSession, statement: str, **frames: DataFrame) -> DataFrame:
    """Run a statement; ``{name}`` in it refers to the frame given under that name."""
    return spark.sql(statement, **frames)
