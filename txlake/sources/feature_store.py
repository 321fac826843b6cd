"""Feature tables partitioned by snapshot date, of which a micro-batch reads only what it needs."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.operators.snapshots import version_before, with_features
from txlake.schemas import CUSTOMER_FEATURES, TERMINAL_FEATURES


def _schema(entity: str, features: list[str]) -> str:
    return ", ".join([f"{entity} bigint", *[f"{c} {'bigint' if 'nb_tx' in c else 'double'}" for c in features], "dt date"])


class FeatureStore:
    """Versions of the features in ``<path>/customer/dt=...`` and ``<path>/terminal/dt=...``.

    A version holds the state at the end of its date: the rows published for it and, of customers that
    it leaves out, those of the version before. So the rows that apply to a transaction are those of the
    latest version dated before its day: an equality on customer and date, decided when a version is written
    and not when it is read. A version is seen by readers once its entry in ``<path>/versions`` is
    written, which is the last step. Terminals are served from the latest version.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[dt.date]:
        """The dates of all versions, sorted; one per calendar day at most."""
        try:
            rows = self.spark.read.schema("published timestamp, dt date").parquet(f"{self.path}/versions")
            return [r[0] for r in rows.select("dt").distinct().orderBy("dt").collect()]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def customers(self, dates: list[dt.date]) -> DataFrame:
        """(customer_id, features, dt) of the versions of ``dates``; other partitions are not read."""
        return self._read("customer", "customer_id", CUSTOMER_FEATURES, dates)

    def terminals(self, dates: list[dt.date]) -> DataFrame:
        return self._read("terminal", "terminal_id", TERMINAL_FEATURES, dates)

    def _read(self, table: str, entity: str, features: list[str], dates: list[dt.date]) -> DataFrame:
        schema = _schema(entity, features)
        if not dates:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}").where(F.col("dt").isin(dates))

    def publish(self, date: dt.date, customers: DataFrame, terminals: DataFrame) -> None:
        """Write the version of ``date`` from rows (customer_id, features) and (terminal_id, features).

        Publishing the latest date again replaces it; an earlier date than the latest is refused, since later
        versions have been built on what was there.
        """
        dates = self.versions()
        if dates and date < dates[-1]:
            raise ValueError(f"{date} is before the latest version {dates[-1]}")
        before = [d for d in dates if d < date][-1:]
        for table, entity, features, new in (
            ("customer", "customer_id", CUSTOMER_FEATURES, customers), ("terminal", "terminal_id", TERMINAL_FEATURES, terminals),
        ):
            new = new.where(F.col(entity).isNotNull()).select(entity, *features)
            kept = self._read(table, entity, features, before).drop("dt").join(new, entity, "left_anti")
            state = new.unionByName(kept)
            state.write.mode("overwrite").parquet(f"{self.path}/{table}/dt={date}")
        entry = self.spark.range(1).select(F.current_timestamp().alias("published"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/dt={date}")

    def enrich(self, batch: DataFrame) -> DataFrame:
        """:func:`snapshots.enrich` of a micro-batch: of the customers, the partitions that its days need are
        read, reduced to its customers before the join; no window, no date in a join but as an equal key.

        The batch should be cached: its days (few, calendar days at most) go to the driver.
        """
        day = F.to_date("tx_datetime")
        days = [r[0] for r in batch.select(day).distinct().collect() if r[0] is not None]
        dates = self.versions()
        places = {bisect_left(dates, d) - 1 for d in days}
        needed = [dates[k] for k in sorted(places) if k >= 0]
        customers = self.customers(needed).withColumnRenamed("dt", "day")
        return with_features(
            batch, version_before(day, dates),
            customers.join(batch.select("customer_id").distinct(), "customer_id", "left_semi"),
            self.terminals(dates[-1:]).join(batch.select("terminal_id").distinct(), "terminal_id", "left_semi"),
        )
