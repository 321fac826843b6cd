"""Daily panes: whole sums per entity and day, kept up to date by changes, from which windows are put together.

A pane holds what one entity did on one day: transactions with an amount, their cents, transactions with a
label, the frauds among them. All are whole numbers, so a change adds its new image and takes off its old
one, exactly and in any order. The total up to a moment is the sum of the panes of all days before its day
and of the day's own rows up to it; a window is the difference of two such totals. So a transaction's
features need its entity's panes and the rows of a few days (of each edge of a window), never the history:
the same function serves training, over all rows, and serving, over a batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlake.functions.scalars import DAY_US, micros, ratio, unscaled
from txlake.operators.skew import broadcast_if_small
from txlake.schemas import WINDOWS
from txlake.session import delete_folder, folders, stage

SUMS = ("n_amounts", "cents", "n_labels", "frauds")
TASK_ROWS = 500_000
FEW_MOMENTS = 100_000


def _values() -> dict[str, Column]:
    amount, label = F.col("tx_amount"), F.col("tx_fraud")
    values = (amount.isNotNull().cast("long"), unscaled(amount), label.isNotNull().cast("long"), label.cast("long"))
    return {name: F.coalesce(value, F.lit(0)).cast("long") for name, value in zip(SUMS, values, strict=True)}


def _day(us: Column) -> Column:
    return F.floor(us / F.lit(DAY_US)).cast("long")


def _known(rows: DataFrame, entity: str) -> DataFrame:
    """Rows with an entity and a time, the time in microseconds and the number of its day."""
    timed = rows.withColumn("_us", micros(F.col("tx_datetime"))).where(F.col(entity).isNotNull() & F.col("_us").isNotNull())
    return timed.withColumn("_day", _day(F.col("_us")))


def panes_of(changes: DataFrame, entity: str) -> DataFrame:
    """(entity, day, sums) of transactions; with a column ``sign``, rows of -1 are taken off.

    Combined before the shuffle: one row per entity and day moves. Rows without entity or time are in none.
    """
    sign = F.col("sign") if "sign" in changes.columns else F.lit(1)
    rows = _known(changes, entity)
    sums = [F.sum(value * sign).alias(name) for name, value in _values().items()]
    return rows.groupBy(entity, F.col("_day").alias("day")).agg(*sums)


def merged(panes: DataFrame, entity: str) -> DataFrame:
    """One pane per entity and day; those that changes have emptied are left out."""
    sums = panes.groupBy(entity, "day").agg(*[F.sum(name).alias(name) for name in SUMS])
    used = F.lit(False)
    for name in SUMS:
        used = used | (F.col(name) != 0)
    return sums.where(used)


class PaneStore:
    """The panes of one entity under a folder, as a sum of what each batch of changes adds.

    A batch writes its own ``epoch`` folder and replaces it if it is run again, so it counts once. After
    a compaction panes are read from its base and the epochs behind it.
    """

    def __init__(self, spark: SparkSession, path: str, entity: str):
        self.spark, self.path, self.entity = spark, path.rstrip("/"), entity
        self.schema = f"{entity} bigint, day bigint, " + ", ".join(f"{name} bigint" for name in SUMS)

    def apply(self, changes: DataFrame, epoch: int) -> None:
        """Add the changes of a batch: images with ``sign`` 1 (holds from now on) or -1 (held until now)."""
        done = self._bases()
        if done and epoch <= done[-1]:
            raise ValueError(f"epoch {epoch} is part of the base up to {done[-1]}")
        panes = merged(panes_of(changes, self.entity), self.entity)
        panes.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")

    def panes(self) -> DataFrame:
        """The panes as of the last batch."""
        bases, epochs = self._bases(), folders(self.spark, self.path, "epoch=")
        done = bases[-1] if bases else -1
        paths = [f"{self.path}/base={done}"] if bases else []
        paths += [f"{self.path}/epoch={e}" for e in epochs if e > done]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return merged(self.spark.read.schema(self.schema).parquet(*paths), self.entity)

    def compact(self) -> None:
        """Write all panes as a new base; then the epochs in it and the bases before the last go.

        The base before stays until the next compaction, with the epochs behind it, for readers that have
        just begun. A base counts once it is whole.
        """
        epochs, bases = folders(self.spark, self.path, "epoch="), self._bases()
        if not epochs or (bases and epochs[-1] <= bases[-1]):
            return
        self.panes().write.mode("overwrite").parquet(f"{self.path}/base={epochs[-1]}")
        if not bases:
            return
        for old in (b for b in bases[:-1]):
            delete_folder(self.spark, f"{self.path}/base={old}")
        for old in (e for e in epochs if e <= bases[-1]):
            delete_folder(self.spark, f"{self.path}/epoch={old}")

    def _bases(self) -> list[int]:
        return folders(self.spark, self.path, "base=", whole=True)


def edges(windows=WINDOWS, delay: int = 0) -> list[int]:
    """How many days before a transaction the windows begin and end."""
    return sorted({delay, *[delay + n for n in windows]})


def edge_days(rows: DataFrame, windows=WINDOWS, delay: int = 0) -> list[dt.date]:
    """The dates whose rows :func:`window_sums` reads of the history: a filter for its partitions. One value
    per calendar day at most reaches the driver."""
    days = [r[0] for r in rows.select(F.to_date("tx_datetime")).distinct().collect() if r[0] is not None]
    return sorted({d - dt.timedelta(days=lag) for d in days for lag in edges(windows, delay)})


def _tasks(n: int) -> int:
    return max(1, -(-n // TASK_ROWS))


def window_sums(
    rows: DataFrame, panes: DataFrame, history: DataFrame, entity: str, windows=WINDOWS, delay: int = 0,
    names: tuple[str, ...] = SUMS,
) -> DataFrame:
    """(entity, _us, <sum>_<n>): for each entity and time of ``rows`` the sums over its transactions of
    ``(t - delay - n, t - delay]``.

    ``panes`` are those of all transactions, ``history`` holds at least the transactions of the days on
    which a window begins or ends (:func:`edge_days`), those of ``rows`` included. Both entity sorts are
    short: one of panes and asked days, one of the moments of a single day.

    What is asked for moves twice, by entity and day and by entity and time, each time over as many tasks as
    its exact number of rows asks for, so that a task holds the same however large the input is.
    """
    lags = edges(windows, delay)
    moments = stage(_known(rows, entity).groupBy(entity, "_us").agg(F.count(F.lit(1)).alias("_rows")), "pane-moments")
    n_moments, n_rows = moments.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    # Each becomes several questions: dealt out first, so that no task of the reader makes too many.
    dealt = moments.select(entity, "_us").repartition(_tasks(len(lags) * n_moments), entity, "_us")
    asked = dealt.select(entity, "_us", F.explode(F.array(*[F.lit(x) for x in lags])).alias("_lag"))
    asked = asked.withColumn("_at", F.col("_us") - F.col("_lag") * F.lit(DAY_US)).withColumn("_day", _day(F.col("_at")))
    days = broadcast_if_small(asked.select(entity, "_day").distinct())
    nothing = [F.lit(0).cast("long").alias(name) for name in names]

    inside = _known(history, entity)
    if n_moments <= FEW_MOMENTS:
        # Rows of other days change no sum; where few days are asked for, they need not move.
        inside = inside.join(days, [entity, "_day"], "left_semi")
    values = _values()
    points = stage(inside.groupBy(entity, "_us").agg(*[F.sum(values[name]).alias(name) for name in names]), "pane-points")

    steps = panes.select(entity, F.col("day").alias("_day"), *names, F.lit(True).alias("_pane")).unionByName(
        days.select(entity, "_day", *nothing, F.lit(False).alias("_pane"))
    )
    # A day's own pane comes behind the question for what was before it.
    before = Window.partitionBy(entity).orderBy("_day", "_pane").rowsBetween(Window.unboundedPreceding, 0)
    earlier = steps.select(entity, "_day", "_pane", *[F.sum(name).over(before).alias(name) for name in names]).where("NOT _pane")

    # A day begins with what was before it; a question stands last among what has its time.
    events = earlier.select(
        entity, "_day", (F.col("_day") * F.lit(DAY_US)).alias("_at"), F.lit(0).alias("_kind"), F.lit(0).alias("_lag"), *names
    )
    events = events.unionByName(points.select(
        entity, _day(F.col("_us")).alias("_day"), F.col("_us").alias("_at"), F.lit(1).alias("_kind"), F.lit(0).alias("_lag"), *names
    )).unionByName(asked.select(entity, "_day", "_at", F.lit(2).alias("_kind"), "_lag", *nothing))
    tasks = _tasks(len(lags) * n_moments + points.count() + n_rows)
    so_far = Window.partitionBy(entity, "_day").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    totals = events.repartition(tasks, entity, "_day").select(
        entity, "_at", "_kind", "_lag", *[F.sum(name).over(so_far).alias(name) for name in names]
    ).where("_kind = 2")
    totals = totals.select(entity, (F.col("_at") + F.col("_lag") * F.lit(DAY_US)).alias("_us"), "_lag", *names)
    window = lambda name, n: F.sum(
        F.when(F.col("_lag") == delay, F.col(name)).when(F.col("_lag") == delay + n, -F.col(name)).otherwise(0)
    )
    return totals.repartition(tasks, entity, "_us").groupBy(entity, "_us").agg(
        *[window(name, n).alias(f"{name}_{n}") for n in windows for name in names]
    )


def _joined(rows: DataFrame, sums: DataFrame, entity: str, new: list[Column]) -> DataFrame:
    timed = rows.withColumn("_us", micros(F.col("tx_datetime")))
    return timed.join(sums, [entity, "_us"]).select(*rows.columns, *new)


def customer_features(
    rows: DataFrame, panes: DataFrame, history: DataFrame, windows=WINDOWS, asked_in: DataFrame | None = None
) -> DataFrame:
    """``rows`` with the number and average amount of the customer's transactions in the last ``n`` days,
    equal to :func:`rolling.customer_rolling_features`. Rows without a customer or time get no feature row.
    ``asked_in`` names a cheaper frame with the same customers and times to look in."""
    asked = rows if asked_in is None else asked_in
    sums, new = window_sums(asked, panes, history, "customer_id", windows, names=("n_amounts", "cents")), []
    for n in windows:
        new.append(F.col(f"n_amounts_{n}").alias(f"customer_id_nb_tx_{n}day_window"))
        amount = F.col(f"cents_{n}").cast("double") / F.lit(100.0).cast("double")
        new.append(ratio(amount, F.col(f"n_amounts_{n}")).alias(f"customer_id_avg_amount_{n}day_window"))
    return _joined(rows, sums, "customer_id", new)


def terminal_features(
    rows: DataFrame, panes: DataFrame, history: DataFrame, windows=WINDOWS, delay: int = 7, asked_in: DataFrame | None = None
) -> DataFrame:
    """``rows`` with the number of transactions and share of frauds on the terminal, ``delay`` days earlier,
    equal to :func:`rolling.terminal_risk_features`. ``asked_in`` names a cheaper frame with the same terminals
    and times to look in."""
    asked = rows if asked_in is None else asked_in
    sums, new = window_sums(asked, panes, history, "terminal_id", windows, delay, ("n_labels", "frauds")), []
    for n in windows:
        new.append(F.col(f"n_labels_{n}").alias(f"terminal_id_nb_tx_{n}day_window"))
        new.append(ratio(F.col(f"frauds_{n}"), F.col(f"n_labels_{n}"), 0.0).alias(f"terminal_id_risk_{n}day_window"))
    return _joined(rows, sums, "terminal_id", new)
