"""Per-entity feature rows for serving, and their join to transactions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.functions.scalars import during_night, during_weekend, ratio, unscaled
from txlake.schemas import CUSTOMER_FEATURES, TERMINAL_FEATURES, WINDOWS

DAY_MICROS = 86_400_000_000


def matching(df: DataFrame, pattern: str) -> list[str]:
    """Names of the columns matching a regular expression."""
    return df.select(df.colRegex(f"`{pattern}`")).columns


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def latest_features(
    df: DataFrame, entity: str, features: list[str], until: dt.date | None = None,
    time: str = "tx_datetime", tie: str = "tx_id",
) -> DataFrame:
    """Each entity's feature values at its last row (up to the end of ``until``).

    Of rows with the same last time the one with the smallest ``tie`` counts.
    """
    if until is not None:
        df = df.where(F.col(time) < F.lit(until + dt.timedelta(days=1)).cast("timestamp"))
    picked = df.groupBy(entity).agg(
        F.max_by(F.struct(*features), F.struct(F.col(time), -F.col(tie))).alias("_f")
    )
    return picked.select(entity, *[F.col(f"_f.{c}").alias(c) for c in features])


def first_features_on(
    df: DataFrame, entity: str, features: list[str], day: dt.date,
    time: str = "tx_datetime", tie: str = "tx_id",
) -> DataFrame:
    """Each entity's feature values at its first row on ``day``."""
    begin = F.lit(day).cast("timestamp")
    end = F.lit(day + dt.timedelta(days=1)).cast("timestamp")
    picked = (
        df.where((F.col(time) >= begin) & (F.col(time) < end))
        .groupBy(entity)
        .agg(F.min_by(F.struct(*features), F.struct(time, tie)).alias("_f"))
    )
    return picked.select(entity, *[F.col(f"_f.{c}").alias(c) for c in features])


def customer_snapshot(
    tx: DataFrame, windows=WINDOWS, until: dt.date | None = None, first_on: dt.date | None = None,
) -> DataFrame:
    """Each customer's rolling features at the last row (up to the end of ``until``) or, with
    ``first_on``, at the first row on that day.

    Equal to the rolling features of that row, without features for any other: the row's time is
    found by an aggregation, and only the rows within the longest window before it are summed.
    With ``first_on`` no more than that window is read.
    """
    if first_on is not None:
        tx = _between(tx, first_on - dt.timedelta(days=max(windows)), first_on)
        at = F.min(F.when(F.to_date("tx_datetime") == F.lit(first_on), F.col("tx_datetime")))
    else:
        tx = tx if until is None else _between(tx, None, until)
        at = F.max("tx_datetime")
    counted = F.col("tx_amount").isNotNull()
    sums = _around(
        tx, "customer_id", at, windows, 0, {"cnt": counted, "cents": unscaled(F.col("tx_amount"))}
    )
    new = []
    for n in windows:
        new.append(F.col(f"cnt_{n}").alias(f"customer_id_nb_tx_{n}day_window"))
        amount = F.col(f"cents_{n}").cast("double") / F.lit(100.0).cast("double")
        new.append(ratio(amount, F.col(f"cnt_{n}")).alias(f"customer_id_avg_amount_{n}day_window"))
    return sums.select("customer_id", *new)


def terminal_snapshot(tx: DataFrame, windows=WINDOWS, delay: int = 7) -> DataFrame:
    """Each terminal's delayed risk features at its last row; see :func:`customer_snapshot`."""
    sums = _around(
        tx, "terminal_id", F.max("tx_datetime"), windows, delay,
        {"cnt": F.col("tx_fraud").isNotNull(), "bad": F.col("tx_fraud")},
    )
    new = []
    for n in windows:
        new.append(F.col(f"cnt_{n}").alias(f"terminal_id_nb_tx_{n}day_window"))
        risk = ratio(F.col(f"bad_{n}"), F.col(f"cnt_{n}"), 0.0)
        new.append(risk.alias(f"terminal_id_risk_{n}day_window"))
    return sums.select("terminal_id", *new)


def _between(tx: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
    """Rows of the days from ``first`` to ``last``: a range on the raw time reaches the reader."""
    time = F.col("tx_datetime")
    tx = tx.where(time < F.lit(last + dt.timedelta(days=1)).cast("timestamp"))
    return tx if first is None else tx.where(time >= F.lit(first).cast("timestamp"))


def _around(
    tx: DataFrame, entity: str, at: Column, windows, delay: int, measures: dict[str, Column]
) -> DataFrame:
    """Per entity ``<measure>_<n>``: the sum over its rows in ``(at - delay - n, at - delay]``.

    Times first meet in one row per entity; the sums combine before their shuffle.
    """
    tx = tx.where(F.col(entity).isNotNull() & F.col("tx_datetime").isNotNull())
    times = tx.groupBy(entity).agg(at.alias("_at")).where(F.col("_at").isNotNull())
    age = F.unix_micros("_at") - F.unix_micros("tx_datetime") - delay * DAY_MICROS
    rows = tx.join(times, entity).withColumn("_age", age)
    aggs = []
    for n in windows:
        inside = (F.col("_age") >= 0) & (F.col("_age") < n * DAY_MICROS)
        for name, value in measures.items():
            total = F.sum(F.when(inside, value.cast("long")))
            aggs.append(F.coalesce(total, F.lit(0)).alias(f"{name}_{n}"))
    return rows.groupBy(entity).agg(*aggs)


def calendar_features(
    tx: DataFrame, as_of: dt.date, windows=WINDOWS, end_offset: int = 1,
    drive_by_1day: bool = False,
) -> DataFrame:
    """Count and average amount per customer over whole days before ``as_of``.

    Every window ends ``end_offset`` days before ``as_of`` (0: the day itself counts) and window
    ``n`` starts ``n`` days before it; the 1-day window is always the one day before. One scan and
    one aggregation serve all windows. ``drive_by_1day`` keeps only customers active on that day.
    """
    end = as_of - dt.timedelta(days=end_offset)
    first = as_of - dt.timedelta(days=max(windows))
    day = F.to_date("tx_datetime")
    # A range on the raw time reaches the Parquet reader; one on the derived date would not.
    scope = (F.col("tx_datetime") >= F.lit(first).cast("timestamp")) & (
        F.col("tx_datetime")
        < F.lit(max(end, as_of - dt.timedelta(days=1)) + dt.timedelta(days=1)).cast("timestamp")
    )
    aggs = []
    for n in windows:
        start = as_of - dt.timedelta(days=n)
        last = start if n == 1 else end
        inside = (day >= F.lit(start)) & (day <= F.lit(last))
        aggs += [
            F.count_if(inside).alias(f"_n{n}"),
            F.count_if(inside & F.col("tx_amount").isNotNull()).alias(f"_a{n}"),
            F.sum(F.when(inside, unscaled(F.col("tx_amount")))).alias(f"_s{n}"),
        ]
    sums = tx.where(scope & F.col("customer_id").isNotNull()).groupBy("customer_id").agg(*aggs)
    if drive_by_1day:
        sums = sums.where(F.col(f"_n{min(windows)}") > 0)
    columns: list[Column] = [F.col("customer_id"), F.lit(as_of).alias("dt")]
    for n in windows:
        columns.append(F.col(f"_n{n}").alias(f"customer_id_nb_tx_{n}day_window"))
        amount = F.col(f"_s{n}").cast("double") / F.lit(100.0).cast("double")
        columns.append(ratio(amount, F.col(f"_a{n}")).alias(f"customer_id_avg_amount_{n}day_window"))
    return sums.select(*columns)


def calendar_features_on(
    tx: DataFrame, days: list[tuple[dt.date, int]], windows=WINDOWS
) -> DataFrame:
    """:func:`calendar_features` for many (date, end_offset), each date once, in one scan.

    The transactions are reduced to a count and a sum per customer and day; those partial rows, not
    the transactions, are then handed to every date whose windows hold them.
    """
    first = min(d for d, _ in days) - dt.timedelta(days=max(windows))
    last = max(max(d - dt.timedelta(days=end), d - dt.timedelta(days=1)) for d, end in days)
    amount = F.col("tx_amount")
    daily = (
        _between(tx, first, last).where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", F.to_date("tx_datetime").alias("_day"))
        .agg(F.count(F.lit(1)).alias("_n"), F.count(amount).alias("_a"), F.sum(unscaled(amount)).alias("_s"))
    )
    dates = F.array(*[F.struct(F.lit(d).alias("dt"), F.lit(end).alias("end")) for d, end in days])
    spread = daily.select("*", F.explode(dates).alias("_to")).select(
        "customer_id", F.col("_to.dt").alias("dt"), F.col("_to.end").alias("_end"), "_n", "_a", "_s",
        F.date_diff(F.col("_to.dt"), F.col("_day")).alias("_age"),
    )
    aggs, columns = [], [F.col("customer_id"), F.col("dt")]
    held = F.lit(False)
    for n in windows:
        inside = (F.col("_age") <= n) & (F.col("_age") >= (F.lit(n) if n == 1 else F.col("_end")))
        held = held | inside
        for name in ("_n", "_a", "_s"):
            aggs.append(F.sum(F.when(inside, F.col(name))).alias(f"{name}{n}"))
        total = F.col(f"_s{n}").cast("double") / F.lit(100.0).cast("double")
        columns.append(F.coalesce(F.col(f"_n{n}"), F.lit(0)).cast("long").alias(f"customer_id_nb_tx_{n}day_window"))
        mean = ratio(total, F.coalesce(F.col(f"_a{n}"), F.lit(0)))
        columns.append(mean.alias(f"customer_id_avg_amount_{n}day_window"))
    return spread.where(held).groupBy("customer_id", "dt").agg(*aggs).select(*columns)


def known_before(days: DataFrame, customer_features: DataFrame) -> DataFrame:
    """(customer_id, day, features): for each distinct row (customer_id, day) the customer's latest snapshot
    dated before the day; rows without one are left out.

    A merge of both sides: snapshots and days of a customer come in one order, and each day takes over
    what the last snapshot before it carried along. A customer has as many rows as days and snapshots,
    however many transactions, and no day meets more than one snapshot. Snapshots are at most one per
    customer and date.
    """
    values = F.struct(*CUSTOMER_FEATURES)
    given = customer_features.where(F.col("dt").isNotNull()).select(
        "customer_id", F.date_add("dt", 1).alias("day"), F.lit(False).alias("asks"), values.alias("carried")
    )
    asked = days.select("customer_id", "day", F.lit(True).alias("asks"), F.lit(None).cast(given.schema["carried"].dataType).alias("carried"))
    both = given.unionByName(asked).where(F.col("customer_id").isNotNull() & F.col("day").isNotNull())
    so_far = Window.partitionBy("customer_id").orderBy("day", "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("carried", F.last("carried", ignorenulls=True).over(so_far))
    return found.where(F.col("asks") & F.col("carried").isNotNull()).select("customer_id", "day", "carried.*")


def version_before(day: Column, dates: list[dt.date]) -> Column:
    """The latest of the sorted ``dates`` before ``day``, null if there is none: looked up by the day's number."""
    if not dates:
        return F.lit(None).cast("date")
    by_day: list[dt.date] = []
    for earlier, later in zip(dates, [*dates[1:], dates[-1] + dt.timedelta(days=1)]):
        by_day += [earlier] * (later - earlier).days
    # Day 0 is the day after the first date.
    number = F.date_diff(day, F.lit(dates[0])) - 1
    return F.get(F.lit(by_day), F.when(number >= 0, F.least(number, F.lit(len(by_day) - 1))))


def states(customer_features: DataFrame, dates: list[dt.date]) -> DataFrame:
    """(customer_id, day, features) for each of ``dates``: what is known of every customer at its end."""
    customers = customer_features.select("customer_id").distinct()
    asked = customers.select("customer_id", F.explode(F.lit([d + dt.timedelta(days=1) for d in dates])).alias("day"))
    return known_before(asked, customer_features).withColumn("day", F.date_add("day", -1))


def with_features(tx: DataFrame, at: Column, customers: DataFrame, terminals: DataFrame) -> DataFrame:
    """Transactions with flags, the features of rows (customer_id, day) of ``customers`` whose ``day`` is
    ``at``, and those of their terminal. See :func:`enrich` for what is missing."""
    known = customers.select(F.col("customer_id").alias("_cid"), F.col("day").alias("_day"), *CUSTOMER_FEATURES)
    terms = terminals.select(F.col("terminal_id").alias("_tid"), *TERMINAL_FEATURES)
    joined = tx.join(known, (F.col("customer_id") == F.col("_cid")) & (at == F.col("_day")), "left").join(
        terms, F.col("terminal_id") == F.col("_tid"), "left"
    )
    filled = [
        F.coalesce(F.col(c), F.lit(0).cast("long" if "nb_tx" in c else "double")).alias(c)
        for c in [*CUSTOMER_FEATURES, *TERMINAL_FEATURES]
    ]
    missing = F.col("_cid").isNull().cast("int") + F.col("_tid").isNull().cast("int") * 2
    return joined.select(
        *tx.columns,
        during_weekend(F.col("tx_datetime")).alias("tx_during_weekend"),
        during_night(F.col("tx_datetime")).alias("tx_during_night"),
        *filled,
        missing.alias("features_missing"),
    )


def enrich(tx: DataFrame, customer_features: DataFrame, terminal_features: DataFrame) -> DataFrame:
    """Transactions with flags and the feature rows known before their day.

    ``tx`` may be a stream. Each transaction meets at most one customer row, however many
    snapshots exist: all joins are on equal keys, customer and day, and the day's snapshot is found
    once per customer and day, not per transaction. Missing features become 0 and are marked in
    ``features_missing`` (1 customer, 2 terminal, 3 both). The feature sides are broadcast only if Spark
    finds them under its size threshold; otherwise these are shuffle joins, split by AQE where a key
    is hot. A stream cannot ask for its days beforehand: it meets the state of each snapshot date, whose
    dates (one per calendar day at most) the driver knows.
    """
    day = F.to_date("tx_datetime")
    if tx.isStreaming:
        dates = [r[0] for r in customer_features.where("dt IS NOT NULL").select("dt").distinct().orderBy("dt").collect()]
        return with_features(tx, version_before(day, dates), states(customer_features, dates), terminal_features)
    asked = tx.select("customer_id", day.alias("day")).distinct()
    return with_features(tx, day, known_before(asked, customer_features), terminal_features)
