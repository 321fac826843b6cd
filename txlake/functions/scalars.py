"""Column expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def during_weekend(ts: Column) -> Column:
    """1 on Saturday and Sunday."""
    return (F.weekday(ts) >= 5).cast("int")


def during_night(ts: Column) -> Column:
    """1 from 00:00:00 to 06:59:59."""
    return (F.hour(ts) <= 6).cast("int")


def micros(ts: Column) -> Column:
    """Epoch microseconds: the exact order key of all time windows."""
    return F.unix_micros(ts.cast("timestamp"))


def day_index(ts: Column, origin: dt.date) -> Column:
    """Whole days since ``origin``."""
    return F.datediff(F.to_date(ts), F.lit(origin)).cast("long")


def from_day_index(day: Column, origin: dt.date) -> Column:
    return F.date_add(F.lit(origin), day.cast("int"))


def from_seconds(seconds: Column, origin: dt.date) -> Column:
    """Timestamp that lies ``seconds`` after midnight of ``origin``."""
    start = int(dt.datetime(origin.year, origin.month, origin.day, tzinfo=dt.UTC).timestamp())
    return F.timestamp_seconds(F.lit(start) + seconds)


def from_epoch_micros(us: Column, truncate_seconds: bool = False) -> Column:
    """Microseconds to timestamp; ``truncate_seconds`` drops the fraction."""
    ts = F.timestamp_micros(us)
    return F.date_trunc("second", ts) if truncate_seconds else ts


def unscaled(amount: Column, scale: int = 2, precision: int = 10) -> Column:
    """Decimal amount as a whole number of its smallest unit, so sums are exact longs.

    Up to precision 14 the product fits a long and Spark computes it without big decimals.
    """
    return (amount.cast(f"decimal({precision},{scale})") * 10**scale).cast("long")


def decode_decimal(raw: Column, precision: int = 10, scale: int = 2) -> Column:
    """Big-endian two's-complement bytes to DECIMAL; NULL where they do not fit."""
    digits = F.hex(raw)
    signed = F.conv(
        F.when(digits >= F.lit("8"), F.lpad(digits, 16, "F")).otherwise(F.lpad(digits, 16, "0")),
        16,
        -10,
    )
    number = signed.cast("decimal(20,0)") / F.lit(10**scale).cast("decimal(10,0)")
    return F.when(F.length(raw) <= 8, number.try_cast(f"decimal({precision},{scale})"))


def encode_decimal(amount: Column, scale: int = 2, precision: int = 10) -> Column:
    """Inverse of :func:`decode_decimal` with the fewest whole bytes."""
    return encode_unscaled(unscaled(amount, scale, precision))


def encode_unscaled(number: Column) -> Column:
    """Long to big-endian two's-complement bytes, as few as keep the sign."""
    full = F.lpad(F.hex(number), 16, "0")
    # Bytes needed so that the sign bit survives: compare against 2^(8b-1).
    size = F.lit(8)
    for width in range(7, 0, -1):
        edge = 1 << (8 * width - 1)
        size = F.when((number >= -edge) & (number < edge), F.lit(width)).otherwise(size)
    return F.unhex(F.substring(full, F.lit(17) - size * 2, size * 2))


def hash_fraction(*parts: Column) -> Column:
    """Number in [0, 1) from the first 32 bits of an md5: same everywhere, on every run."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def predicted_class(score: Column, threshold: float = 0.5) -> Column:
    """1 at or above the threshold."""
    return (score >= F.lit(float(threshold))).cast("int")


def ratio(top: Column, bottom: Column, undefined: float | None = None) -> Column:
    """``top / bottom`` in doubles; ``undefined`` (default NULL) where bottom is 0."""
    return F.when(bottom != 0, top.cast("double") / bottom.cast("double")).otherwise(
        F.lit(undefined).cast("double")
    )
