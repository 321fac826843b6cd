import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txlake.functions import scalars as s


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "weekend"),
    [("2024-01-04", 0), ("2024-01-05", 0), ("2024-01-06", 1), ("2024-01-07", 1), ("2024-01-08", 0)],
)
def test_weekend(spark, text, weekend):
    assert one(spark, s.during_weekend(F.lit(text).cast("timestamp"))) == weekend


@pytest.mark.parametrize(
    ("text", "night"), [("00:00:00", 1), ("06:59:59", 1), ("07:00:00", 0), ("20:00:00", 0), ("23:59:59", 0)]
)
def test_night(spark, text, night):
    assert one(spark, s.during_night(F.lit(f"2024-01-04 {text}").cast("timestamp"))) == night


NUMBERS = [0, 1, 127, 128, 255, 256, 32767, 32768, -1, -128, -129, -32768, -32769, 9_999_999_999, -9_999_999_999]


@pytest.mark.parametrize("unscaled", NUMBERS)
def test_decimal_bytes(spark, unscaled):
    size = max(1, (unscaled.bit_length() + 8) // 8) if unscaled >= 0 else ((unscaled + 1).bit_length() + 8) // 8
    raw = unscaled.to_bytes(size, "big", signed=True)
    value = Decimal(unscaled) / 100
    df = spark.createDataFrame([(bytearray(raw), value)], "b binary, d decimal(10,2)")
    row = df.select(s.decode_decimal(F.col("b")).alias("d"), s.encode_decimal(F.col("d")).alias("b")).first()
    assert row.d == value
    assert bytes(row.b) == raw


def test_decimal_bytes_outside(spark):
    df = spark.createDataFrame(
        [(None,), (bytearray(b"\x01" * 9),), (bytearray(b"\x7f" + b"\xff" * 7),)], "b binary"
    )
    assert [r.d for r in df.select(s.decode_decimal(F.col("b")).alias("d")).collect()] == [None] * 3


def test_times(spark):
    origin = dt.date(2024, 1, 1)
    ts = F.lit("2024-01-03 10:00:00.123456").cast("timestamp")
    assert one(spark, s.day_index(ts, origin)) == 2
    assert one(spark, s.from_day_index(F.lit(2), origin)) == dt.date(2024, 1, 3)
    assert one(spark, s.from_seconds(F.lit(86401), origin)) == dt.datetime(2024, 1, 2, 0, 0, 1)
    assert one(spark, s.from_epoch_micros(F.lit(1_500_000))) == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)
    assert one(spark, s.from_epoch_micros(F.lit(1_500_000), True)) == dt.datetime(1970, 1, 1, 0, 0, 1)


def test_ratio_and_class(spark):
    assert one(spark, s.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, s.ratio(F.lit(1), F.lit(0), 1.0)) == 1.0
    assert one(spark, s.ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, s.predicted_class(F.lit(0.5))) == 1
    assert one(spark, s.predicted_class(F.lit(0.49))) == 0
