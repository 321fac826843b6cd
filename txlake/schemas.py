"""Column types of the change envelope and the tables, and the model's feature list."""

from __future__ import annotations

from pyspark.sql import types as T

WINDOWS = (1, 7, 30)

# Feature names shared by training and serving.
FLAG_FEATURES = ["tx_during_weekend", "tx_during_night"]
CUSTOMER_FEATURES = [
    "customer_id_nb_tx_1day_window",
    "customer_id_avg_amount_1day_window",
    "customer_id_nb_tx_7day_window",
    "customer_id_avg_amount_7day_window",
    "customer_id_nb_tx_30day_window",
    "customer_id_avg_amount_30day_window",
]
TERMINAL_FEATURES = [
    "terminal_id_nb_tx_1day_window",
    "terminal_id_risk_1day_window",
    "terminal_id_nb_tx_7day_window",
    "terminal_id_risk_7day_window",
    "terminal_id_nb_tx_30day_window",
    "terminal_id_risk_30day_window",
]
FEATURES = ["tx_amount", *FLAG_FEATURES, *CUSTOMER_FEATURES, *TERMINAL_FEATURES]

# Row images as they travel in the change envelope.
TRANSACTION_IMAGE = T.StructType(
    [
        T.StructField("tx_id", T.LongType()),
        T.StructField("tx_datetime", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("terminal_id", T.LongType()),
        T.StructField("tx_amount", T.BinaryType()),
    ]
)


def location_image(id_name: str) -> T.StructType:
    """Image of the customer and terminal rows: an id and two coordinates."""
    return T.StructType(
        [
            T.StructField(id_name, T.LongType()),
            T.StructField("x_location", T.DoubleType()),
            T.StructField("y_location", T.DoubleType()),
        ]
    )


def envelope(image: T.StructType) -> T.StructType:
    """The parts of a change event the jobs read; JSON fields left out here are never parsed."""
    source = T.StructType(
        [
            T.StructField("lsn", T.LongType()),
            T.StructField("ts_us", T.LongType()),
            T.StructField("table", T.StringType()),
            T.StructField("snapshot", T.StringType()),
        ]
    )
    payload = T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("source", source),
            T.StructField("op", T.StringType()),
            T.StructField("ts_us", T.LongType()),
        ]
    )
    return T.StructType([T.StructField("payload", payload)])


# Columns of a log topic as Spark's Kafka source returns them.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# DDL of the lake tables (ids widened to BIGINT, coordinates kept as DOUBLE).
_AUDIT = "row_created_timestamp TIMESTAMP, row_updated_timestamp TIMESTAMP"
_CUSTOMER_DDL = ", ".join(
    f"{name} {'BIGINT' if 'nb_tx' in name else 'DOUBLE'}" for name in CUSTOMER_FEATURES
)
_TERMINAL_DDL = ", ".join(
    f"{name} {'BIGINT' if 'nb_tx' in name else 'DOUBLE'}" for name in TERMINAL_FEATURES
)
_TX_DDL = (
    "tx_id BIGINT, tx_datetime TIMESTAMP, customer_id BIGINT, terminal_id BIGINT, "
    f"tx_amount DECIMAL(10,2), {_AUDIT}"
)

# table -> (columns, partition column or None)
TABLES: dict[str, tuple[str, str | None]] = {
    "customer": (f"customer_id BIGINT, x_location DOUBLE, y_location DOUBLE, {_AUDIT}", None),
    "terminal": (f"terminal_id BIGINT, x_location DOUBLE, y_location DOUBLE, {_AUDIT}", None),
    "transactions": (f"{_TX_DDL}, dt DATE", "dt"),
    "feature_customer": (f"customer_id BIGINT, {_CUSTOMER_DDL}, {_AUDIT}, dt DATE", "dt"),
    "feature_terminal": (f"terminal_id BIGINT, {_TERMINAL_DDL}, {_AUDIT}", None),
    "analyzed_transactions": (
        f"{_TX_DDL}, tx_during_weekend INT, tx_during_night INT, {_CUSTOMER_DDL}, "
        f"{_TERMINAL_DDL}, features_missing INT, processed_at TIMESTAMP, prediction DOUBLE",
        None,
    ),
}
