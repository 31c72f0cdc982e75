"""Schemas of the inputs and tables. Column names are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

PRICES = ["close_price", "open_price", "high_price", "low_price"]
MEASURES = PRICES + ["volume", "quote_volume"]

#: One JSON tick message; ``timestamp`` is epoch milliseconds.
TICK_MESSAGE = T.StructType(
    [T.StructField("symbol", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in MEASURES]
    + [T.StructField("timestamp", T.LongType())]
)

#: Tick column -> field of a 24-hour ticker in the snapshot payload.
SNAPSHOT_FIELDS = {
    "symbol": "symbol",
    "close_price": "lastPrice",
    "open_price": "openPrice",
    "high_price": "highPrice",
    "low_price": "lowPrice",
    "volume": "volume",
    "quote_volume": "quoteVolume",
    "close_time": "closeTime",
}

#: Snapshot payload as text: numbers and quoted numbers both arrive as text and are cast later.
SNAPSHOT_PAYLOAD = T.StructType(
    [T.StructField(field, T.StringType()) for field in SNAPSHOT_FIELDS.values()]
)

#: Tick column -> field of a mini ticker in the live payload.
MINI_TICKER_FIELDS = {
    "symbol": "s",
    "close_price": "c",
    "open_price": "o",
    "high_price": "h",
    "low_price": "l",
    "volume": "v",
    "quote_volume": "q",
    "timestamp": "E",
}

#: Columns of the snapshot table, without its partition column ``run_date``.
SNAPSHOT_COLUMNS = ["run_ts", "symbol"] + MEASURES + ["close_time"]

#: Columns of the stream table.
STREAM_COLUMNS = ["symbol"] + MEASURES + ["timestamp_ts", "spread", "mid_price"]

#: Columns the dashboard reads.
DASHBOARD_COLUMNS = [
    "timestamp_ts",
    "symbol",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
]


def snapshot_table_schema(decimal: bool = False) -> T.StructType:
    """Snapshot table schema; ``decimal=True`` keeps prices as DECIMAL(38,18).

    DOUBLE is the default because a DECIMAL(38,18) quotient keeps six decimals only.
    """
    number = T.DecimalType(38, 18) if decimal else T.DoubleType()
    return T.StructType(
        [T.StructField("run_ts", T.TimestampType()), T.StructField("symbol", T.StringType())]
        + [T.StructField(name, number) for name in MEASURES]
        + [T.StructField("close_time", T.LongType()), T.StructField("run_date", T.DateType())]
    )
