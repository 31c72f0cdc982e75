"""The ``events`` table seen as ticks: one event is one tick, one day is one snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream.

    The path is written as a glob because the file stream source takes a plain path for a
    folder, and the table may be one file.
    """
    schema = read_events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _level() -> Column:
    """``$.k`` of the properties.

    Nearly all of them are one flat integer field, which a pattern reads several times
    faster than a JSON parser; any other text still goes through the parser.
    """
    flat = F.nullif(F.regexp_extract("props", r'^\{"k": (-?[0-9]+)\}$', 1), F.lit(""))
    return F.coalesce(flat, F.get_json_object("props", "$.k")).cast("double")


def as_ticks(events: DataFrame) -> DataFrame:
    shifted = F.col("close_price") * (1 + (F.col("level") - 50) / 1000.0)
    return events.select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("ts").alias("timestamp_ts"),
        "event_id",
        F.col("value").alias("close_price"),
        _level().alias("level"),
    ).select(
        "symbol",
        "timestamp_ts",
        "event_id",
        "close_price",
        shifted.alias("open_price"),
        (F.greatest(F.col("close_price"), shifted) * 1.01).alias("high_price"),
        (F.least(F.col("close_price"), shifted) * 0.99).alias("low_price"),
        (F.col("level") + 1).alias("volume"),
        ((F.col("level") + 1) * F.col("close_price")).alias("quote_volume"),
        F.date_trunc("day", "timestamp_ts").cast("timestamp_ntz").alias("run_ts"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(read_events(spark, sf_dir))
