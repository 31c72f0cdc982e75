"""Session set-up shared by the command line, the benchmark and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution.

    Timestamps are written as INT64 microseconds, because Parquet keeps no statistics for
    Spark's default INT96 and time filters would then read every row group.
    Sizing (shuffle partitions, memory, checkpoint folder) belongs to spark-submit or
    ``conf``; adaptive execution then coalesces or splits what the sizing got wrong.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Fail early where a non-UTC session zone would silently shift wall-clock ticks."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"tick times are UTC; set spark.sql.session.timeZone=UTC (is {zone!r})")
