"""Time columns: epoch milliseconds to timestamps, dates and epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tick_timestamp(millis: Column | str = "timestamp") -> Column:
    """Epoch milliseconds as a timestamp of whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(_col(millis)))


def epoch_millis(timestamp: Column | str) -> Column:
    return F.unix_millis(_col(timestamp).cast("timestamp"))


def snapshot_date(run_ts: Column | str = "run_ts") -> Column:
    return F.to_date(_col(run_ts))


def utc_date(timestamp: Column | str = "timestamp_ts") -> Column:
    """The UTC day of a TIMESTAMP, whatever the session zone."""
    days = F.floor(F.unix_micros(_col(timestamp)) / F.lit(86_400_000_000)).cast("int")
    return F.date_from_unix_date(days)


def epoch_seconds(run_ts: Column | str = "run_ts") -> Column:
    return F.unix_seconds(_col(run_ts).cast("timestamp"))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
