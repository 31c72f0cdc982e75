"""Landed 24-hour ticker snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schemas import MEASURES, SNAPSHOT_COLUMNS, SNAPSHOT_FIELDS, SNAPSHOT_PAYLOAD


def load_snapshot(
    spark: SparkSession, path: str, run_ts: dt.datetime, multi_line: bool = False
) -> DataFrame:
    """Ticker files of one snapshot as rows of the snapshot table.

    A line holds one ticker or an array of tickers, so large landings split by line;
    ``multi_line=True`` reads pretty-printed files, one task each. Any broken text, missing
    field or bad number fails the load, whatever the session's ANSI setting: a snapshot is
    taken whole or not at all.
    ``run_ts`` is UTC, one value for the whole snapshot.
    """
    payload = (
        spark.read.schema(SNAPSHOT_PAYLOAD)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .json(path)
    )
    kinds = {name: "double" for name in MEASURES} | {"symbol": "string", "close_time": "bigint"}
    columns = {name: _required(field, kinds[name]) for name, field in SNAPSHOT_FIELDS.items()}
    columns["run_ts"] = F.timestamp_micros(F.lit(_micros(run_ts)))
    return payload.select(*(columns[name].alias(name) for name in SNAPSHOT_COLUMNS))


def _required(field: str, kind: str) -> Column:
    text = F.col(field)
    bad = F.concat(F.lit(f"snapshot ticker with {field} "), text)
    missing = F.lit(f"snapshot ticker without {field}")
    value = text.try_cast(kind)
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.coalesce(bad, missing)))


def _micros(moment: dt.datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (moment - epoch) // dt.timedelta(microseconds=1)
