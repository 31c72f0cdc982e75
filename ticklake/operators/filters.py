"""Row selections on tick tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Period label -> hours before the newest tick; None keeps everything.
PERIODS = {"1H": 1, "24H": 24, "7J": 7 * 24, "30J": 30 * 24, "Tout": None}


def _newest(ticks: DataFrame, column: str) -> Column:
    """The column's maximum as a literal of its type.

    One value is fetched because a scalar subquery does not reach the scan: only a literal
    lets Parquet skip the files and row groups below it. It is frozen when the plan is
    built. A TIMESTAMP travels as epoch microseconds, since its local text names two instants in
    the hour that repeats in autumn; the other types have no zone and travel as text.
    """
    kind = ticks.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        micros = ticks.agg(F.unix_micros(F.max(column))).first()[0]
        return F.timestamp_micros(F.lit(micros).cast("bigint"))
    text = ticks.agg(F.max(column).cast("string")).first()[0]
    return F.lit(text).cast(kind)


def latest_snapshot(
    ticks: DataFrame, run: str = "run_ts", recorded: str | None = None, day: str | None = None
) -> DataFrame:
    """Rows of the newest snapshot.

    ``day`` names a partition column that never falls while ``run`` rises: the search for
    the newest run then stays inside the last partition. ``recorded`` names a stored
    column that is never before its row's ``run``: a predicate on it is pushed to the scan
    where ``run`` itself is computed. Spark pushes it for TIMESTAMP, not for TIMESTAMP_NTZ.

    With ``day`` two values are fetched, one after the other: of a table appended to in
    between, the result is the newest run of the last day as the first look saw it.
    """
    rows = ticks if day is None else ticks.filter(F.col(day) == _newest(ticks, day))
    newest = _newest(rows, run)
    rows = rows.filter(F.col(run) == newest)
    return rows if recorded is None else rows.filter(F.col(recorded) >= newest)


def select_symbols(ticks: DataFrame, symbols: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the listed symbols; an empty list selects nothing.

    A list is pushed to the scan. A frame with a ``symbol`` column is semi-joined; hint its
    broadcast where its size is bounded.
    """
    if isinstance(symbols, DataFrame):
        return ticks.join(symbols, "symbol", "left_semi")
    return ticks.filter(F.col("symbol").isin(list(symbols)))


def recent_ticks(
    ticks: DataFrame,
    symbols: Sequence[str] | DataFrame | None = None,
    limit: int | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Ticks of the selected symbols; with ``limit`` only the newest, over all of them together."""
    rows = ticks.filter(F.col("symbol").isNotNull())
    rows = rows if symbols is None else select_symbols(rows, symbols)
    if limit is None:
        return rows
    newest = [F.desc("timestamp_ts")] + ([F.desc(tie)] if tie else []) + [F.asc("symbol")]
    return rows.orderBy(*newest).limit(limit)


def period_window(ticks: DataFrame, period: str = "24H") -> DataFrame:
    """Ticks no older than ``period`` before the newest tick of the frame, bounds included."""
    hours = PERIODS[period]
    if hours is None:
        return ticks
    oldest = _newest(ticks, "timestamp_ts") - F.expr(f"INTERVAL '{hours}' HOUR")
    return ticks.filter(F.col("timestamp_ts") >= oldest)


def newest_days(ticks: DataFrame, day: str, hours: int | None = None, time: str = "timestamp_ts") -> DataFrame:
    """The newest day of a table partitioned by ``day``, or its ticks of the last ``hours``; decided in the plan.

    The newest day, the newest time on it and the oldest day wanted are subqueries of partition
    filters: no job runs before the action, rows that were appended meanwhile are seen, and the scan opens the
    partitions that the subqueries leave. ``day`` is the UTC day of ``time``.
    """
    last_day = ticks.agg(F.max(day)).scalar()
    if hours is None:
        return ticks.filter(F.col(day) == last_day)
    newest = ticks.filter(F.col(day) == last_day).agg(F.max(time))
    oldest = newest.select(F.col(newest.columns[0]) - F.expr(f"INTERVAL '{int(hours)}' HOUR"))
    first_day = oldest.select(F.to_date(oldest.columns[0]))
    return ticks.filter((F.col(day) >= first_day.scalar()) & (F.col(time) >= oldest.scalar()))


def of_days(ticks: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """The ticks on the days that a frame names, by dynamic partition pruning.

    ``days`` has a column ``day``, one row per day and so a bounded size; it is broadcast, and the same
    broadcast prunes the partitions of the scan.
    """
    wanted = days.select(F.col(day)).distinct()
    return ticks.join(F.broadcast(wanted), day, "left_semi")
