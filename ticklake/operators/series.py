"""Ordered series per symbol: moving averages, candles, base-100 indices, history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions import indicators
from ticklake.operators import ranking, slices

#: Moving-average column -> ticks in its frame.
MOVING_AVERAGES = {"ma7": 7, "ma25": 25}

#: Column labels of the history table.
HISTORY_LABELS = {
    "timestamp_ts": "Timestamp",
    "open_price": "Open",
    "high_price": "High",
    "low_price": "Low",
    "close_price": "Close",
    "volume": "Volume",
    "pct_change": "% Change",
    "volatility": "Volatility",
    "spread": "Spread",
}


def moving_averages(
    ticks: DataFrame,
    frames: Mapping[str, int] = MOVING_AVERAGES,
    column: str = "close_price",
    time: str = "timestamp_ts",
    tie: str | None = None,
    newest_first: bool = False,
    slice_rows: int | None = slices.SLICE_ROWS,
    large: slices.Large | None = None,
) -> DataFrame:
    """Row means over each tick and the ones before it, per symbol.

    NULL until a frame of n rows holds n values. ``newest_first`` walks the symbol
    backwards, so each frame holds the tick and the *later* ones: the details view of the
    dashboard averages that way.

    Counts rows per symbol first: if one exceeds ``slice_rows``, its window is cut into
    slices of its sorted rows with the same results. ``slice_rows=None`` skips the count, and the cut too
    unless the caller has counted and gives ``large``.
    """
    known = ticks.filter(F.col("symbol").isNotNull())
    sort_keys = [time] + ([tie] if tie else [])
    toward = F.desc_nulls_last if newest_first else F.asc_nulls_last
    order = [toward(key) for key in sort_keys]

    keys = ["symbol"]
    rows = known
    if large is None and slice_rows is not None:
        large = slices.large_symbols(known, slice_rows)
    if large is not None:
        reach = max(frames.values()) - 1
        needed = list(dict.fromkeys([*sort_keys, column]))
        rows = slices.with_reach(known, large, reach, needed, order)
        keys.append("slice")
        order = [*order, F.col("place")]
    walk = Window.partitionBy(*keys).orderBy(*order)

    # Values so far, so that a frame's count is a difference of two of them and only the
    # sums slide; a full frame has as many values as rows.
    so_far = F.count(column).over(walk.rowsBetween(Window.unboundedPreceding, 0))

    def mean(length: int) -> Column:
        before = F.coalesce(F.lag("so_far", length).over(walk), F.lit(0))
        total = F.sum(column).over(walk.rowsBetween(1 - length, 0))
        return F.when(F.col("so_far") - before >= length, total / length)

    counted = rows.withColumn("so_far", so_far)
    averaged = counted.withColumns({name: mean(length) for name, length in frames.items()})
    averaged = averaged.drop("so_far")
    if large is not None:
        averaged = averaged.filter("own").drop("own", "slice", "place")
    return averaged


def candle_series(ticks: DataFrame, **options) -> DataFrame:
    """Open, high, low, close, volume, both moving averages and the candle colour."""
    columns = ["symbol", "timestamp_ts", "open_price", "high_price", "low_price", "close_price"]
    tie = [options["tie"]] if options.get("tie") else []
    rows = ticks.select(*columns, "volume", *tie)
    return moving_averages(rows, **options).withColumn("color", indicators.candle_direction())


def symbol_history(ticks: DataFrame, **options) -> DataFrame:
    """The details view: indicators and forward averages of each tick, for one or all symbols."""
    columns = ["symbol", "timestamp_ts", "open_price", "high_price", "low_price", "close_price"]
    tie = [options["tie"]] if options.get("tie") else []
    rows = moving_averages(ticks.select(*columns, "volume", *tie), newest_first=True, **options)
    return indicators.with_dashboard_indicators(rows)


def history_table(history: DataFrame, symbol: str) -> DataFrame:
    """One symbol's history, newest first, under its display labels."""
    rows = history.filter(F.col("symbol") == symbol).orderBy(F.desc("timestamp_ts"))
    return rows.select(*(F.col(name).alias(label) for name, label in HISTORY_LABELS.items()))


def gainers_base100(ticks: DataFrame, k: int = ranking.TOP, order: str = "timestamp_ts") -> DataFrame:
    """Close of the k best gainers, as an index with 100 at each one's first tick.

    First close and latest change come from one aggregate, so no window is needed; the
    broadcast side has k rows.
    """
    rows = ticks.filter(F.col("symbol").isNotNull())
    change = indicators.pct_change()
    per_symbol = (
        rows.select("symbol", order, "close_price", change.alias("pct_change"))
        .groupBy("symbol")
        .agg(
            F.max_by("pct_change", F.when(F.col("pct_change").isNotNull(), F.col(order))).alias(
                "pct_change"
            ),
            F.min_by("close_price", order).alias("first_close"),
        )
    )
    best = ranking.top_k(per_symbol, "pct_change", k).select("symbol", "first_close")
    index = F.try_divide("close_price", "first_close") * 100
    return rows.join(F.broadcast(best), "symbol").select(
        "symbol", "timestamp_ts", "close_price", index.alias("price_index")
    )
