"""Aggregates over ticks.

Every aggregate here has a fixed-width buffer, so Spark runs it as a hash aggregate with
a map-side partial: a symbol that holds a third of all rows ships one row per task.
That is why "first" and "last" use one primitive ``order`` column (a struct key would
turn the plan into sorts): pass a column that grows with time and has no ties inside a
symbol, or accept an arbitrary choice among ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions import indicators


def symbol_totals(ticks: DataFrame) -> DataFrame:
    """Per-symbol sums and counts from which the KPIs, stats and rankings all derive."""
    indicated = ticks.select(
        "symbol",
        indicators.return_pct().alias("return_pct"),
        indicators.volatility_pct().alias("volatility_pct"),
        indicators.quote_volume_million().alias("quote_volume_million"),
    )
    return indicated.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("nb_rows"),
        F.sum("return_pct").alias("return_sum"),
        F.count("return_pct").alias("return_count"),
        F.sum("volatility_pct").alias("volatility_sum"),
        F.count("volatility_pct").alias("volatility_count"),
        F.sum("quote_volume_million").alias("total_quote_volume_million"),
    )


def stats_of(totals: DataFrame) -> DataFrame:
    return totals.select(
        "symbol",
        F.try_divide("return_sum", "return_count").alias("avg_return_pct"),
        F.try_divide("volatility_sum", "volatility_count").alias("avg_volatility_pct"),
        "total_quote_volume_million",
    )


def symbol_stats(ticks: DataFrame) -> DataFrame:
    """Average return, average volatility and total volume per symbol."""
    return stats_of(symbol_totals(ticks))


def kpi_columns() -> list[Column]:
    """Market KPIs as aggregates over ``symbol_totals``; absent values count as 0."""

    def mean(total: str, count: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(total), F.sum(count)), F.lit(0.0))

    return [
        F.count("symbol").alias("nb_symbols"),
        F.coalesce(F.sum("nb_rows"), F.lit(0)).alias("nb_rows"),
        F.coalesce(F.sum("total_quote_volume_million"), F.lit(0.0)).alias(
            "total_quote_volume_million"
        ),
        mean("return_sum", "return_count").alias("avg_market_return_pct"),
        mean("volatility_sum", "volatility_count").alias("avg_market_volatility_pct"),
    ]


def market_kpis(ticks: DataFrame) -> DataFrame:
    """One row: symbols, rows, total volume, average return, average volatility."""
    return symbol_totals(ticks).agg(*kpi_columns())


def latest_per_symbol(
    ticks: DataFrame, columns: Sequence[str], order: str = "timestamp_ts"
) -> DataFrame:
    """The last non-NULL value of each column per symbol, each column on its own."""
    ticks = ticks.filter(F.col("symbol").isNotNull())

    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name)

    return ticks.groupBy("symbol").agg(*(last(name) for name in columns))


def last_tick_per_symbol(
    ticks: DataFrame, columns: Sequence[str], order: str = "timestamp_ts"
) -> DataFrame:
    """The values of each symbol's newest tick, NULLs included."""
    ticks = ticks.filter(F.col("symbol").isNotNull())
    return ticks.groupBy("symbol").agg(*(F.max_by(name, order).alias(name) for name in columns))


def symbol_overview(ticks: DataFrame, order: str = "timestamp_ts") -> DataFrame:
    """Per symbol: first and latest close, change over the frame, and summary statistics.

    Volume is already a 24-hour figure at the source, so its sum over ticks over-counts;
    the column name says so.
    """
    known = ticks.filter(F.col("symbol").isNotNull())
    rows = known.withColumn("volatility", indicators.close_volatility())
    summary = rows.groupBy("symbol").agg(
        F.max_by("close_price", order).alias("latest_close"),
        F.min_by("close_price", order).alias("first_close"),
        F.avg("close_price").alias("avg_close"),
        F.max("high_price").alias("max_high"),
        F.min("low_price").alias("min_low"),
        F.avg("volatility").alias("avg_volatility"),
        F.sum("volume").alias("sum_reported_volume"),
    )
    change = F.col("latest_close") - F.col("first_close")
    return summary.withColumns(
        {"change_abs": change, "change_pct": F.try_divide(change, F.col("first_close")) * 100}
    )


def symbol_catalogue(ticks: DataFrame) -> DataFrame:
    """Distinct symbols in order."""
    return ticks.select("symbol").distinct().orderBy("symbol")
