"""Frames behind the dashboard views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions import indicators
from ticklake.operators import alerts, filters, ranking, series, slices, stats
from ticklake.schemas import DASHBOARD_COLUMNS

LATEST_COLUMNS = [name for name in DASHBOARD_COLUMNS if name != "symbol"]
LATEST_COLUMNS += ["pct_change", "volatility", "spread"]

#: Metric label -> column of the one-symbol summary.
SUMMARY_METRICS = {
    "Prix Ouverture": "open_price",
    "Prix Clôture": "close_price",
    "Prix Haut": "high_price",
    "Prix Bas": "low_price",
    "Spread": "spread",
    "Variation (%)": "pct_change",
    "Volatilité": "volatility",
    "Volume": "volume",
}


def working_set(
    ticks: DataFrame,
    symbols: Sequence[str] | DataFrame | None = None,
    period: str = "24H",
    limit: int | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Selected symbols, optionally only the newest ``limit`` ticks, then the period."""
    columns = DASHBOARD_COLUMNS + ([tie] if tie else [])
    recent = filters.recent_ticks(ticks.select(*columns), symbols, limit, tie)
    return indicators.with_dashboard_indicators(filters.period_window(recent, period))


def latest(ticks: DataFrame, order: str = "timestamp_ts") -> DataFrame:
    """Latest known values per symbol: the input of the top lists and the alerts.

    Has one row per symbol; persist it when several views of one refresh read it.
    """
    rows = indicators.with_dashboard_indicators(ticks)
    return stats.latest_per_symbol(rows, LATEST_COLUMNS, order)


def symbol_summary(ticks: DataFrame, order: str = "timestamp_ts") -> DataFrame:
    """The newest tick of each symbol as (symbol, metric, value) rows."""
    rows = indicators.with_dashboard_indicators(ticks)
    newest = stats.last_tick_per_symbol(rows, list(SUMMARY_METRICS.values()), order)
    pairs = F.array(
        *(
            F.struct(F.lit(label).alias("metric"), F.col(name).alias("value"))
            for label, name in SUMMARY_METRICS.items()
        )
    )
    return newest.select("symbol", F.inline(pairs))


def write_views(ticks: DataFrame, path: str) -> None:
    """Every view of a working set as Parquet below ``path``.

    The latest values per symbol are kept for the six views that read them; the working
    set itself is scanned per view, as it may be far larger than memory.
    """
    columns = ticks.select(*DASHBOARD_COLUMNS)
    # counted once for both views with windows
    counted = {"slice_rows": None, "large": slices.large_symbols(columns.filter("symbol IS NOT NULL"))}
    newest = latest(columns).persist()
    views = {
        "overview": stats.symbol_overview(columns),
        "candles": series.candle_series(columns, **counted),
        "history": series.symbol_history(columns, **counted),
        "summary": symbol_summary(columns),
        "top_volume": ranking.latest_by_volume(newest),
        "gainers": ranking.gainers(newest),
        "gainers_base100": series.gainers_base100(columns),
        "losers": ranking.losers(newest),
        "large_moves": alerts.large_moves(newest),
        "high_volatility": alerts.high_volatility(newest),
        "alert_counts": alerts.alert_counts(newest),
    }
    try:
        for name, view in views.items():
            view.write.mode("overwrite").parquet(f"{path}/{name}")
    finally:
        newest.unpersist()
