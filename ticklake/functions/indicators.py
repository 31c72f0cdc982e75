"""Price indicators of one tick.

Two families share similar names and differ on purpose: the snapshot indicators are
fractions with a mid-price volatility, the dashboard indicators are rounded, in percent,
with a close-price volatility. A zero or NULL denominator gives NULL in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def price_range() -> Column:
    return F.col("high_price") - F.col("low_price")


def mid_price() -> Column:
    return (F.col("high_price") + F.col("low_price")) / 2


def return_pct() -> Column:
    """Move from open to close as a fraction of the open."""
    return F.try_divide(F.col("close_price") - F.col("open_price"), F.col("open_price"))


def volatility_pct() -> Column:
    """Price range as a fraction of the mid price."""
    return F.try_divide(price_range(), mid_price())


def quote_volume_million() -> Column:
    return (F.col("quote_volume") / 1_000_000).cast("double")


def pct_change() -> Column:
    """Move from open to close in percent, half-even at 4 places."""
    return F.bround(return_pct() * 100, 4)


def close_volatility() -> Column:
    """Price range as a fraction of the close, half-even at 6 places."""
    return F.bround(F.try_divide(price_range(), F.col("close_price")), 6)


def candle_direction() -> Column:
    """``green`` when the tick closed at or above its open, else ``red`` (also for NULLs)."""
    return F.when(F.col("close_price") >= F.col("open_price"), "green").otherwise("red")


def with_spread_and_mid(ticks: DataFrame) -> DataFrame:
    return ticks.withColumns({"spread": price_range(), "mid_price": mid_price()})


def with_snapshot_indicators(ticks: DataFrame) -> DataFrame:
    return ticks.withColumns(
        {
            "spread": price_range(),
            "mid_price": mid_price(),
            "quote_volume_million": quote_volume_million(),
            "volatility_abs": price_range(),
            "return_pct": return_pct(),
            "volatility_pct": volatility_pct(),
        }
    )


def with_dashboard_indicators(ticks: DataFrame) -> DataFrame:
    return ticks.withColumns(
        {
            "pct_change": pct_change(),
            "volatility": close_volatility(),
            "spread": F.bround(price_range(), 8),
        }
    )
