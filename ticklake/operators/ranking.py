"""Top-k lists. ``orderBy.limit`` keeps k rows per task and never sorts a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP = 5

#: The pairs shown first when both exist.
PREFERRED_PAIRS = ("BTCUSDT", "ETHUSDT")


def top_k(rows: DataFrame, by: str, k: int = TOP, descending: bool = True) -> DataFrame:
    """The first k rows by ``by``; NULLs only fill up, ties go by symbol."""
    order = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return rows.orderBy(order, "symbol").limit(k)


def top_winners(stats: DataFrame, k: int = TOP) -> DataFrame:
    return top_k(stats, "avg_return_pct", k)


def top_losers(stats: DataFrame, k: int = TOP) -> DataFrame:
    return top_k(stats, "avg_return_pct", k, descending=False)


def top_volume(stats: DataFrame, k: int = TOP) -> DataFrame:
    return top_k(stats, "total_quote_volume_million", k)


def top_volatile(stats: DataFrame, k: int = TOP) -> DataFrame:
    return top_k(stats, "avg_volatility_pct", k)


def latest_by_volume(latest: DataFrame, k: int = TOP) -> DataFrame:
    columns = ("symbol", "close_price", "volume", "pct_change", "volatility")
    return top_k(latest.select(*columns), "volume", k)


def gainers(latest: DataFrame, k: int = TOP) -> DataFrame:
    return top_k(latest.select("symbol", "close_price", "pct_change"), "pct_change", k)


def losers(latest: DataFrame, k: int = TOP) -> DataFrame:
    rows = latest.select("symbol", "close_price", "pct_change")
    return top_k(rows, "pct_change", k, descending=False)


def default_pairs(symbols: DataFrame, preferred: Sequence[str] = PREFERRED_PAIRS) -> DataFrame:
    """The preferred pairs if all exist, else the alphabetically first ones, as many."""
    wanted = list(preferred)
    names = symbols.select("symbol").distinct().filter(F.col("symbol").isNotNull())
    place = F.nullif(F.array_position(F.array(*(F.lit(name) for name in wanted)), F.col("symbol")), F.lit(0))
    # Enough for either answer: the preferred names that exist, and the first of the others.
    few = names.withColumn("place", place).orderBy(F.asc_nulls_last("place"), "symbol")
    few = few.limit(2 * len(wanted)).withColumn("found", F.count("place").over(Window.partitionBy(F.lit(0))))
    rank = F.when(F.col("found") == len(wanted), F.col("place"))
    return few.orderBy(F.asc_nulls_last(rank), "symbol").limit(len(wanted)).select("symbol")
