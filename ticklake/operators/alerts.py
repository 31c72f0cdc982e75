"""Alerts on the latest values per symbol.

The quantile and the rows compared with it both read ``latest``: pass a persisted or
checkpointed frame (one row per symbol), else the ticks behind it are scanned twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake import scratch

#: A move above this many percent, a volatility above this quantile.
LARGE_MOVE = 5
HIGH_VOLATILITY = 0.75


def _is_large_move(threshold: float) -> Column:
    return F.abs("pct_change") > threshold


def quantile(rows: DataFrame, column: str, share: float) -> Column:
    """The interpolated quantile of a column as a scalar subquery; NULL without values.

    Counts per value are summed up before the shuffle and sorted by range. The sizes of the
    ranges, one row each, tell which of them hold the two order statistics; only those
    are ordered, each by itself, so no task sees all values.
    """
    counts = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    ranged = scratch.checkpointed(
        counts.agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange("value")
        .withColumn("part", F.spark_partition_id())
    )
    parts = ranged.groupBy("part").agg(F.sum("n").alias("rows"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    place = (F.sum("rows").over(Window.partitionBy(F.lit(0))) - 1) * F.lit(share)
    placed = parts.select(
        "part", "rows", F.coalesce(F.sum("rows").over(so_far), F.lit(0)).alias("before"), place.alias("place")
    ).filter((F.floor("place") < F.col("before") + F.col("rows")) & (F.ceil("place") >= F.col("before")))
    inside = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("before") + F.sum("n").over(inside)
    picked = ranged.join(F.broadcast(placed), "part").withColumn("reached", reached)
    return picked.agg(
        F.min(F.when(F.col("reached") > F.floor("place"), F.col("value"))).alias("lower"),
        F.min(F.when(F.col("reached") > F.ceil("place"), F.col("value"))).alias("upper"),
        F.max(F.col("place") - F.floor("place")).alias("rest"),
    ).select(F.col("lower") * (1 - F.col("rest")) + F.col("upper") * F.col("rest")).scalar()


def _volatility_bound(latest: DataFrame, share: float) -> Column:
    return quantile(latest, "volatility", share)


def large_moves(latest: DataFrame, threshold: float = LARGE_MOVE) -> DataFrame:
    return latest.filter(_is_large_move(threshold)).select(
        "symbol", "pct_change", "volume", "volatility"
    )


def high_volatility(latest: DataFrame, share: float = HIGH_VOLATILITY) -> DataFrame:
    bound = _volatility_bound(latest, share)
    return latest.filter(F.col("volatility") > bound).select(
        "symbol", "volatility", "pct_change", "volume"
    )


def alert_counts(
    latest: DataFrame, threshold: float = LARGE_MOVE, share: float = HIGH_VOLATILITY
) -> DataFrame:
    """Symbols per alert class; a class without symbols has no row."""
    bound = _volatility_bound(latest, share)
    alerts = F.array_compact(
        F.array(
            F.when(_is_large_move(threshold), "large_move"),
            F.when(F.col("volatility") > bound, "high_volatility"),
        )
    )
    return (
        latest.select(F.explode(alerts).alias("alert"))
        .groupBy("alert")
        .agg(F.count(F.lit(1)).alias("nb_symbols"))
    )
