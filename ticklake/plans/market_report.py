"""Report tables of the latest snapshot.

Everything derives from ``symbol_totals``: one scan, one shuffle, then per-symbol rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions import labels
from ticklake.operators import ranking, stats

#: Section name -> (ranked column, highest first).
SECTIONS = {
    "winners": ("avg_return_pct", True),
    "losers": ("avg_return_pct", False),
    "volume": ("total_quote_volume_million", True),
    "volatile": ("avg_volatility_pct", True),
}


def rankings(totals: DataFrame, k: int = ranking.TOP) -> DataFrame:
    """The four top lists with their display texts, one row per section and rank."""
    per_symbol = stats.stats_of(totals)

    def section(name: str) -> DataFrame:
        column, descending = SECTIONS[name]
        value = F.col(column) if descending else -F.col(column)
        best = ranking.top_k(per_symbol, column, k, descending)
        return best.select(F.lit(name).alias("section"), "*", value.alias("sort_value"))

    listed = reduce(DataFrame.unionByName, (section(name) for name in SECTIONS))
    place = Window.partitionBy("section").orderBy(F.desc_nulls_last("sort_value"), "symbol")
    return_text, return_class = labels.return_label(F.col("avg_return_pct"))
    volatility_text, volatility_class = labels.warning_label(F.col("avg_volatility_pct"))
    return listed.withColumn("rank", F.row_number().over(place)).select(
        "section",
        "rank",
        "symbol",
        "avg_return_pct",
        "avg_volatility_pct",
        "total_quote_volume_million",
        return_text.alias("return_text"),
        return_class.alias("return_class"),
        volatility_text.alias("volatility_text"),
        volatility_class.alias("volatility_class"),
        labels.volume_text(F.col("total_quote_volume_million")).alias("volume_text"),
    )


def summary(totals: DataFrame) -> DataFrame:
    """One row: market KPIs, the leader of each section, label texts and a sentence.

    The leaders are ``min_by`` aggregates next to the KPIs, so no join is needed.
    """
    named = {
        "best": ("avg_return_pct", True),
        "worst": ("avg_return_pct", False),
        "most_liquid": ("total_quote_volume_million", True),
        "most_volatile": ("avg_volatility_pct", True),
    }
    per_symbol = totals.withColumns(
        {
            "avg_return_pct": F.try_divide("return_sum", "return_count"),
            "avg_volatility_pct": F.try_divide("volatility_sum", "volatility_count"),
        }
    )
    leaders: list[Column] = []
    for name, (column, descending) in named.items():
        value = F.col(column)
        key = F.struct(value.isNull(), -value if descending else value, F.col("symbol"))
        leaders.append(F.min_by("symbol", key).alias(f"{name}_symbol"))
        leaders.append(F.min_by(column, key).alias(f"{name}_value"))
    row = per_symbol.agg(*stats.kpi_columns(), *leaders)
    market_return_text, market_return_class = labels.return_label(F.col("avg_market_return_pct"))
    volatility = labels.warning_label(F.col("avg_market_volatility_pct"))
    return row.select(
        "*",
        market_return_text.alias("market_return_text"),
        market_return_class.alias("market_return_class"),
        volatility[0].alias("market_volatility_text"),
        volatility[1].alias("market_volatility_class"),
        labels.volume_text(F.col("total_quote_volume_million")).alias("volume_text"),
        _sentence().alias("sentence"),
    )


def _sentence() -> Column:
    def percent(name: str) -> Column:
        return F.coalesce(labels.percent_text(F.col(name)), F.lit("-"))

    return F.concat_ws(
        "",
        F.lit("The market traded "),
        F.col("nb_symbols").cast("string"),
        F.lit(" symbols in "),
        F.col("nb_rows").cast("string"),
        F.lit(" rows for a volume of "),
        labels.volume_text(F.col("total_quote_volume_million")),
        F.lit(" M, with an average return of "),
        percent("avg_market_return_pct"),
        F.lit(" and an average volatility of "),
        percent("avg_market_volatility_pct"),
        F.lit(". Best: "),
        F.col("best_symbol"),
        F.lit(" ("),
        percent("best_value"),
        F.lit("); worst: "),
        F.col("worst_symbol"),
        F.lit(" ("),
        percent("worst_value"),
        F.lit("); most liquid: "),
        F.col("most_liquid_symbol"),
        F.lit(" ("),
        F.coalesce(labels.volume_text(F.col("most_liquid_value")), F.lit("-")),
        F.lit(" M); most volatile: "),
        F.col("most_volatile_symbol"),
        F.lit(" ("),
        percent("most_volatile_value"),
        F.lit(")."),
    )


def write_report(snapshot: DataFrame, path: str) -> None:
    """Rankings and summary of one snapshot as Parquet below ``path``.

    The per-symbol totals are kept for both tables, so the snapshot is scanned once.
    """
    totals = stats.symbol_totals(snapshot).persist()
    try:
        rankings(totals).write.mode("overwrite").parquet(f"{path}/rankings")
        summary(totals).write.mode("overwrite").parquet(f"{path}/summary")
    finally:
        totals.unpersist()
