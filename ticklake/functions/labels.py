"""Report text built in the JVM.

``format_number`` rounds the exact binary value half-even; ``format_string('%.2f')`` would
round the shortest decimal text half-up and disagree on ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: volatility from which a label warns.
VOLATILITY_WARNING = 0.02

#: Column labels of the dashboard's ranking and alert tables.
TABLE_LABELS = {
    "symbol": "Symbole",
    "close_price": "Prix Clôture",
    "volume": "Volume",
    "pct_change": "Variation (%)",
    "volatility": "Volatilité",
}


def labelled(rows: DataFrame) -> DataFrame:
    """A ranking or alert table under its display labels, in its own column order."""
    return rows.select(*(F.col(name).alias(TABLE_LABELS[name]) for name in rows.columns))


def percent_text(fraction: Column) -> Column:
    """``0.0123`` as ``1.23%``."""
    return F.concat(_plain(fraction * 100, 2), F.lit("%"))


def return_label(fraction: Column) -> tuple[Column, Column]:
    """(text, class): signed percent, ``good`` from zero up, ``bad`` below, ``-`` without a value."""
    sign = F.when(fraction > 0, "+").otherwise("")
    text = F.when(_present(fraction), F.concat(sign, percent_text(fraction))).otherwise("-")
    label = F.when(_present(fraction), F.when(fraction >= 0, "good").otherwise("bad"))
    return text, label


def warning_label(fraction: Column, threshold: float = VOLATILITY_WARNING) -> tuple[Column, Column]:
    """(text, class): unsigned percent, ``warn`` from the threshold up, else ``good``."""
    text = F.when(_present(fraction), percent_text(fraction)).otherwise("-")
    label = F.when(_present(fraction), F.when(fraction >= threshold, "warn").otherwise("good"))
    return text, label


def volume_text(amount: Column) -> Column:
    """No decimals, a space between thousands."""
    return F.replace(F.format_number(amount, 0), F.lit(","), F.lit(" "))


def _plain(value: Column, places: int) -> Column:
    return F.replace(F.format_number(value, places), F.lit(","), F.lit(""))


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)
