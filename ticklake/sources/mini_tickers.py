"""Live payloads: a JSON array of mini tickers becomes one typed tick per element.

A missing symbol becomes an empty text and a missing number 0. An element that is no
object, or has a number field that is null or no number, is dropped alone; a message that
is no JSON array gives no ticks. VARIANT tells a missing field from an explicit null,
which ``from_json`` cannot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.schemas import MINI_TICKER_FIELDS


def explode_mini_tickers(messages: DataFrame) -> DataFrame:
    """Works on batch and streaming frames with a ``value`` column."""
    text = F.col("value").cast("string")
    # Only text that opens an array can hold ticks; the rest is not parsed at all.
    parsed = F.when(text.rlike(r"^\s*\["), F.try_parse_json(text))
    elements = messages.select(parsed.alias("payload")).select(
        F.explode(F.expr("try_cast(payload AS ARRAY<VARIANT>)")).alias("element")
    )
    # One cast reads all fields: a missing one is NULL, an explicit null a VARIANT null.
    # Generators, not projections: what they hold is computed once, also for the filters.
    kinds = ", ".join(f"{field}: VARIANT" for field in MINI_TICKER_FIELDS.values())
    read = F.expr(f"try_cast(element AS STRUCT<{kinds}>)").alias("fields")
    objects = elements.select("element", F.explode(F.array(read)).alias("fields")).filter(
        reduce(Column.__or__, (F.col(f"fields.{f}").isNotNull() for f in MINI_TICKER_FIELDS.values()))
        | F.expr("try_cast(element AS MAP<STRING, VARIANT>) IS NOT NULL")
    )
    ticks = objects.select(F.inline(F.array(F.struct(*map(_field, MINI_TICKER_FIELDS)))))
    numbers = [name for name in MINI_TICKER_FIELDS if name != "symbol"]
    return ticks.filter(reduce(Column.__and__, (F.col(name).isNotNull() for name in numbers)))


def _field(name: str) -> Column:
    """The typed field; the default applies only where the field itself is missing."""
    field = f"fields.{MINI_TICKER_FIELDS[name]}"
    kind, default = {"symbol": ("STRING", "''"), "timestamp": ("BIGINT", "0L")}.get(
        name, ("DOUBLE", "0D")
    )
    missing = F.col(field).isNull()
    return F.when(missing, F.expr(default)).otherwise(F.expr(f"try_cast({field} AS {kind})")).alias(name)
