"""Message text to tick columns; works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions import indicators
from ticklake.functions.clock import tick_timestamp
from ticklake.schemas import TICK_MESSAGE

#: Columns of a classified message: whether it is a tick, and its text where it is none.
GOOD = "good"
REJECTED = "rejected"

_BROKEN = "broken"
_EMPTY = "empty"
_PARSED = T.StructType(TICK_MESSAGE.fields + [T.StructField(_BROKEN, T.StringType())])


def _is_good() -> Column:
    return F.col(_BROKEN).isNull() & ~F.col(_EMPTY)


def _parsed(messages: DataFrame) -> DataFrame:
    text = F.col("value").cast("string")
    data = F.from_json(text, _PARSED, {"columnNameOfCorruptRecord": _BROKEN})
    parsed = messages.select(data.alias("data"), F.col("value").isNull().alias(_EMPTY))
    return parsed.select("data.*", _EMPTY)


def parse_ticks(messages: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """One row per message.

    A message that is no tick object, or NULL, stays as a row of NULLs, a bad field as a
    NULL; ``drop_malformed`` leaves all three kinds to ``rejected_messages``.
    """
    parsed = _parsed(messages)
    if drop_malformed:
        parsed = parsed.filter(_is_good())
    return parsed.drop(_BROKEN, _EMPTY)


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The text of the messages ``drop_malformed`` leaves out; NULL for a NULL message."""
    parsed = _parsed(messages).filter(~_is_good())
    return parsed.select(F.col(_BROKEN).alias("value"))


def enrich(ticks: DataFrame) -> DataFrame:
    """Adds the tick time, spread and mid price."""
    timed = ticks.withColumn("timestamp_ts", tick_timestamp())
    return indicators.with_spread_and_mid(timed)


def classified(messages: DataFrame) -> DataFrame:
    """Enriched ticks with ``good`` and ``rejected``: one parse for what is accepted and what is not.

    ``good`` is false for the messages that ``drop_malformed`` leaves out, and ``rejected`` then is
    their text, NULL for a NULL message.
    """
    parsed = enrich(_parsed(messages)).withColumn(GOOD, _is_good())
    return parsed.withColumnRenamed(_BROKEN, REJECTED).drop(_EMPTY)
