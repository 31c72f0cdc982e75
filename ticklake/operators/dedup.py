"""Removal of repeated ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TICK_KEY = ["timestamp_ts", "symbol"]


def dedup_ticks(ticks: DataFrame, order: Column | str | None = None) -> DataFrame:
    """One tick per time and symbol; NULL keys count as equal.

    Any tick survives, or with ``order``, a BIGINT, the one highest in it. Copies collapse in
    the map-side hash aggregate either way: a hot key ships one row per task.
    """
    if order is None:
        return ticks.dropDuplicates(TICK_KEY)
    order = F.col(order) if isinstance(order, str) else order
    place = F.coalesce(order, F.lit(-(2**63)))
    others = [name for name in ticks.columns if name not in TICK_KEY]
    kept = ticks.groupBy(*TICK_KEY).agg(*(F.max_by(name, place).alias(name) for name in others))
    return kept.select(*ticks.columns)


def latest_millisecond(ticks: DataFrame, millis: str = "timestamp") -> Column:
    """An order inside one second: by millisecond, then by a hash of the whole row.

    Ticks that differ never depend on the order in which they arrive, so a replayed batch or
    a retried task keeps the same rows. Ten bits hold the millisecond, 53 the hash; one
    BIGINT keeps the aggregate a hash aggregate.
    """
    part = F.coalesce(F.pmod(F.col(millis), F.lit(1000)) + 1, F.lit(0)).cast("bigint")
    row = F.shiftrightunsigned(F.xxhash64(*ticks.columns), 11)
    return F.shiftleft(part, 53).bitwiseOR(row)


def not_stored(ticks: DataFrame, stored: DataFrame) -> DataFrame:
    """The ticks whose key no stored tick has; NULL keys count as equal."""
    keys = stored.select(*(F.col(name).alias(f"stored_{name}") for name in TICK_KEY))
    same = [ticks[name].eqNullSafe(keys[f"stored_{name}"]) for name in TICK_KEY]
    return ticks.join(keys, same[0] & same[1], "left_anti")
