"""Day partials and bitmaps against the ticks they stand for."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticklake.operators import rollup, stats

DAY = 86_400


@pytest.fixture
def some(make_ticks):
    rows = []
    for day in range(6):
        for n in range(40):
            close = None if n % 11 == 0 else float((day * 7 + n) % 9)
            more = {"open_price": None if n % 13 == 0 else float(n % 4), "volume": float(n), "quote_volume": 1e6 * n}
            symbol = None if n == 39 else f"S{(n * (day + 1)) % (5 + day)}"
            rows.append((symbol, day * DAY + n * 60, close, more))
    return make_ticks(rows).withColumn("order", F.unix_micros(F.col("timestamp_ts").cast("timestamp")))


def date_of():
    return F.col("timestamp_ts").cast("date")


def close_to(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-12, abs=1e-12)
    return a == b


def same(got, want):
    got, want = (sorted(rows.select(*want.columns).collect(), key=str) for rows in (got, want))
    assert len(got) == len(want)
    assert all(close_to(a, b) for x, y in zip(got, want, strict=True) for a, b in zip(x, y, strict=True)), (got, want)


def test_partials_give_what_ticks_give(spark, some, tmp_path):
    store = rollup.DayRollup(str(tmp_path / "rollup"))
    store.add(some, date_of(), "order")
    for first, last in ((0, 5), (2, 3), (4, 4)):
        start = dt.date(2024, 1, 1)
        between = F.col("date").between(start + dt.timedelta(days=first), start + dt.timedelta(days=last))
        partials = store.partials(spark).filter(between)
        ticks = some.withColumn("date", date_of()).filter(between).drop("date")
        same(rollup.symbol_stats(partials), stats.symbol_stats(ticks))
        same(rollup.market_kpis(partials), stats.market_kpis(ticks))
        same(rollup.symbol_overview(partials), stats.symbol_overview(ticks, "order"))
        found = rollup.distinct_symbols(store.bitmaps(spark).filter(between)).first()[0]
        assert found == ticks.select(F.countDistinct("symbol")).first()[0]


def test_a_new_day_touches_its_own_partition(spark, some, tmp_path):
    store = rollup.DayRollup(str(tmp_path / "rollup"))
    store.add(some.filter(date_of() < "2024-01-05"), date_of(), "order")

    def files():
        return {p: p.stat().st_mtime_ns for p in Path(store.path).rglob("date=*/*.parquet")}

    before, known = files(), dict(store.dictionary(spark).collect())
    store.add(some.filter(date_of() == "2024-01-05"), date_of(), "order")
    after = files()
    assert before.items() <= after.items()
    assert {p.parent.name for p in after.keys() - before.keys()} == {"date=2024-01-05"}
    ids = dict(store.dictionary(spark).collect())
    assert known.items() <= ids.items() and sorted(ids.values()) == list(range(1, len(ids) + 1))
    store.add(some.filter(date_of() == "2024-01-05"), date_of(), "order")  # again
    assert dict(store.dictionary(spark).collect()) == ids
    same(rollup.symbol_stats(store.partials(spark)), stats.symbol_stats(some.filter(date_of() <= "2024-01-05")))


def test_trailing_days(spark, some, tmp_path):
    store = rollup.DayRollup(str(tmp_path / "rollup"))
    store.add(some.filter(date_of() != "2024-01-03"), date_of(), "order")
    got = dict(rollup.trailing_distinct_symbols(store.bitmaps(spark), 3).collect())
    by_day: dict = {}
    for row in some.select(date_of().alias("d"), "symbol").filter("symbol IS NOT NULL AND d <> DATE'2024-01-03'").collect():
        by_day.setdefault(row.d, set()).add(row.symbol)
    want = {d: len(set().union(*(by_day.get(d - dt.timedelta(days=k), set()) for k in range(3)))) for d in by_day}
    assert got == want


def test_bitmaps_beyond_one_bucket(spark):
    """More symbols than a bitmap's 32,768 bits."""
    ids = spark.range(1, 70_001).selectExpr("id", "DATE'2024-01-01' AS date")
    bits = ids.groupBy("date", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    )
    assert bits.count() == 3 and rollup.distinct_symbols(bits).first()[0] == 70_000


def test_empty(spark, some, tmp_path):
    store = rollup.DayRollup(str(tmp_path / "rollup"))
    store.add(some.limit(0), date_of(), "order")
    assert rollup.distinct_symbols(store.bitmaps(spark)).first()[0] == 0
    assert rollup.market_kpis(store.partials(spark)).first().nb_rows == 0
