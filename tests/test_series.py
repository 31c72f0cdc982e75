"""Ordered series against pandas, uncut and cut into slices."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.operators import ranking, series, slices
from ticklake.plans import dashboard

DAY = 86_400


def walk(seed: int):
    """One symbol with most rows, bursts inside a minute, gaps of days, and NULL closes."""
    random = np.random.default_rng(seed)
    seconds = np.concatenate(
        [
            random.integers(0, 40 * DAY, 60),
            5 * DAY + random.integers(0, 60, 70),
            9 * DAY + random.integers(0, 3600, 60),
        ]
    )
    rows = []
    for second in np.unique(seconds):
        close = None if random.random() < 0.1 else float(random.integers(1, 800)) / 8
        rows.append(("BIG", int(second), close))
    for name in ("A", "B"):
        rows += [(name, int(s), float(s % 97)) for s in np.unique(random.integers(0, 30 * DAY, 20))]
    rows += [("SIX", s, 1.0) for s in range(6)] + [("SEVEN", s, 1.0) for s in range(7)]
    return rows


def pandas_means(frame, newest_first: bool):
    frame = frame.sort_values(["symbol", "timestamp_ts"], ascending=[True, not newest_first])
    for name, length in series.MOVING_AVERAGES.items():
        rolled = frame.groupby("symbol").close_price.rolling(length).mean()
        frame[name] = rolled.droplevel(0)
    return frame.sort_values(["symbol", "timestamp_ts"]).reset_index(drop=True)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("newest_first", [False, True])
@pytest.mark.parametrize("slice_rows", [None, slices.SLICE_ROWS, 60, 30, 3])
def test_moving_averages_match_pandas(make_ticks, seed, newest_first, slice_rows):
    rows = make_ticks(walk(seed)).select("symbol", "timestamp_ts", "close_price")
    got = series.moving_averages(rows, newest_first=newest_first, slice_rows=slice_rows)
    assert got.columns == ["symbol", "timestamp_ts", "close_price", "ma7", "ma25"]
    got = got.toPandas().sort_values(["symbol", "timestamp_ts"]).reset_index(drop=True)
    want = pandas_means(rows.toPandas(), newest_first)
    assert len(got) == len(want)
    for name in ("close_price", "ma7", "ma25"):
        np.testing.assert_allclose(got[name].astype(float), want[name].astype(float), atol=1e-9)


def test_full_frame_needs_as_many_values(make_ticks):
    got = series.moving_averages(make_ticks(walk(1)))
    counts = {r.symbol: r.n for r in got.groupBy("symbol").agg(F.count("ma7").alias("n")).collect()}
    assert counts["SIX"] == 0 and counts["SEVEN"] == 1


def test_null_times_come_last_also_when_cut(make_ticks):
    rows = make_ticks([("A", s * DAY, float(s)) for s in range(20)] + [("A", None, 100.0)])
    for slice_rows in (None, 5):
        got = series.moving_averages(rows, slice_rows=slice_rows).filter("timestamp_ts IS NULL")
        assert got.first().ma7 == pytest.approx((sum(range(14, 20)) + 100) / 7)


def test_ties_follow_the_tie_column(spark):
    rows = [("A", i % 2, i, float(i)) for i in range(40)]
    frame = spark.createDataFrame(rows, "symbol string, t int, id int, close_price double")
    frame = frame.withColumn("timestamp_ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    plain = series.moving_averages(frame, tie="id", slice_rows=None).drop("t").collect()
    cut = series.moving_averages(frame, tie="id", slice_rows=10).drop("t").collect()
    assert sorted(plain) == sorted(cut)
    ids = [i for i in range(40) if i % 2 == 0] + [i for i in range(40) if i % 2]
    last = [r for r in plain if r.id == 1][0]
    assert last.ma7 == pytest.approx(np.mean(ids[14:21]))


def test_only_large_symbols_are_cut(make_ticks):
    rows = make_ticks(walk(1))
    assert slices.large_symbols(rows) is None
    assert slices.large_symbols(rows.filter("false")) is None
    large = slices.large_symbols(rows, 30)
    assert large.limit == 30
    order = [F.asc_nulls_last("timestamp_ts")]
    cut = slices.with_reach(rows, large, 24, ["timestamp_ts", "close_price"], order)
    assert {r.symbol for r in cut.filter("slice IS NOT NULL").select("symbol").collect()} == {"BIG"}
    own = cut.filter("own").groupBy("symbol", "slice").count()
    assert own.filter("symbol = 'BIG'").agg(F.max("count")).first()[0] <= 30
    assert cut.filter("own").count() == rows.count()
    borrowed = cut.filter("NOT own").groupBy("symbol", "slice").count()
    assert borrowed.agg(F.max("count")).first()[0] <= 24


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("start", ["2024-10-26 12:00:00", "2024-03-30 12:00:00", "1969-12-31 20:00:00"])
def test_a_cut_changes_nothing_in_any_zone(spark, kind, start):
    """Also where clocks go back or forward inside the series."""
    ticks = spark.range(300).select(
        F.lit("A").alias("symbol"),
        F.expr(f"TIMESTAMP_NTZ'{start}' + make_dt_interval(0, 0, 0, id * 311.25)").cast("timestamp_ntz").alias("t"),
        F.col("id").cast("double").alias("close_price"),
    )
    results = []
    for zone in ("UTC", "Europe/Paris"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            ntz = F.col("t") if kind == "timestamp_ntz" else F.to_utc_timestamp(F.col("t").cast("timestamp"), "UTC")
            timed = ticks.withColumn("timestamp_ts", ntz.cast(kind)).drop("t")
            order = "timestamp_ts", "close_price"
            for slice_rows in (None, 40, 3):
                got = series.moving_averages(timed, slice_rows=slice_rows, tie="close_price")
                results.append((zone, [tuple(r) for r in got.orderBy(*order).select("close_price", "ma7", "ma25").collect()]))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    for zone in ("UTC", "Europe/Paris"):
        same = [rows for where, rows in results if where == zone]
        assert same[0] == same[1] == same[2] and len(same[0]) == 300


def test_the_count_can_be_shared(make_ticks):
    rows = make_ticks(walk(1))
    large = slices.large_symbols(rows, 30)
    shared = series.moving_averages(rows, slice_rows=None, large=large).collect()
    assert sorted(map(str, shared)) == sorted(map(str, series.moving_averages(rows, slice_rows=None).collect()))


def test_one_second_and_missing_times_are_cut_too(spark):
    """All rows of a symbol in one second, or without a time: the order is the tie's, and no slice is large."""
    for moment in ("TIMESTAMP_NTZ'2024-01-01 00:00:00'", "cast(NULL AS timestamp_ntz)"):
        rows = spark.range(400).selectExpr("'A' AS symbol", f"{moment} AS timestamp_ts", "id", "cast(id % 17 AS double) AS close_price")
        plain = series.moving_averages(rows, tie="id", slice_rows=None).collect()
        assert sorted(series.moving_averages(rows, tie="id", slice_rows=20).collect(), key=str) == sorted(plain, key=str)
        cut = slices.with_reach(rows, slices.large_symbols(rows, 20), 24, ["id"], [F.col("timestamp_ts"), F.col("id")])
        sizes = cut.filter("own").groupBy("slice").count()
        assert sizes.count() >= 20 and sizes.agg(F.max("count")).first()[0] <= 20


def test_equal_rows_are_cut_apart(spark):
    rows = spark.range(300).selectExpr("'A' AS symbol", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS timestamp_ts", "2.0D AS close_price")
    got = series.moving_averages(rows, slice_rows=10)
    assert got.filter("ma25 = 2").count() == 276 and got.filter("ma7 IS NULL").count() == 6


def test_the_sorted_copy_is_all_that_is_read_twice(spark, make_ticks, tmp_path):
    make_ticks(walk(1)).write.parquet(str(tmp_path / "ticks"))
    rows = spark.read.parquet(str(tmp_path / "ticks")).select("symbol", "timestamp_ts", "close_price")
    plan = series.moving_averages(rows, slice_rows=30)._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("FileScan parquet")
    assert scans == 1, plan  # the ordinary symbols


def test_lenders():
    pieces = [("A", 0, 0, 3), ("A", 1, 100, 2), ("A", 2, 200, 50), ("B", 2, 250, 4), ("B", 3, 300, 9), ("C", 3, 309, 1)]
    assert sorted(slices.lenders(pieces, 4)) == [("A", 0, 0, 1), ("A", 0, 1, 2), ("A", 1, 100, 2), ("B", 2, 250, 3)]


def test_candles(make_ticks):
    got = series.candle_series(make_ticks(walk(2)))
    assert set(got.columns) >= {"open_price", "volume", "ma7", "ma25", "color"}
    assert got.filter("color NOT IN ('green', 'red')").count() == 0


def test_base100_matches_pandas(make_ticks):
    random = np.random.default_rng(8)
    rows = [
        (f"S{i % 12}", i, float(random.integers(1, 500)), dict(open_price=float(random.integers(1, 500))))
        for i in range(240)
    ]
    ticks = make_ticks(rows)
    frame = ticks.toPandas().sort_values("timestamp_ts")
    best = [r.symbol for r in ranking.gainers(dashboard.latest(ticks)).collect()]
    got = series.gainers_base100(ticks).toPandas()
    assert set(got.symbol) == set(best) and len(best) == 5
    for symbol in best:
        own = frame[frame.symbol == symbol].close_price
        index = got[got.symbol == symbol].sort_values("timestamp_ts").price_index
        np.testing.assert_allclose(index, own / own.iloc[0] * 100)


def test_base100_of_a_zero_start_is_null(make_ticks):
    rows = make_ticks([("A", 0, 0.0, dict(open_price=1.0)), ("A", 1, 5.0)])
    assert [r.price_index for r in series.gainers_base100(rows).collect()] == [None, None]
