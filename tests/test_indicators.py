from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticklake.functions import clock, indicators, labels


def test_zero_and_null_denominators_give_null(make_ticks):
    rows = make_ticks(
        [
            ("A", 0, 1.0, dict(open_price=0.0, high_price=0.0, low_price=0.0)),
            ("B", 0, 1.0, dict(open_price=None)),
            ("C", 0, 0.0, dict(open_price=2.0, high_price=3.0, low_price=1.0)),
        ]
    )
    snapshot = {r.symbol: r for r in indicators.with_snapshot_indicators(rows).collect()}
    dash = {r.symbol: r for r in indicators.with_dashboard_indicators(rows).collect()}
    assert snapshot["A"].return_pct is None and snapshot["A"].volatility_pct is None
    assert snapshot["B"].return_pct is None
    assert snapshot["C"].return_pct == -1.0 and snapshot["C"].volatility_pct == 1.0
    assert dash["A"].pct_change is None and dash["A"].volatility == 0.0
    assert dash["C"].pct_change == -100.0 and dash["C"].volatility is None
    assert dash["C"].spread == 2.0


def test_dashboard_indicators_match_pandas(make_ticks):
    random = np.random.default_rng(3)
    rows = []
    for i in range(300):
        low, open_, close, high = np.sort(random.uniform(0.5, 900, 4).round(int(random.integers(1, 7))))
        rows.append(
            (f"S{i}", i, float(close), dict(open_price=float(open_), high_price=float(high), low_price=float(low)))
        )
    got = indicators.with_dashboard_indicators(make_ticks(rows)).toPandas()
    want = pd.DataFrame(
        {
            "pct_change": ((got.close_price - got.open_price) / got.open_price * 100).round(4),
            "volatility": ((got.high_price - got.low_price) / got.close_price).round(6),
            "spread": (got.high_price - got.low_price).round(8),
        }
    )
    for name in want:
        np.testing.assert_allclose(got[name], want[name], rtol=0, atol=1e-12)


def test_candle_direction(make_ticks):
    rows = make_ticks(
        [
            ("A", 0, 2.0, dict(open_price=2.0)),
            ("B", 0, 1.0, dict(open_price=2.0)),
            ("C", 0, None, dict(open_price=2.0)),
        ]
    )
    got = {r.symbol: r.c for r in rows.select("symbol", indicators.candle_direction().alias("c")).collect()}
    assert got == {"A": "green", "B": "red", "C": "red"}


@pytest.mark.parametrize("millis", [0, 1, 999, 1_704_067_220_999, 1_704_067_221_000])
def test_tick_timestamp_cuts_to_seconds(spark, millis):
    row = spark.range(1).select(clock.tick_timestamp(F.lit(millis)).cast("timestamp_ntz").alias("t")).first()
    assert row.t == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=millis // 1000)


def test_dates(spark):
    row = spark.sql("SELECT TIMESTAMP '2024-03-01 23:59:59' AS run_ts").select(
        clock.snapshot_date().alias("d"), clock.epoch_seconds().alias("s")
    ).first()
    assert row.d == dt.date(2024, 3, 1)
    assert row.s == 1_709_337_599


def expected_return(x):
    if x is None or math.isnan(x):
        return "-", None
    return f"{'+' if x > 0 else ''}{x * 100:.2f}%", "good" if x >= 0 else "bad"


def expected_warning(x):
    if x is None or math.isnan(x):
        return "-", None
    return f"{x * 100:.2f}%", "warn" if x >= 0.02 else "good"


def test_labels_match_python_formatting(spark):
    values = [None, float("nan"), 0.0, 0.00125, 0.00375, 0.01005, -0.00001, 0.02, 0.0199999, -0.5, 12.3456]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    text, label = labels.return_label(F.col("x"))
    warning_text, warning = labels.warning_label(F.col("x"))
    for row in frame.select("x", text.alias("t"), label.alias("l"), warning_text.alias("wt"), warning.alias("w")).collect():
        assert (row.t, row.l) == expected_return(row.x)
        assert (row.wt, row.w) == expected_warning(row.x)


def test_volume_text_matches_python_formatting(spark):
    values = [0.0, 0.5, 1.5, 2.5, 999.5, 1234567.891, 1e12]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for row in frame.select("x", labels.volume_text(F.col("x")).alias("t")).collect():
        assert row.t == f"{row.x:,.0f}".replace(",", " ")
