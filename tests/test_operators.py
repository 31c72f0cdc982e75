"""Filters, aggregates, rankings and alerts on hand-made rows and against pandas."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import START
from pyspark.sql import functions as F

from ticklake.operators import alerts, dedup, filters, ranking, series, stats
from ticklake.plans import dashboard, market_report


def random_ticks(seed: int, symbols: int = 6, rows: int = 200):
    random = np.random.default_rng(seed)
    made = []
    for second in range(rows):
        close = None if random.random() < 0.15 else float(random.integers(1, 1000)) / 8
        base = float(random.integers(1, 1000)) / 8
        volume = None if random.random() < 0.3 else float(random.integers(1, 50))
        made.append(
            (
                f"S{random.integers(symbols)}",
                second,
                close,
                dict(open_price=base, high_price=base + 2, low_price=base - 1, volume=volume),
            )
        )
    return made


def pandas_dashboard(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("timestamp_ts").copy()
    frame["pct_change"] = ((frame.close_price - frame.open_price) / frame.open_price * 100).round(4)
    frame["volatility"] = ((frame.high_price - frame.low_price) / frame.close_price).round(6)
    frame["spread"] = (frame.high_price - frame.low_price).round(8)
    return frame


def test_empty_symbol_list_selects_nothing(make_ticks):
    rows = make_ticks([("A", 0, 1.0), ("B", 1, 1.0)])
    assert filters.select_symbols(rows, []).count() == 0
    assert filters.select_symbols(rows, ["B"]).first().symbol == "B"
    wanted = rows.filter("symbol = 'A'").select("symbol")
    assert [r.symbol for r in filters.select_symbols(rows, wanted).collect()] == ["A"]


def test_recent_ticks_counts_over_all_symbols(make_ticks):
    rows = make_ticks([("A", 0, 1.0), ("B", 5, 2.0), ("A", 9, 3.0), ("C", 10, 4.0), (None, 11, 5.0)])
    got = filters.recent_ticks(rows, ["A", "B"], limit=2).collect()
    assert [r.close_price for r in got] == [3.0, 2.0]
    assert filters.recent_ticks(rows).count() == 4


def test_period_anchor_is_the_newest_selected_tick(make_ticks):
    hour = 3600
    rows = make_ticks([("A", 0, 1.0), ("A", hour, 2.0), ("B", 2 * hour, 3.0), ("B", hour - 1, 4.0)])
    got = filters.period_window(rows, "1H").collect()
    assert sorted(r.close_price for r in got) == [2.0, 3.0]
    assert filters.period_window(rows, "Tout").count() == 4
    only_a = filters.period_window(filters.select_symbols(rows, ["A"]), "1H")
    assert only_a.count() == 2


def test_period_comes_after_the_limit(make_ticks):
    rows = make_ticks([("A", s, float(s)) for s in range(10)])
    got = dashboard.working_set(rows, ["A"], "24H", limit=3)
    assert sorted(r.close_price for r in got.collect()) == [7.0, 8.0, 9.0]


@pytest.fixture
def paris(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_newest_in_the_repeated_autumn_hour(spark, paris):
    """Half past two happens twice; the second one is newer."""
    runs = spark.sql(
        "SELECT 'A' AS symbol, timestamp_micros(m * 1000000L) AS run_ts, timestamp_micros(m * 1000000L) AS timestamp_ts"
        " FROM VALUES (1729989000L), (1729992600L), (1729985400L) AS t(m)"
    )
    assert runs.selectExpr("CAST(run_ts AS string) AS local").distinct().count() == 2
    newest = filters.latest_snapshot(runs).selectExpr("unix_seconds(run_ts)").collect()
    assert [r[0] for r in newest] == [1729992600]
    hour = filters.period_window(runs, "1H").selectExpr("unix_seconds(run_ts)").collect()
    assert sorted(r[0] for r in hour) == [1729989000, 1729992600]


@pytest.mark.parametrize("share", [0.75, 0.5, 0.0, 1.0, 0.333])
@pytest.mark.parametrize(
    "values",
    [[], [None], [5.0], [None, 3.0], [2.0] * 9, [1.0, 2.0], [float(i * i % 37) for i in range(300)], [1e300, -1e300, 0.0]],
)
def test_quantile_matches_numpy(spark, values, share):
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    got = spark.range(1).select(alerts.quantile(rows, "x", share)).first()[0]
    known = [v for v in values if v is not None]
    assert got == (pytest.approx(float(np.quantile(known, share)), rel=1e-12) if known else None)


def test_quantile_keeps_no_buffer_of_all_values(spark):
    rows = spark.range(1000).selectExpr("CAST(id AS double) AS x")
    plan = spark.range(1).select(alerts.quantile(rows, "x", 0.75))._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_latest_snapshot(make_ticks):
    rows = make_ticks([("A", 0, 1.0), ("A", 86400, 2.0), ("B", 86401, 3.0)])
    rows = rows.withColumn("run_ts", F.date_trunc("day", "timestamp_ts").cast("timestamp_ntz"))
    for recorded in (None, "timestamp_ts"):
        got = filters.latest_snapshot(rows, recorded=recorded)
        assert sorted(r.close_price for r in got.collect()) == [2.0, 3.0]


def test_kpis_of_nothing_are_zero(make_ticks):
    row = stats.market_kpis(make_ticks([("A", 0, 1.0)]).filter("false")).first()
    assert row.asDict() == dict(
        nb_symbols=0,
        nb_rows=0,
        total_quote_volume_million=0.0,
        avg_market_return_pct=0.0,
        avg_market_volatility_pct=0.0,
    )


def test_market_average_is_over_rows_not_symbols(make_ticks):
    rows = make_ticks(
        [
            ("A", 0, 2.0, dict(open_price=1.0)),
            ("A", 1, 2.0, dict(open_price=1.0)),
            ("B", 0, 1.0, dict(open_price=1.0)),
            ("B", 1, 1.0, dict(open_price=0.0)),
        ]
    )
    row = stats.market_kpis(rows).first()
    assert (row.nb_symbols, row.nb_rows) == (2, 4)
    assert row.avg_market_return_pct == pytest.approx(2 / 3)
    by_symbol = {r.symbol: r.avg_return_pct for r in stats.symbol_stats(rows).collect()}
    assert by_symbol == {"A": 1.0, "B": 0.0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_latest_per_symbol_matches_pandas(make_ticks, seed):
    rows = make_ticks(random_ticks(seed))
    want = pandas_dashboard(rows.toPandas()).groupby("symbol").last()
    got = dashboard.latest(rows).toPandas().set_index("symbol").sort_index()
    for name in ("close_price", "volume", "pct_change", "volatility", "spread"):
        np.testing.assert_allclose(got[name], want[name], atol=1e-9)


@pytest.mark.parametrize("seed", [1, 2])
def test_overview_matches_pandas(make_ticks, seed):
    rows = make_ticks(random_ticks(seed))
    got = stats.symbol_overview(rows).toPandas().set_index("symbol")
    for symbol, frame in pandas_dashboard(rows.toPandas()).groupby("symbol"):
        row = got.loc[symbol]
        first, last = frame.close_price.iloc[0], frame.close_price.iloc[-1]
        want = {
            "latest_close": last,
            "first_close": first,
            "change_abs": last - first,
            "change_pct": (last - first) / first * 100,
            "avg_close": frame.close_price.mean(),
            "max_high": frame.high_price.max(),
            "min_low": frame.low_price.min(),
            "avg_volatility": frame.volatility.mean(),
            "sum_reported_volume": frame.volume.sum(),
        }
        for name, value in want.items():
            np.testing.assert_allclose(row[name], value, atol=1e-9, err_msg=name)


def test_last_tick_keeps_nulls(make_ticks):
    rows = make_ticks([("A", 0, 1.0), ("A", 1, None)])
    whole = stats.last_tick_per_symbol(rows, ["close_price", "timestamp_ts"]).first()
    assert whole.close_price is None and whole.timestamp_ts == START + dt.timedelta(seconds=1)
    assert stats.latest_per_symbol(rows, ["close_price"]).first().close_price == 1.0


def test_symbol_summary_rows(make_ticks):
    rows = make_ticks([("A", 0, 1.0), ("A", 1, 3.0, dict(open_price=2.0, high_price=4.0, low_price=1.0))])
    got = {r.metric: r.value for r in dashboard.symbol_summary(rows).collect()}
    assert got == {
        "Prix Ouverture": 2.0,
        "Prix Clôture": 3.0,
        "Prix Haut": 4.0,
        "Prix Bas": 1.0,
        "Spread": 3.0,
        "Variation (%)": 50.0,
        "Volatilité": 1.0,
        "Volume": 1.0,
    }


STATS = "symbol string, avg_return_pct double, avg_volatility_pct double, total_quote_volume_million double"


def test_rankings_order_ties_and_nulls(spark):
    rows = [("F", 0.5), ("E", 0.1), ("D", 0.1), ("C", 0.3), ("B", None), ("A", 0.2), ("G", 0.4)]
    frame = spark.createDataFrame([(s, v, v, v) for s, v in rows], STATS)
    assert [r.symbol for r in ranking.top_winners(frame).collect()] == ["F", "G", "C", "A", "D"]
    assert [r.symbol for r in ranking.top_losers(frame).collect()] == ["D", "E", "A", "C", "G"]
    few = frame.filter("symbol IN ('A', 'B')")
    assert [r.symbol for r in ranking.top_losers(few).collect()] == ["A", "B"]
    assert [r.symbol for r in ranking.top_volume(few).collect()] == ["A", "B"]


def test_default_pairs(spark):
    def pairs(*names):
        frame = spark.createDataFrame([(n,) for n in names], "symbol string")
        return [r.symbol for r in ranking.default_pairs(frame).collect()]

    assert pairs("ZED", "ETHUSDT", "AAA", "BTCUSDT", "BTCUSDT") == ["BTCUSDT", "ETHUSDT"]
    assert pairs("ZED", "ETHUSDT", "AAA", "CCC") == ["AAA", "CCC"]
    assert pairs("ONLY") == ["ONLY"]


def test_report_with_missing_values(make_ticks):
    rows = make_ticks([("A", 0, 1.0, dict(open_price=None)), ("B", 0, 1.0, dict(open_price=2.0, quote_volume=3e9))])
    totals = stats.symbol_totals(rows)
    listed = {(r.section, r["rank"]): r for r in market_report.rankings(totals).collect()}
    assert listed["winners", 1].symbol == "B" and listed["losers", 1].symbol == "B"
    assert listed["losers", 2].return_text == "-" and listed["losers", 2].return_class is None
    assert listed["volume", 1].volume_text == "3 000"
    row = market_report.summary(totals).first()
    assert (row.best_symbol, row.worst_symbol, row.most_liquid_symbol) == ("B", "B", "B")
    assert row.market_return_text == "-50.00%" and row.market_return_class == "bad"
    assert "3 000 M" in row.sentence


def test_report_of_only_missing_returns(make_ticks):
    totals = stats.symbol_totals(make_ticks([("B", 0, 1.0, dict(open_price=0.0)), ("A", 0, 1.0, dict(open_price=None))]))
    row = market_report.summary(totals).first()
    assert row.best_symbol == "A" and row.best_value is None
    assert "Best: A (-)" in row.sentence


@pytest.mark.parametrize("seed", [4, 5])
def test_alerts_match_pandas(make_ticks, seed):
    rows = make_ticks(random_ticks(seed, symbols=40, rows=400))
    latest = pandas_dashboard(rows.toPandas()).groupby("symbol").last().reset_index()
    moves = set(latest[latest["pct_change"].abs() > 5].symbol)
    volatile = set(latest[latest.volatility > latest.volatility.quantile(0.75)].symbol)
    newest = dashboard.latest(rows)
    assert {r.symbol for r in alerts.large_moves(newest).collect()} == moves
    assert {r.symbol for r in alerts.high_volatility(newest).collect()} == volatile
    counts = {r.alert: r.nb_symbols for r in alerts.alert_counts(newest).collect()}
    assert counts == {"large_move": len(moves), "high_volatility": len(volatile)}


def test_alert_bounds_are_strict(make_ticks):
    rows = make_ticks([("A", 0, 105.0, dict(open_price=100.0, high_price=105.0, low_price=100.0))])
    newest = dashboard.latest(rows)
    assert alerts.large_moves(newest).count() == 0
    assert alerts.high_volatility(newest).count() == 0
    assert alerts.alert_counts(newest).count() == 0


def test_dedup_treats_nulls_as_equal(make_ticks):
    rows = make_ticks([("A", 0, 1.0), ("A", 0, 2.0), ("B", 0, 1.0), (None, None, None), (None, None, None)])
    assert dedup.dedup_ticks(rows).count() == 3


def test_dedup_by_order_keeps_whole_rows(spark):
    rows = [("A", 1, 5, 1.0, None), ("A", 1, 9, None, 2.0), ("A", 1, 7, 3.0, 3.0), ("B", None, None, 4.0, 4.0)]
    frame = spark.createDataFrame(rows, "symbol string, t bigint, ms bigint, x double, y double")
    frame = frame.select("symbol", F.timestamp_seconds("t").alias("timestamp_ts"), "ms", "x", "y")
    got = dedup.dedup_ticks(frame, order="ms")
    assert got.columns == frame.columns
    assert {(r.symbol, r.ms, r.x, r.y) for r in got.collect()} == {("A", 9, None, 2.0), ("B", None, 4.0, 4.0)}


def test_history_table_labels(make_ticks):
    rows = make_ticks([("A", s, float(s + 1)) for s in range(3)] + [("B", 0, 1.0)])
    table = series.history_table(series.symbol_history(rows), "A")
    assert table.columns == list(series.HISTORY_LABELS.values())
    assert [r.Close for r in table.collect()] == [3.0, 2.0, 1.0]
