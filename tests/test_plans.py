"""The physical plans: what is pushed down, and which operators must not appear."""

from __future__ import annotations

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ticklake.operators import filters, ranking, slices, stats
from ticklake.plans import catalog, dashboard, market_report
from ticklake.sources import events


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame) -> str:
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return plan(frame)


@pytest.mark.parametrize("key", list(catalog.queries()))
def test_no_python_and_no_cross_join(spark, key):
    text = plan(catalog.queries()[key](spark, SMALL))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "MapInPandas"):
        assert word not in text


AGGREGATES = [
    "market_kpis",
    "symbol_stats",
    "symbol_overview",
    "latest_per_symbol",
    "symbol_summary",
    "alert_counts",
    "dedup_ticks",
    "gainers_base100",
]


@pytest.mark.parametrize("key", AGGREGATES)
def test_tick_aggregates_hash_with_a_map_side_partial(spark, key):
    text = plan(catalog.queries()[key](spark, SMALL))
    assert "SortAggregate" not in text
    assert "partial_" in text


@pytest.mark.parametrize("key", ["top_winners", "recent_ticks", "dash_gainers", "default_pairs"])
def test_top_k_never_sorts_everything(spark, key):
    text = plan(catalog.queries()[key](spark, SMALL))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_symbol_list_is_pushed_to_the_scan(spark, tmp_path, ticks):
    ticks.write.parquet(str(tmp_path / "ticks"))
    stored = spark.read.parquet(str(tmp_path / "ticks"))
    text = plan(dashboard.working_set(stored, ["S1", "S2"], "Tout"))
    assert "In(symbol, [S1,S2])" in text
    assert "quote_volume" not in text.split("ReadSchema")[1]


def test_stats_read_only_their_columns(spark, tmp_path, ticks):
    ticks.write.parquet(str(tmp_path / "ticks"))
    stored = spark.read.parquet(str(tmp_path / "ticks"))
    text = plan(stats.symbol_overview(stored))
    read = text.split("ReadSchema")[1]
    assert "quote_volume" not in read and "run_ts" not in read


def stored_instants(spark, tmp_path, ticks):
    """Ticks with zoned times: Parquet filters on TIMESTAMP_NTZ are not pushed by Spark 4.1."""
    times = {name: F.col(name).cast("timestamp") for name in ("timestamp_ts", "run_ts")}
    dated = ticks.withColumns(times).withColumn("run_date", F.to_date("run_ts"))
    dated.write.partitionBy("run_date").parquet(str(tmp_path / "ticks"))
    return spark.read.parquet(str(tmp_path / "ticks"))


def test_newest_snapshot_prunes_partitions_and_row_groups(spark, tmp_path, ticks):
    stored = stored_instants(spark, tmp_path, ticks)
    text = plan(filters.latest_snapshot(stored, recorded="timestamp_ts", day="run_date"))
    assert "run_date#" in text.split("PartitionFilters")[1].split("]")[0]
    assert "EqualTo(run_ts,2024-01-30" in text
    assert "GreaterThanOrEqual(timestamp_ts,2024-01-30" in text


def scanned_rows(frame) -> int:
    frame.collect()

    def walk(node) -> int:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.startswith("Scan"):
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        return sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(frame._jdf.queryExecution().executedPlan())


def test_period_skips_older_files(spark, tmp_path, ticks):
    stored = stored_instants(spark, tmp_path, ticks)
    recent = filters.period_window(stored, "1H")
    assert "GreaterThanOrEqual(timestamp_ts," in plan(recent)
    assert scanned_rows(recent) < ticks.count() / 10


def test_report_scans_the_snapshot_once(spark):
    totals = stats.symbol_totals(events.ticks(spark, SMALL))
    final = executed(market_report.rankings(totals)).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    summary = plan(market_report.summary(totals))
    assert summary.count("FileScan") == 1


def test_ordinary_symbols_take_one_shuffle(spark):
    text = plan(catalog.queries()["moving_averages"](spark, SMALL))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_cut_windows_broadcast_only_bounded_lists(spark, ticks):
    order = [F.asc_nulls_last("timestamp_ts")]
    cut = slices.with_reach(ticks, slices.large_symbols(ticks, 20), 24, ["timestamp_ts", "close_price"], order)
    text = plan(cut)
    assert "SortMergeJoin" not in text
    assert "Window" not in text and "BroadcastHashJoin" in text


def test_base100_broadcasts_k_rows(spark):
    text = plan(catalog.queries()["gainers_base100"](spark, SMALL))
    assert "BroadcastHashJoin" in text and "TakeOrderedAndProject(limit=5" in text
    assert "Window" not in text
    assert ranking.TOP == 5


@pytest.mark.parametrize("key", ["bucketed_symbol_overview", "bucketed_candle_series"])
def test_buckets_by_symbol_need_no_exchange(spark, key):
    text = plan(catalog.queries()[key](spark, SMALL))
    assert "Exchange" not in text and ("Bucketed: true" in text or "SelectedBucketsCount" in text)
