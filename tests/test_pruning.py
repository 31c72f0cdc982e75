"""Plans that prune by themselves, SQL with bound values, and the progress table."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F
from test_streaming import land, message

from ticklake.operators import filters
from ticklake.plans import sql_views
from ticklake.sources.messages import file_messages
from ticklake.streaming import jobs, progress, writers

DAY = 86_400


@pytest.fixture
def by_day(spark, make_ticks, tmp_path):
    """Ten days of ticks, partitioned; returns a function that reads the table."""
    path = str(tmp_path / "ticks")
    rows = make_ticks([(f"S{n % 3}", n * DAY // 4 + 5, float(n)) for n in range(40)])
    rows.withColumn("day", F.col("timestamp_ts").cast("date")).write.partitionBy("day").parquet(path)
    return lambda: spark.read.parquet(path)


def jobs_run(spark, build):
    group = f"probe-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        made = build()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("hours, want", [(None, 4), (1, 1), (24, 5), (60, 11), (24 * 30, 40)])
def test_newest_days(spark, by_day, make_ticks, hours, want):
    table = by_day()
    rows, ran = jobs_run(spark, lambda: filters.newest_days(table, "day", hours))
    assert ran == 0
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "subquery" in plan.split("PartitionFilters")[1].split("\n")[0].lower()
    assert rows.count() == want


def test_appended_rows_are_seen(spark, by_day, make_ticks, tmp_path):
    rows = filters.newest_days(by_day(), "day")
    late = make_ticks([("NEW", 9 * DAY + DAY - 1, 1.0)]).withColumn("day", F.col("timestamp_ts").cast("date"))
    late.write.mode("append").partitionBy("day").parquet(str(tmp_path / "ticks"))
    assert rows.count() == 4  # a frame's list of files is made with the frame
    again = filters.newest_days(by_day(), "day")
    assert again.count() == 5 and again.filter("symbol = 'NEW'").count() == 1


def test_days_of_a_frame_prune_the_scan(spark, by_day):
    wanted = by_day().groupBy("day").agg(F.max("close_price").alias("top")).filter("top > 30")
    table = by_day()
    rows, ran = jobs_run(spark, lambda: filters.of_days(table, wanted, "day"))
    assert ran == 0 and "dynamicpruning" in rows._jdf.queryExecution().toString().lower()
    assert rows.count() == 12


def test_values_are_bound(spark, make_ticks):
    ticks = make_ticks([("A", 1, 1.0), ("B'", 2, 2.0), ("C", 3, 3.0)])
    read = lambda *names: [r.symbol for r in sql_views.recent_ticks(ticks, names, 10).collect()]
    assert read("A") == ["A"] and read("B'") == ["B'"] and read("C", "A") == ["C", "A"]
    assert read("x' OR '1'='1") == [] and read() == [] and read("A') OR (1=1") == []
    with pytest.raises(ValueError, match="no column"):
        sql_views.recent_ticks(ticks, ["A"], 1, tie="symbol; DROP TABLE x")
    with pytest.raises(ValueError, match="no column"):
        sql_views.register(ticks, "symbol) --")
    sql_views.register(ticks)
    found = spark.sql("SELECT * FROM symbol_candles(:s)", args={"s": "A' OR '1'='1"})
    assert found.count() == 0 and spark.sql("SELECT * FROM symbol_candles(:s)", args={"s": "B'"}).count() == 1
    assert [r.symbol for r in spark.sql("SELECT * FROM top_by('volume', :k) ORDER BY place", args={"k": 2}).collect()] == ["A", "B'"]


def test_symbols_reach_the_scan(spark, by_day):
    plan = sql_views.recent_ticks(by_day(), ["S1", "S2"], 5)._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "In(symbol, [S1,S2])" in plan


def test_progress_of_an_interval_trigger(spark, tmp_path):
    """The one-second trigger itself: a batch per landed file, its rows and its lag stored."""
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 0), message("A", 1))
    table = progress.ProgressTable(spark, str(tmp_path / "progress"), trigger_ms=1000, every=2)
    spark.streams.addListener(table)
    try:
        query = jobs.ticks_to_table(
            file_messages(spark, str(inbox), 1),
            writers.parquet_writer(str(tmp_path / "table")),
            str(tmp_path / "checkpoint"),
            jobs.EVERY_SECOND,
        )
        try:
            query.processAllAvailable()
            land(inbox, "2.txt", message("B", 0))
            query.processAllAvailable()
            land(inbox, "3.txt", message("C", 0), message("D", 0), message("E", 0))
            query.processAllAvailable()
        finally:
            query.stop()
        until = time.time() + 60
        while time.time() < until:
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
            table.flush()
            if (tmp_path / "progress").exists() and table.read().filter("rows > 0").count() >= 3:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(table)
    rows = {r.batch_id: r for r in table.read().filter("rows > 0").collect()}
    assert [rows[n].rows for n in range(3)] == [2, 1, 3]
    assert all(r.lag_ms == max(0, r.batch_ms - 1000) and r.trigger_ms == 1000 for r in rows.values())
    assert len({r.run for r in rows.values()}) == 1 and all(r.sources for r in rows.values())


def test_failed_progress_write_waits(spark, tmp_path, caplog):
    (tmp_path / "taken").write_text("a file where the table should be")
    table = progress.ProgressTable(spark, str(tmp_path / "taken"))
    told = {"id": "q", "runId": "r", "batchId": 0, "timestamp": "t", "numInputRows": 1, "durationMs": {"triggerExecution": 1500}}
    table._held = [progress.progress_row(told, 1000)]
    table.flush()
    assert len(table._held) == 1 and "wait for the next write" in caplog.text
    table.path = str(tmp_path / "free")
    table.flush()
    assert table.read().first().lag_ms == 500
