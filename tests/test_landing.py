"""The registered streams on tables that land in many files: equal results, and work for many tasks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_streaming import land, message

from ticklake import scratch
from ticklake.plans import catalog
from ticklake.streaming import bars, runs, writers
from ticklake.streaming.parse import enrich, parse_ticks

START = dt.datetime(2024, 1, 1)
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events_at(spark, tmp_path, hours, files=1):
    """An events table with a row at each of these hours."""
    rows = [(n, START + dt.timedelta(hours=hour), n % 7, "view", float(n), '{"k": 60}') for n, hour in enumerate(hours)]
    spark.createDataFrame(rows, EVENTS).repartition(files).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    return str(tmp_path / "sf")


def test_stream_bars_lands_more_files(spark, folders, monkeypatch):
    """One input file was one file a batch, written and read by one task."""
    monkeypatch.setattr(catalog, "LANDED_ROWS", 10)
    sf_dir = events_at(spark, folders, [n / 2 for n in range(400)])
    got = catalog.queries()["stream_bars"](spark, sf_dir)
    assert got.agg(F.sum("ticks")).first()[0] == 400
    assert len(landed(folders / "stream-bars", "")) == 5 * 10 - 5  # the fifth batch has five ticks


def test_late_ticks_when_ranges_are_empty(spark, folders):
    """An outlier leaves two ranges empty; with eight input files the batches used to be mixed, and ticks in time counted as late."""
    hours = [0, *(1000 + n / 4 for n in range(600))]
    sf_dir = events_at(spark, folders, hours, files=8)
    got = catalog.queries()["stream_bars"](spark, sf_dir)
    newest = max(hour for n, hour in enumerate(hours) if n % 97)
    late = [hour for n, hour in enumerate(hours) if n % 97 == 0 and hour // 6 * 6 + 6 <= newest - 24]
    assert sorted(row.bar_start for row in got.filter("kind = 'late'").collect()) == [START + dt.timedelta(hours=hour) for hour in late]
    assert got.agg(F.sum("ticks")).first()[0] == len(hours)


def test_a_batch_reads_its_source_once(spark, tmp_path, monkeypatch):
    """Ticks with and without a time were two scans of the source."""
    plans = []
    real = bars.partial_bars
    monkeypatch.setattr(bars, "partial_bars", lambda rows, *rest: plans.append(rows._jdf.queryExecution().toString()) or real(rows, *rest))
    land(tmp_path / "in", "1.txt", message("A", 1), "broken")
    store = bars.BarStore(str(tmp_path / "bars"), "1 minute", 60, "timestamp")
    for batch_id in range(2):
        store(enrich(parse_ticks(spark.read.text(str(tmp_path / "in")))), batch_id)
    assert [text.split("== Physical Plan ==")[1].count("FileScan text") for text in plans] == [1, 1]
    assert store.accounts(spark) == bars.Accounts(2, 0, 2)


@pytest.fixture
def folders(monkeypatch, tmp_path):
    """Where the queries keep their files."""
    monkeypatch.setattr(scratch, "new_folder", lambda spark, name: str(tmp_path / name))
    return tmp_path


def landed(folder, parts):
    return [path for path in folder.glob(f"inbox/{parts}/part-*") if path.stat().st_size]


@pytest.mark.parametrize("name, folder, copies", [("stream_cross_batch_dedup", "stream-dedup-all", 1), ("stream_foreachbatch_dedup", "stream-dedup", 2)])
def test_more_ticks_land_in_more_files(spark, folders, monkeypatch, name, folder, copies):
    monkeypatch.setattr(catalog, "LANDED_ROWS", 10)
    sf_dir = events_at(spark, folders, [n / 2 for n in range(400)])
    got = catalog.queries()[name](spark, sf_dir)
    assert got.count() == 400 * copies and got.distinct().count() == 400
    assert len(landed(folders / folder, "1-*")) == 4 * 10  # was one a batch


def test_second_copies_come_in_batches_of_their_own(spark, folders):
    """Eight input files, and so few seconds that ranges of them stay empty."""
    sf_dir = events_at(spark, folders, [0] * 30 + [1], files=8)
    want = catalog.queries()["stream_cross_batch_dedup"](spark, sf_dir).count()
    assert want == 8  # seven symbols in the first second, one in the other
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    (folders / "stream-dedup").mkdir()
    assert catalog.queries()["stream_foreachbatch_dedup"](spark, sf_dir).count() == 2 * want


def test_a_batch_stores_a_day_in_few_files(spark, tmp_path):
    """Persisted rows that are too many to be coalesced were written by all their tasks, each into each day."""
    store = writers.parquet_writer(str(tmp_path / "table"))
    values = spark.range(2000).selectExpr("""concat('{"symbol":"S', id, '","timestamp":', 1704067200000 + id * 86400, '}') AS value""")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.deduplicating(store, cross_batch=True)(enrich(parse_ticks(values)), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert store.read(spark).count() == 2000
    days = list((tmp_path / "table").glob("date=*"))
    assert [len(list(day.glob("batch_id=0/part-*"))) for day in days] == [1, 1]


def test_days_are_listed_together_and_in_order(spark, tmp_path):
    for n in range(40):
        scratch.make_folder(spark, f"{tmp_path}/{n:02}/run=0-{n}-{n}")
    names = [f"{tmp_path}/{n:02}" for n in range(41)]
    assert scratch.for_each(lambda path: scratch.folder_names(spark, path), names) == [[f"run=0-{n}-{n}"] for n in range(40)] + [[]]
    scratch.make_folder(spark, f"{tmp_path}/07/run=0-1-1")
    scratch.make_folder(spark, f"{tmp_path}/08/run=1-0-7")
    assert runs.due(spark, names, 2) == [f"{tmp_path}/07"]
