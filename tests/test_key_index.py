"""The key index of a stored stream: what a batch lists and reads, merges, crashes and replays."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F
from test_streaming import BASE, land, message, run_table

from ticklake import scratch
from ticklake.sources.messages import file_messages
from ticklake.streaming import jobs, key_index, runs, writers
from ticklake.streaming.parse import enrich, parse_ticks

DAY = 86_400
FIRST = dt.date(2024, 1, 1)


def ticks(spark, *messages):
    return enrich(parse_ticks(spark.createDataFrame([(m,) for m in messages], "value string")))


def files(folder):
    return [p for p in Path(folder).rglob("*.parquet") if not p.name.startswith(".")]


def test_files_do_not_follow_batches_or_days(spark, tmp_path, monkeypatch):
    """A thousand earlier batches, and a hundred earlier days: the same few runs are opened."""
    index = key_index.KeyIndex(str(tmp_path / "keys"))
    one = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), 0)], key_index.KEYS).coalesce(1)
    one.write.parquet(str(tmp_path / "one"))
    (source,) = files(tmp_path / "one")
    # what 1,000 batches leave behind: 1,000 = 1 * 512 + 7 * 64 + 5 * 8 + 0
    left, at = 1000, 0
    for level in (3, 2, 1, 0):
        for _ in range(left // 8**level):
            for day in [FIRST, *(FIRST + dt.timedelta(days=d) for d in range(1, 101))]:
                run = tmp_path / "keys" / f"date={day}" / f"run={level}-{at}-{at + 8**level - 1}"
                run.mkdir(parents=True)
                (run / "part.parquet").write_bytes(source.read_bytes())
                (run / "_SUCCESS").touch()
            at += 8**level
        left %= 8**level
    assert at == 1000
    listed = []
    real = scratch.folder_sizes
    monkeypatch.setattr(scratch, "folder_sizes", lambda spark, path: listed.append(path) or real(spark, path))
    keys = index.keys(spark, [FIRST], 1000)
    assert listed == [f"{index.path}/date=2024-01-01"]
    opened = keys.select(F.input_file_name()).distinct().count()
    assert opened == len(keys.inputFiles()) <= (runs.FAN - 1) * 4


def test_runs_stay_few_while_batches_come(spark, tmp_path):
    store = writers.parquet_writer(str(tmp_path / "table"))
    store.index.fan = 3
    write = writers.deduplicating(store, cross_batch=True)
    batches = 14
    for batch_id in range(batches):
        write(ticks(spark, message("A", batch_id), message("A", max(batch_id - 5, 0)), message("B", batch_id * DAY)), batch_id)
        runs = store.index.runs(spark, FIRST)
        assert len(runs) <= 2 * 3 and sum(run.last - run.first + 1 for run in runs) >= batch_id + 1
    stored = store.read(spark).select("symbol", "timestamp_ts").collect()
    assert len(stored) == len(set(stored)) == 2 * batches
    keys = store.index.keys(spark, [row.date for row in store.read(spark).select("date").distinct().collect()], -1)
    assert sorted(map(tuple, keys.select("symbol", "timestamp_ts").distinct().collect())) == sorted(map(tuple, stored))


def test_replay_after_a_merge_adds_nothing(spark, tmp_path):
    store = writers.parquet_writer(str(tmp_path / "table"))
    store.index.fan = 2
    write = writers.deduplicating(store, cross_batch=True)
    for batch_id in (0, 1, 1, 2, 3, 3, 2):
        write(ticks(spark, message("A", batch_id), message("A", batch_id + 1)), batch_id)
    found = store.read(spark).select("batch_id", F.unix_millis("timestamp_ts").alias("ms")).collect()
    assert sorted((r.ms - BASE) // 1000 for r in found) == [0, 1, 2, 3, 4]
    assert sorted(r.batch_id for r in found) == [0, 0, 1, 2, 3]


def test_crash_between_merge_and_delete(spark, tmp_path, monkeypatch):
    store = writers.parquet_writer(str(tmp_path / "table"))
    store.index.fan = 2
    write = writers.deduplicating(store, cross_batch=True)
    write(ticks(spark, message("A", 0)), 0)
    real = scratch.delete_folder

    def fails(spark, path):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(scratch, "delete_folder", fails)
    try:
        write(ticks(spark, message("A", 1)), 1)
    except RuntimeError:
        pass
    monkeypatch.setattr(scratch, "delete_folder", real)
    write(ticks(spark, message("A", 1)), 1)
    write(ticks(spark, message("A", 0), message("A", 1), message("A", 2)), 2)
    assert store.read(spark).count() == 3


def test_table_without_an_index_gets_one(spark, tmp_path):
    store = writers.parquet_writer(str(tmp_path / "table"))
    plain = writers.deduplicating(store)
    plain(ticks(spark, message("A", 0), message("B", DAY), "broken"), 0)
    assert not store.index.is_there(spark)
    write = writers.deduplicating(store, cross_batch=True)
    write(ticks(spark, message("A", 0), message("B", DAY), "broken", message("C", 5)), 1)
    assert sorted(r.symbol or "" for r in store.read(spark).collect()) == ["", "A", "B", "C"]


def test_other_times_of_a_day_are_skipped(spark, tmp_path):
    store = writers.parquet_writer(str(tmp_path / "table"))
    writers.deduplicating(store, cross_batch=True)(ticks(spark, message("A", 0)), 0)
    known = store.index.keys(spark, [FIRST], 1).filter("timestamp_ts >= timestamp_micros(1704067200000000)")
    plan = known._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(timestamp_ts" in plan


def test_source_is_read_once_a_batch(spark, tmp_path):
    """Rows of the source that all jobs of a batch have read together."""
    inbox = tmp_path / "in"
    land(inbox, "1.txt", *[message("A", i) for i in range(40)])
    query = jobs.ticks_to_table(
        file_messages(spark, str(inbox), 1),
        writers.parquet_writer(str(tmp_path / "table")),
        str(tmp_path / "checkpoint"),
        {"availableNow": True},
        cross_batch=True,
    )
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 40


def test_null_times_and_mixed_days(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 0), "broken", message("A", 3 * DAY))
    land(inbox, "2.txt", message("A", 3 * DAY), "broken", message("A", 0), message("A", DAY))
    got = run_table(spark, tmp_path, inbox, cross_batch=True)
    assert got.count() == 4
