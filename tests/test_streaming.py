"""Streaming jobs on the file source, run with ``availableNow``."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from ticklake.operators.dedup import dedup_ticks, latest_millisecond
from ticklake.sources.messages import file_messages
from ticklake.streaming import jobs, writers
from ticklake.streaming.parse import enrich, parse_ticks, rejected_messages

NOW = {"availableNow": True}
BASE = 1704067200000


def message(symbol: str, second: int, close: float = 1.0) -> str:
    tick = dict(symbol=symbol, close_price=close, open_price=1.0, high_price=close + 1)
    return json.dumps(tick | dict(low_price=0.5, volume=1.0, quote_volume=2.0, timestamp=BASE + second * 1000))


def land(folder, name: str, *values: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(value + "\n" for value in values))


def two_files(tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 0), message("A", 0, 9.0), message("B", 0), "not json", "neither")
    land(inbox, "2.txt", message("A", 0), message("A", 1))
    return inbox


def test_parquet_job_equals_batch(spark, tmp_path):
    inbox = two_files(tmp_path)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        jobs.ticks_to_parquet(file_messages(spark, str(inbox), 1), out, checkpoint, NOW).awaitTermination()
    want = enrich(parse_ticks(spark.read.text(str(inbox))))
    got = spark.read.parquet(out)
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert got.count() == want.count() == 7
    land(inbox, "3.txt", message("C", 5))
    jobs.ticks_to_parquet(file_messages(spark, str(inbox), 1), out, checkpoint, NOW).awaitTermination()
    assert spark.read.parquet(out).count() == 8
    assert {str(r.date) for r in spark.read.parquet(out).select("date").distinct().collect()} == {
        "2024-01-01",
        "None",
    }


def run_table(spark, tmp_path, inbox, write=None, **options):
    query = jobs.ticks_to_table(
        file_messages(spark, str(inbox), 1),
        write or writers.parquet_writer(str(tmp_path / "table")),
        str(tmp_path / "checkpoint"),
        NOW,
        **options,
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "table"))


def keys(rows):
    return sorted((r.symbol or "", str(r.timestamp_ts)[-8:], r.batch_id) for r in rows.collect())


def test_repeats_collapse_inside_a_batch_only(spark, tmp_path):
    got = run_table(spark, tmp_path, two_files(tmp_path))
    per_batch = {}
    for symbol, time, batch in keys(got):
        per_batch.setdefault(batch, []).append((symbol, time))
    assert sorted(map(tuple, per_batch.values())) == sorted(
        [
            (("", "None"), ("A", "00:00:00"), ("B", "00:00:00")),
            (("A", "00:00:00"), ("A", "00:00:01")),
        ]
    )


def test_cross_batch_dedup(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", *[message("A", 0)] * 50, message("B", 0))
    land(inbox, "2.txt", message("A", 0), message("A", 1))
    got = run_table(spark, tmp_path, inbox, cross_batch=True)
    assert [(s, t) for s, t, _ in keys(got)] == [("A", "00:00:00"), ("A", "00:00:01"), ("B", "00:00:00")]


def test_late_ticks_are_kept(spark, tmp_path):
    """However late: two hours and two days behind, unique or known; keys may be NULL."""
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 200_000), message("A", 20), "broken")
    land(inbox, "2.txt", message("A", 300_000), "broken")
    land(inbox, "3.txt", message("LATE", 193_000), message("OLD", 1), message("A", 20), message("A", 200_000))
    got = run_table(spark, tmp_path, inbox, cross_batch=True)
    assert sorted((r.symbol or "", r.batch_id) for r in got.collect()) == [
        ("", 0),
        ("A", 0),
        ("A", 0),
        ("A", 1),
        ("LATE", 2),
        ("OLD", 2),
    ]


def test_differing_ticks_of_a_second_have_one_winner(spark, tmp_path):
    """The latest millisecond; of equal milliseconds the same row in any order of arrival."""
    rows = [message("A", 5, close) for close in (1.0, 2.0, 3.0)]
    late = json.loads(rows[0]) | {"close_price": 9.0}
    late["timestamp"] += 700
    for order in (rows, rows[::-1]):
        inbox = tmp_path / f"in-{order is rows}"
        land(inbox, "1.txt", *order, json.dumps(late))
        land(inbox, "2.txt", *order)
        folder = tmp_path / f"out-{order is rows}"
        folder.mkdir()
        got = run_table(spark, folder, inbox, cross_batch=True).collect()
        assert [r.close_price for r in got] == [9.0]
    winners = set()
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        ticks = parse_ticks(spark.createDataFrame([(m,) for m in order], "value string").repartition(3))
        ticks = enrich(ticks)
        winners.add(dedup_ticks(ticks, latest_millisecond(ticks)).first().close_price)
    assert len(winners) == 1


def test_cross_batch_replay_adds_nothing(spark, tmp_path):
    store = writers.parquet_writer(str(tmp_path / "table"))
    ticks = enrich(parse_ticks(spark.createDataFrame([(message("A", 1),), (message("B", 2),)], "value string")))
    write = writers.deduplicating(store, cross_batch=True)
    for batch_id in (0, 1, 0, 1):
        write(ticks, batch_id)
    assert sorted((r.symbol, r.batch_id) for r in store.read(spark).collect()) == [("A", 0), ("B", 0)]


def test_cross_batch_needs_a_table_to_look_into():
    with pytest.raises(ValueError, match="parquet_writer"):
        writers.deduplicating(lambda rows, batch_id: None, cross_batch=True)


def test_stored_days_compact(spark, tmp_path):
    inbox = tmp_path / "in"
    day = 86_400
    land(inbox, "1.txt", *[message("A", d * day) for d in range(4)])
    land(inbox, "2.txt", *[message("B", d * day) for d in range(4)])
    run_table(spark, tmp_path, inbox)
    store = writers.parquet_writer(str(tmp_path / "table"))
    first = store.read(spark).selectExpr("min(date)").first()[0]
    before = str(first + dt.timedelta(days=3))
    for _ in range(2):  # again changes nothing
        writers.compact_days(store.read(spark), str(tmp_path / "closed"), before)
    closed = spark.read.parquet(str(tmp_path / "closed"))
    assert closed.count() == 6 and closed.select("date").distinct().count() == 3


def test_compaction_in_place(spark, tmp_path, monkeypatch):
    """Before, between and after the steps of a swap, and with late and replayed batches, each tick is seen once."""
    from ticklake import scratch

    store = writers.parquet_writer(str(tmp_path / "table"))
    write = writers.deduplicating(store)

    def ticks(*messages):
        return enrich(parse_ticks(spark.createDataFrame([(m,) for m in messages], "value string")))

    def seen():
        return sorted((r.symbol or "", str(r.date)) for r in store.read(spark).collect())

    assert seen() == []
    day = 86_400
    for batch in range(4):
        write(ticks(message(f"A{batch}", batch), message("B", day + batch), "broken"), batch)
    want = seen()
    assert len(want) == 12
    deleted, real = [], scratch.delete_folder

    def watched(session, path):
        assert seen() == want
        deleted.append(path)
        if len(deleted) < 3:
            real(session, path)
        elif len(deleted) == 3:
            raise RuntimeError("lost the driver")

    monkeypatch.setattr(scratch, "delete_folder", watched)
    with pytest.raises(RuntimeError):
        store.compact(spark, "2024-01-02")
    monkeypatch.setattr(scratch, "delete_folder", real)
    opened = lambda day: sum(f"date={day}" in name for name in store.read(spark).inputFiles())
    assert seen() == want and opened("2024-01-01") == 1 and opened("2024-01-02") == 4
    write(ticks(message("A3", 3), message("B", day + 3), "broken"), 3)  # replayed
    assert seen() == want
    write(ticks(message("LATE", 5)), 4)
    assert seen() == sorted([*want, ("LATE", "2024-01-01")])
    store.compact(spark, "2024-01-03")
    assert seen() == sorted([*want, ("LATE", "2024-01-01")])
    folders = [p.name for p in (tmp_path / "table/date=2024-01-01").iterdir() if p.is_dir() and "-5" in p.name]
    assert folders == ["batch_id=-5"] and opened("2024-01-01") == opened("2024-01-02") == 1
    half = tmp_path / "table/date=2024-01-01/batch_id=-99"  # a compaction that never ended
    half.mkdir()
    (half / "part-0.parquet").write_bytes(next((tmp_path / "table/date=2024-01-02/batch_id=-4").glob("*.parquet")).read_bytes())
    assert seen() == sorted([*want, ("LATE", "2024-01-01")])


def test_rejects_go_to_their_own_table(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 0), "broken", "{}", "7")
    messages = file_messages(spark, str(inbox), 1)
    out, checkpoint = str(tmp_path / "rejects"), str(tmp_path / "rejects-checkpoint")
    jobs.rejects_to_parquet(messages, out, checkpoint, NOW).awaitTermination()
    run_table(spark, tmp_path, inbox, drop_malformed=True)
    rejected = spark.read.parquet(out)
    assert sorted(r.value for r in rejected.collect()) == ["7", "broken"]
    batch = spark.createDataFrame([(message("A", 0),), ("broken",), (None,), ("{}",)], "value string")
    assert parse_ticks(batch, drop_malformed=True).count() + rejected_messages(batch).count() == 4
    assert rejected_messages(batch).filter("value IS NULL").count() == 1


def test_failed_batch_stops_the_query_and_is_replayed(spark, tmp_path):
    inbox = two_files(tmp_path)
    real = writers.parquet_writer(str(tmp_path / "table"))

    def fails_after_writing(rows, batch_id):
        real(rows, batch_id)
        if batch_id == 1:
            raise RuntimeError("sink went away")

    with pytest.raises(Exception, match="sink went away"):
        run_table(spark, tmp_path, inbox, fails_after_writing)
    got = run_table(spark, tmp_path, inbox)
    assert got.count() == 5
    assert got.select("batch_id").distinct().count() == 2


def test_row_count_is_logged(spark, tmp_path, caplog):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 0), message("A", 0), message("B", 0))
    with caplog.at_level("INFO", logger="ticklake.streaming.writers"):
        run_table(spark, tmp_path, inbox)
    assert "batch 0 wrote 2 rows" in caplog.text


@pytest.mark.parametrize("raw", [False, True])
def test_console_job(spark, tmp_path, raw):
    inbox = two_files(tmp_path)
    query = jobs.ticks_to_console(
        file_messages(spark, str(inbox)), str(tmp_path / "checkpoint"), NOW, raw=raw
    )
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 7


def test_two_queries_share_a_session(spark, tmp_path):
    source = file_messages(spark, str(two_files(tmp_path)))
    first = jobs.ticks_to_parquet(source, str(tmp_path / "out"), str(tmp_path / "c1"), NOW)
    second = jobs.ticks_to_console(source, str(tmp_path / "c2"), NOW)
    jobs.wait_for(spark, first, second)
    assert not first.isActive and not second.isActive


def test_waiting_raises_the_failure_of_any_query(spark, tmp_path):
    inbox = two_files(tmp_path)

    def fails(rows, batch_id):
        raise RuntimeError("no sink")

    endless = jobs.ticks_to_console(file_messages(spark, str(inbox)), str(tmp_path / "c1"))
    broken = jobs.ticks_to_table(file_messages(spark, str(inbox)), fails, str(tmp_path / "c2"))
    try:
        with pytest.raises(Exception, match="no sink"):
            jobs.wait_for(spark, endless, broken)
        assert endless.isActive
    finally:
        endless.stop()


def test_stream_times_are_whole_seconds(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 0).replace("000}", "999}"))
    got = run_table(spark, tmp_path, inbox)
    time = got.select(got.timestamp_ts.cast("timestamp_ntz").alias("t")).first().t
    assert time == dt.datetime(2024, 1, 1)
