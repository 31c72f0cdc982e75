"""Event-time bars: late ticks, replays, merges, and that no tick is lost."""

from __future__ import annotations

import json

import pytest
from test_streaming import NOW, land, message

from ticklake.sources.messages import file_messages
from ticklake.streaming import bars, runs
from ticklake.streaming.parse import enrich, parse_ticks


def ticks(spark, *messages):
    return enrich(parse_ticks(spark.createDataFrame([(m,) for m in messages], "value string")))


def store_at(path, **options):
    return bars.BarStore(str(path), "1 minute", 60, "timestamp", **options)


def shown(spark, store):
    rows = store.bars(spark).selectExpr("symbol", "unix_seconds(bar_start) - 1704067200 AS at", "*").collect()
    return {(r.symbol, r.at): (r.open_price, r.high_price, r.low_price, r.close_price, r.volume, r.ticks, r.color) for r in rows}


def test_stream_of_bars(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", message("A", 5, 3.0), message("A", 1, 2.0), message("B", 59, 1.0), "broken")
    land(inbox, "2.txt", message("A", 200, 9.0), message("A", 30, 1.0))
    land(inbox, "3.txt", message("A", 2, 7.0), message("A", 130, 4.0))  # the first is late, the second is not
    store = store_at(tmp_path / "bars")
    stream = enrich(parse_ticks(file_messages(spark, str(inbox), 1)))
    bars.follow_bars(stream, store, str(tmp_path / "checkpoint"), NOW).awaitTermination()
    assert shown(spark, store) == {
        ("A", 0): (2.0, 4.0, 0.5, 1.0, 3.0, 3, "red"),
        ("B", 0): (1.0, 2.0, 0.5, 1.0, 1.0, 1, "green"),
        ("A", 120): (4.0, 5.0, 0.5, 4.0, 1.0, 1, "green"),
        ("A", 180): (9.0, 10.0, 0.5, 9.0, 1.0, 1, "green"),
    }
    assert {(r.symbol, r.close_price, r.reason, r.batch_id) for r in store.beside(spark).collect()} == {
        ("A", 7.0, bars.LATE, 2),
        (None, None, bars.UNTIMED, 0),
    }
    assert store.accounts(spark) == bars.Accounts(6, 1, 1)
    final = {(r.symbol, r.final) for r in store.bars(spark).filter("unix_seconds(bar_start) < 1704067260").collect()}
    assert final == {("A", True), ("B", True)} and store.bars(spark).filter("NOT final").count() == 2


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_replays_and_merges_change_nothing(spark, tmp_path, fan):
    store, plain = store_at(tmp_path / "a", fan=fan), store_at(tmp_path / "b", fan=100)
    for batch_id in range(7):
        rows = ticks(spark, message("A", 10 * batch_id, float(batch_id)), message("A", 7), message("B", 100 * batch_id))
        plain(rows, batch_id)
        store(rows, batch_id)
        store(rows, batch_id)
        assert shown(spark, store) == shown(spark, plain)
        assert store.accounts(spark) == plain.accounts(spark)
        assert store.watermark(spark) == plain.watermark(spark)
    assert store.accounts(spark).late > 0
    assert len(runs.listed(spark, f"{store.path}/bars/date=2024-01-01")) <= 2 * fan


def test_incomplete_merge_does_not_count(spark, tmp_path):
    store = store_at(tmp_path / "bars")
    store(ticks(spark, message("A", 1)), 0)
    store(ticks(spark, message("A", 2)), 1)
    want = shown(spark, store)
    folder = tmp_path / "bars/bars/date=2024-01-01"
    half = spark.read.parquet(str(folder / "run=0-0-0"))
    half.write.parquet(str(folder / "run=1-0-1"))
    (folder / "run=1-0-1/_SUCCESS").unlink()
    assert shown(spark, store) == want
    whole = bars.join_partials(runs.read(spark, runs.listed(spark, str(folder)), bars.PARTIAL))
    whole.write.mode("overwrite").parquet(str(folder / "run=1-0-1"))  # complete, its sources still there
    assert shown(spark, store) == want


def test_bars_equal_those_of_all_ticks_at_once(spark, tmp_path):
    messages = [message(f"S{i % 5}", i * 7 % 3600, float(i % 13)) for i in range(300)]
    messages = [json.dumps(json.loads(m) | {"timestamp": json.loads(m)["timestamp"] + i}) for i, m in enumerate(messages)]
    one = bars.BarStore(str(tmp_path / "one"), "5 minutes", 7200, "timestamp")
    one(ticks(spark, *messages), 0)
    many = bars.BarStore(str(tmp_path / "many"), "5 minutes", 7200, "timestamp", fan=2)
    for batch_id in range(5):
        many(ticks(spark, *messages[batch_id::5]), batch_id)
    assert shown(spark, one) == shown(spark, many) and many.accounts(spark) == bars.Accounts(300, 0, 0)
    assert many.bars(spark, ["2024-01-01"]).count() == one.bars(spark).count()
