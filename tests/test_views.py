"""Dashboard values that follow a stream."""

from __future__ import annotations

import pytest
from test_streaming import NOW, land, message

from ticklake.plans import dashboard
from ticklake.sources.messages import file_messages
from ticklake.streaming import runs, views
from ticklake.streaming.parse import enrich, parse_ticks


def ticks_of(spark, inbox, stream=True):
    messages = file_messages(spark, str(inbox), 1) if stream else spark.read.text(str(inbox))
    return enrich(parse_ticks(messages))


def follow(spark, tmp_path, inbox, view=None):
    ticks = ticks_of(spark, inbox)
    view = view or views.latest_view(ticks, str(tmp_path / "view"))
    query = views.follow_latest(ticks, view, str(tmp_path / "checkpoint"), NOW)
    query.awaitTermination()
    return view, query


def same(spark, view, inbox):
    want = dashboard.latest(ticks_of(spark, inbox, stream=False))
    got = view.read(spark)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_state_equals_batch_after_every_batch(spark, tmp_path):
    """Late ticks, NULL values and a restart; the state lies in RocksDB."""
    inbox = tmp_path / "in"
    partial = message("A", 9).replace('"volume": 1.0', '"volume": null')
    land(inbox, "1.txt", message("A", 5, 2.0), message("B", 1), "broken")
    land(inbox, "2.txt", message("A", 3, 9.0), partial, message("C", 2))
    view, _ = follow(spark, tmp_path, inbox)
    same(spark, view, inbox)
    land(inbox, "3.txt", message("B", 0, 7.0), message("D", 4))
    _, query = follow(spark, tmp_path, inbox)
    same(spark, view, inbox)
    state = query.lastProgress["stateOperators"][0]
    assert "rocksdbBytesCopied" in str(state["customMetrics"]) or any("rocksdb" in k.lower() for k in state["customMetrics"])


def test_only_changed_symbols_are_written(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.txt", *[message(f"S{i}", 0) for i in range(30)])
    land(inbox, "2.txt", message("S3", 1, 5.0))
    view, _ = follow(spark, tmp_path, inbox)
    sizes = {run.first: spark.read.parquet(run.path).count() for run in runs.listed(spark, view.path)}
    assert sizes == {0: 30, 1: 1} and view.read(spark).count() == 30


def test_view_stays_small_and_minds_no_replay(spark, tmp_path):
    schema = spark.createDataFrame([("a", 1.0)], "symbol string, price double").schema
    view = views.KeyedView(str(tmp_path / "v"), schema, ["symbol"], fan=3)
    batches = [spark.createDataFrame([("a", float(i)), (f"b{i % 2}", float(i))], schema) for i in range(10)]
    for batch_id, rows in enumerate(batches):
        view(rows, batch_id)
        view(rows, batch_id)  # again
        assert len(runs.listed(spark, view.path)) <= 6
    assert sorted(map(tuple, view.read(spark).collect())) == [("a", 9.0), ("b0", 8.0), ("b1", 9.0)]
    assert sum(spark.read.parquet(run.path).count() for run in runs.listed(spark, view.path)) <= 12


@pytest.fixture(autouse=True)
def default_state_store(spark):
    yield
    spark.conf.unset(views.PROVIDER)
