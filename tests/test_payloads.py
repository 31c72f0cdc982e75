"""Snapshot files, mini-ticker payloads and tick messages."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from ticklake.schemas import MINI_TICKER_FIELDS, SNAPSHOT_COLUMNS, TICK_MESSAGE
from ticklake.sinks.messages import to_messages
from ticklake.sinks.tables import append_snapshot, create_snapshot_table
from ticklake.sources.events import as_ticks
from ticklake.sources.mini_tickers import explode_mini_tickers
from ticklake.sources.snapshots import load_snapshot
from ticklake.streaming.parse import enrich, parse_ticks, rejected_messages

TICKER = {
    "symbol": "AAA",
    "lastPrice": "1.25",
    "openPrice": 1,
    "highPrice": "1.5e0",
    "lowPrice": 0.75,
    "volume": "10",
    "quoteVolume": "12.5",
    "closeTime": 1704067200123,
    "ignored": {"x": 1},
}
RUN = dt.datetime(2024, 1, 1, 12, 0, 0, 5)


def landed(tmp_path, text: str) -> str:
    (tmp_path / "tickers.json").write_text(text)
    return str(tmp_path)


@pytest.mark.parametrize("indent", [None, 2])
def test_snapshot_array_file(spark, tmp_path, indent):
    other = TICKER | {"symbol": "BBB"}
    path = landed(tmp_path, json.dumps([TICKER, other], indent=indent))
    rows = load_snapshot(spark, path, RUN, multi_line=indent is not None)
    assert rows.columns == SNAPSHOT_COLUMNS
    got = sorted(rows.collect())
    assert [r.symbol for r in got] == ["AAA", "BBB"]
    assert {r.run_ts for r in rows.select(rows.run_ts.cast("timestamp_ntz").alias("run_ts")).collect()} == {RUN}
    first = got[0]
    assert (first.close_price, first.open_price, first.high_price) == (1.25, 1.0, 1.5)
    assert (first.low_price, first.volume, first.quote_volume) == (0.75, 10.0, 12.5)
    assert first.close_time == 1704067200123


@pytest.mark.parametrize(
    "broken",
    [
        {k: v for k, v in TICKER.items() if k != "lowPrice"},
        TICKER | {"volume": "ten"},
        TICKER | {"closeTime": None},
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_one_bad_ticker_fails_the_snapshot(spark, tmp_path, broken, ansi):
    path = landed(tmp_path, json.dumps([TICKER, broken]))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="snapshot ticker with"):
            load_snapshot(spark, path, RUN).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_broken_text_fails_the_snapshot(spark, tmp_path):
    with pytest.raises(Exception):
        load_snapshot(spark, landed(tmp_path, '[{"symbol": '), RUN).collect()


def test_snapshot_table_appends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = landed(tmp_path / "in", json.dumps([TICKER]))
    table = "snapshots_under_test"
    try:
        for day in (1, 2):
            create_snapshot_table(spark, table, str(tmp_path / "table"))
            append_snapshot(load_snapshot(spark, path, dt.datetime(2024, 1, day)), table)
        append_snapshot(load_snapshot(spark, path, RUN).filter("false"), table)
        rows = spark.table(table)
        assert rows.count() == 2
        assert sorted(str(r.run_date) for r in rows.collect()) == ["2024-01-01", "2024-01-02"]
        assert "PartitionFilters: [isnotnull(run_date" in plan(rows.filter("run_date = DATE '2024-01-02'"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_decimal_snapshot_table(spark, tmp_path):
    table = "decimal_snapshots_under_test"
    create_snapshot_table(spark, table, str(tmp_path / "table"), decimal=True)
    try:
        path = landed(tmp_path, json.dumps([TICKER]))
        append_snapshot(load_snapshot(spark, path, RUN), table)
        assert str(spark.table(table).first().close_price) == "1.250000000000000000"
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_event_properties_are_json(spark):
    texts = ['{"k": 7}', '{"k": -7}', '{"k":7}', ' {"j": {"k": 1}, "k": "8.5"}', '{"j": 1}', "k", None]
    frame = spark.createDataFrame(
        [(i, RUN, i, 1.0, text) for i, text in enumerate(texts)],
        "event_id long, ts timestamp_ntz, user_id long, value double, props string",
    )
    got = [r.volume for r in as_ticks(frame).orderBy("event_id").collect()]
    assert got == [8.0, -6.0, 8.0, 9.5, None, None, None]


FULL = {"s": "A", "c": "1.5", "o": 1, "h": "2", "l": 0.5, "v": "7", "q": "8.25", "E": 1704067200123}


def normalise(payload) -> list[dict]:
    """What one message should give, in plain Python."""
    try:
        elements = json.loads(payload)
    except ValueError:
        return []
    made = []
    for element in elements:
        try:
            tick = {"symbol": element.get("s", "")}
            for name, key in MINI_TICKER_FIELDS.items():
                if name not in ("symbol", "timestamp"):
                    tick[name] = float(element.get(key, 0))
            tick["timestamp"] = int(element.get("E", 0))
            made.append(tick)
        except Exception:
            continue
    return made


PAYLOADS = [
    json.dumps([FULL, FULL | {"s": "B"}]),
    json.dumps([{}]),
    json.dumps([{"s": "only symbol"}, {"c": "3"}]),
    json.dumps([FULL | {"c": None}, FULL | {"s": None}, FULL | {"E": None}]),
    json.dumps([FULL | {"v": "many"}, FULL | {"E": "12.5"}, FULL | {"E": 12.7}, FULL | {"E": "17"}]),
    json.dumps([FULL | {"c": True}, FULL | {"c": []}, FULL | {"c": {}}, FULL | {"c": ""}]),
    json.dumps(["text", 7, None, [1], FULL]),
    json.dumps(FULL),
    json.dumps([]),
    json.dumps("text"),
    "not json",
    "",
    '[{"s": "cut"',
]


@pytest.mark.parametrize("payload", PAYLOADS)
def test_mini_tickers(spark, payload):
    frame = spark.createDataFrame([(payload.encode(),)], "value binary")
    got = [row.asDict() for row in explode_mini_tickers(frame).collect()]
    assert got == normalise(payload)


def test_null_message_gives_no_tick(spark):
    assert explode_mini_tickers(spark.createDataFrame([(None,)], "value string")).count() == 0


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_malformed_messages_stay_as_null_rows(spark):
    good = '{"symbol":"A","close_price":1.5,"timestamp":1704067200999}'
    bad_field = '{"symbol":"B","close_price":"1.5","timestamp":1}'
    frame = messages(spark, good, "not json", bad_field, "[]", None)
    rows = enrich(parse_ticks(frame)).collect()
    assert len(rows) == 5
    by_symbol = {r.symbol: r for r in rows if r.symbol}
    assert by_symbol["A"].close_price == 1.5 and by_symbol["A"].open_price is None
    assert by_symbol["B"].close_price is None and by_symbol["B"].timestamp == 1
    assert sum(all(v is None for v in r) for r in rows) == 3


def test_rejects(spark):
    frame = messages(spark, '{"symbol":"A"}', "not json", '{"symbol":"B","volume":"x"}')
    assert [r.symbol for r in parse_ticks(frame, drop_malformed=True).collect()] == ["A"]
    rejected = {r.value for r in rejected_messages(frame).collect()}
    assert rejected == {"not json", '{"symbol":"B","volume":"x"}'}


def test_messages_round_trip(spark):
    row = ("A", 1.1, 0.1 + 0.2, 1e-12, None, 1e300, -0.0, 1704067200999)
    frame = spark.createDataFrame([row], TICK_MESSAGE)
    assert parse_ticks(to_messages(frame)).collect() == frame.collect()
    assert '"low_price":null' in to_messages(frame).first().value
