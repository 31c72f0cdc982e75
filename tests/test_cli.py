"""The command-line jobs end to end, on files."""

from __future__ import annotations

import json

import pytest
from test_payloads import TICKER
from test_streaming import message

from ticklake import cli


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    return lambda *arguments: cli.main([str(a) for a in arguments])


def test_snapshot_then_report(spark, run, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps([TICKER, TICKER | {"symbol": "BBB", "lastPrice": "9"}]))
    table = "cli_snapshots"
    try:
        for hour in ("09", "10"):
            run(
                "snapshot", "--input", landing, "--table", table,
                "--location", tmp_path / "table", "--run-ts", f"2024-01-01T{hour}:00:00",
            )
        assert spark.table(table).count() == 4
        run("report", "--table", table, "--output", tmp_path / "report")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    summary = spark.read.parquet(str(tmp_path / "report/summary")).first()
    assert (summary.nb_symbols, summary.nb_rows, summary.best_symbol) == (2, 2, "BBB")
    assert spark.read.parquet(str(tmp_path / "report/rankings")).count() == 8


def test_stream_then_views(spark, run, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines = [message(s, second, second + 1.0) for s in ("A", "B") for second in range(30)]
    (inbox / "1.txt").write_text("\n".join(lines + lines) + "\n")
    common = ("--files", inbox, "--checkpoint", tmp_path / "checkpoint", "--once")
    run("stream-table", *common, "--output", tmp_path / "table")
    run("stream-parquet", *common, "--output", tmp_path / "raw", "--console")
    assert spark.read.parquet(str(tmp_path / "table")).count() == 60
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 120
    run("views", "--table", tmp_path / "table", "--output", tmp_path / "views", "--symbols", "A", "B")
    rows = {p.name: spark.read.parquet(str(p)).count() for p in (tmp_path / "views").iterdir()}
    assert rows["candles"] == rows["history"] == rows["gainers_base100"] == 60
    assert rows["overview"] == rows["gainers"] == 2 and rows["summary"] == 16
    assert len(rows) == 11


def test_normalise_then_stream_then_compact(spark, run, tmp_path):
    inbox = tmp_path / "payloads"
    inbox.mkdir()
    tickers = [{"s": s, "c": "2", "o": 1, "h": 3, "l": 1, "v": 5, "q": 9, "E": 1704067200000} for s in "AB"]
    (inbox / "1.txt").write_text(json.dumps([*tickers, {"c": None}, "text"]) + "\nbroken\n")
    once = ("--checkpoint", tmp_path / "checkpoint", "--once")
    run("normalise", "--files", inbox, *once, "--output", tmp_path / "messages")
    (tmp_path / "messages" / "late.txt").write_text("broken\n")
    run(
        "stream-table", "--files", str(tmp_path / "messages") + "/*.txt", *once, "--output", tmp_path / "table",
        "--cross-batch", "--drop-malformed", "--rejects", tmp_path / "rejects",
    )
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2
    assert [r.value for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["broken"]
    run("compact", "--table", tmp_path / "table", "--output", tmp_path / "closed", "--before", "2024-01-02")
    assert spark.read.parquet(str(tmp_path / "closed")).count() == 2


def test_options_reach_the_readers(spark, monkeypatch):
    """Parsed arguments only: no broker and no database."""
    seen = {}
    monkeypatch.setattr(cli, "kafka_messages", lambda spark, kafka, **options: seen.update(options))
    monkeypatch.setattr(cli, "scan_jdbc", lambda spark, jdbc, *arguments: seen.update(scan=arguments))
    monkeypatch.setenv("TICKLAKE_JDBC_URL", "jdbc:none")
    stream = ["stream-table", "--output", "o", "--checkpoint", "c"]
    kafka = ["--ignore-data-loss", "--min-partitions", "40", "--max-offsets", "1000", "--starting-offsets", "earliest"]
    cli._messages(spark, cli.parser().parse_args(stream + kafka))
    assert seen == {
        "starting_offsets": "earliest",
        "fail_on_data_loss": False,
        "min_partitions": 40,
        "max_offsets_per_trigger": 1000,
    }
    split = ["--partition-column", "id", "--lower", "0", "--upper", "900", "--partitions", "9"]
    cli._table(spark, cli.parser().parse_args(["report", "--table", "t", "--output", "o", "--jdbc", *split]))
    assert seen["scan"] == ("t", "id", "0", "900", 9)
