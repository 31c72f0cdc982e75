"""The registered queries: every operator over the whole ``events`` table seen as ticks.

Floating-point aggregates are rounded here, and only here, so that engines which add in
another order can be compared.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake import scratch
from ticklake.functions import clock, indicators, labels
from ticklake.operators import alerts, dedup, filters, ranking, rollup, series, stats
from ticklake.plans import dashboard, market_report, sql_views
from ticklake.schemas import DASHBOARD_COLUMNS, SNAPSHOT_COLUMNS, STREAM_COLUMNS, TICK_MESSAGE
from ticklake.sinks.messages import to_messages
from ticklake.sinks.tables import append_snapshot, create_snapshot_table, save_by_symbol
from ticklake.sources import events
from ticklake.sources.messages import file_messages
from ticklake.sources.mini_tickers import explode_mini_tickers
from ticklake.sources.snapshots import load_snapshot
from ticklake.streaming import bars, fan_out, jobs, parse, views, writers
from ticklake.streaming.parse import parse_ticks

Query = Callable[[SparkSession, str], DataFrame]

#: ``event_id`` never falls while ``ts`` rises, so it orders the ticks of a symbol.
ORDER = "event_id"

#: Symbols of the watched list.
WATCHED = ("S1", "S2", "S3", "S5", "S8", "S13")

#: Fixed value: rows of the "most recent" view.
RECENT = 2000

#: Micro-batches per copy of the landed messages.
LANDED_BATCHES = 4

#: Ticks in a landed file, about; more ticks are in more files, so that more tasks write and read them.
LANDED_ROWS = 125_000

#: Width of the stream's bars, and how many seconds a tick may be behind the newest one.
BAR_WIDTH = "6 hours"
BAR_DELAY = 86_400

AVAILABLE_NOW = {"availableNow": True}

_QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _query(function: Query) -> Query:
    """Register under the function's name; ticks are UTC wall-clock times."""

    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    _QUERIES[function.__name__] = run
    return run


def _rounded(rows: DataFrame, places: int, *names: str) -> DataFrame:
    return rows.withColumns({name: F.round(name, places) for name in names})


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


# Snapshot analysis


@_query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.latest_snapshot(events.ticks(spark, sf_dir), recorded="timestamp_ts")


def _snapshot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.symbol_totals(latest_snapshot(spark, sf_dir))


def _rounded_stats(rows: DataFrame) -> DataFrame:
    names = ("avg_return_pct", "avg_volatility_pct", "total_quote_volume_million")
    return _rounded(rows, 8, *names)


@_query
def tick_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.with_snapshot_indicators(events.ticks(spark, sf_dir)).select(
        "event_id",
        "symbol",
        "spread",
        "mid_price",
        "quote_volume_million",
        "volatility_abs",
        "return_pct",
        "volatility_pct",
    )


@_query
def snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.ticks(spark, sf_dir).select(
        "event_id",
        clock.snapshot_date("run_ts").alias("date"),
        clock.epoch_seconds("run_ts").alias("event_time"),
    )


@_query
def snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_snapshot(spark, sf_dir)
    return rows.agg(F.max("run_ts").alias("last_run"), F.count(F.lit(1)).alias("nb_rows"))


@_query
def market_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.market_kpis(latest_snapshot(spark, sf_dir))
    names = ("total_quote_volume_million", "avg_market_return_pct", "avg_market_volatility_pct")
    return _rounded(rows, 8, *names)


@_query
def symbol_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(stats.symbol_stats(latest_snapshot(spark, sf_dir)))


@_query
def symbol_stats_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(stats.symbol_stats(events.ticks(spark, sf_dir)))


@_query
def top_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(ranking.top_winners(stats.stats_of(_snapshot_totals(spark, sf_dir))))


@_query
def top_losers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(ranking.top_losers(stats.stats_of(_snapshot_totals(spark, sf_dir))))


@_query
def top_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(ranking.top_volume(stats.stats_of(_snapshot_totals(spark, sf_dir))))


@_query
def top_volatile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(ranking.top_volatile(stats.stats_of(_snapshot_totals(spark, sf_dir))))


@_query
def report_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(market_report.rankings(_snapshot_totals(spark, sf_dir)))


@_query
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = market_report.summary(_snapshot_totals(spark, sf_dir))
    values = [name for name in row.columns if name.endswith("_value")]
    names = ("total_quote_volume_million", "avg_market_return_pct", "avg_market_volatility_pct")
    return _rounded(row, 8, *names, *values)


@_query
def status_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = events.ticks(spark, sf_dir)
    return_text, return_class = labels.return_label(indicators.return_pct())
    volatility_text, volatility_class = labels.warning_label(indicators.volatility_pct())
    return ticks.select(
        "event_id",
        return_text.alias("return_text"),
        return_class.alias("return_class"),
        volatility_text.alias("volatility_text"),
        volatility_class.alias("volatility_class"),
        labels.volume_text(F.col("quote_volume")).alias("volume_text"),
    )


# Dashboard analysis


@_query
def dash_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.with_dashboard_indicators(events.ticks(spark, sf_dir)).select(
        "event_id", "symbol", "pct_change", "volatility", "spread"
    )


@_query
def symbol_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.symbol_catalogue(events.ticks(spark, sf_dir))


@_query
def default_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.default_pairs(events.ticks(spark, sf_dir))


@_query
def recent_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.recent_ticks(events.ticks(spark, sf_dir), limit=RECENT, tie=ORDER)


@_query
def selected_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = events.ticks(spark, sf_dir)
    pairs = F.broadcast(ranking.default_pairs(ticks))
    return dashboard.working_set(ticks, pairs, period="Tout", tie=ORDER)


def _period(period: str, limit: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ticks = events.ticks(spark, sf_dir)
        return dashboard.working_set(ticks, period=period, limit=limit, tie=ORDER)

    return run


def _named(name: str, function: Query) -> None:
    function.__name__ = name
    _query(function)


_named("period_window", _period("24H"))
_named("period_window_1h", _period("1H"))
_named("period_window_7d", _period("7J"))
_named("period_window_30d", _period("30J"))
_named("period_window_recent", _period("24H", RECENT))


@_query
def dashboard_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's read: listed symbols, their newest ticks, then the period."""
    rows = filters.recent_ticks(events.ticks(spark, sf_dir), WATCHED, RECENT, ORDER)
    return filters.period_window(rows, "7J").select(*DASHBOARD_COLUMNS, ORDER)


@_query
def history_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The details table of one symbol, with the place of each row in it."""
    ticks = events.ticks(spark, sf_dir)
    shown = series.history_table(series.symbol_history(ticks, tie=ORDER), WATCHED[0])
    place = F.row_number().over(Window.orderBy(F.desc("Timestamp"), F.asc("Open")))  # one symbol's rows
    return shown.withColumn("place", place)


@_query
def ranking_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume ranking under the labels that the dashboard shows."""
    return labels.labelled(ranking.latest_by_volume(_latest(spark, sf_dir)))


@_query
def alert_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.labelled(alerts.large_moves(_latest(spark, sf_dir)))


@_query
def symbol_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.symbol_overview(events.ticks(spark, sf_dir), ORDER)
    return _rounded(_rounded(rows, 8, "avg_close"), 12, "avg_volatility")


def _gaps(ticks: DataFrame) -> DataFrame:
    """With NULLs put in by a rule, so the columns of a symbol's latest values come from different ticks."""
    return ticks.withColumns(
        {
            "close_price": F.when(F.col("volume") % 7 != 0, F.col("close_price")),
            "volume": F.when(F.col("volume") % 3 != 0, F.col("volume")),
        }
    )


@_query
def latest_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.latest(_gaps(events.ticks(spark, sf_dir)), ORDER)


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.latest(events.ticks(spark, sf_dir), ORDER)


@_query
def dash_top_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.latest_by_volume(_latest(spark, sf_dir))


@_query
def dash_gainers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.gainers(_latest(spark, sf_dir))


@_query
def dash_losers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.losers(_latest(spark, sf_dir))


@_query
def anomaly_large_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.large_moves(_latest(spark, sf_dir))


@_query
def anomaly_high_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.high_volatility(scratch.checkpointed(_latest(spark, sf_dir)))


@_query
def alert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_counts(scratch.checkpointed(_latest(spark, sf_dir)))


@_query
def symbol_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.symbol_summary(events.ticks(spark, sf_dir), ORDER)


# Ordered series


@_query
def moving_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = events.ticks(spark, sf_dir).select("symbol", "timestamp_ts", ORDER, "close_price")
    return _rounded(series.moving_averages(ticks, tie=ORDER), 8, "ma7", "ma25")


@_query
def moving_averages_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = events.ticks(spark, sf_dir).select("symbol", "timestamp_ts", ORDER, "close_price")
    rows = series.moving_averages(ticks, tie=ORDER, newest_first=True)
    return _rounded(rows, 8, "ma7", "ma25")


@_query
def candle_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.candle_series(events.ticks(spark, sf_dir), tie=ORDER)
    return _rounded(rows, 8, "ma7", "ma25")


@_query
def symbol_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.symbol_history(events.ticks(spark, sf_dir), tie=ORDER)
    return _rounded(rows, 8, "ma7", "ma25")


@_query
def gainers_base100(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.gainers_base100(events.ticks(spark, sf_dir), order=ORDER)


# Messages and payloads


def _message_ticks(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("timestamp", clock.epoch_millis("timestamp_ts"))


@_query
def tick_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _message_ticks(events.ticks(spark, sf_dir))
    rows = rows.select("event_id", "timestamp", clock.tick_timestamp().alias("timestamp_ts"))
    return rows.select("event_id", "timestamp", _ntz("timestamp_ts"))


@_query
def tick_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ticks(to_messages(_message_ticks(events.ticks(spark, sf_dir))))


def _payloads(ticks: DataFrame) -> DataFrame:
    """Three messages per tick: an array of good and bad elements, an object, broken text."""
    text = F.col("close_price").cast("string")
    full = F.struct(
        F.col("symbol").alias("s"),
        text.alias("c"),
        F.col("open_price").alias("o"),
        F.col("high_price").alias("h"),
        F.col("low_price").alias("l"),
        F.col("volume").cast("string").alias("v"),
        F.col("quote_volume").alias("q"),
        F.col("timestamp").alias("E"),
    )
    partial = F.struct(F.col("symbol").alias("s"), text.alias("c"), F.col("timestamp").alias("E"))
    array = F.concat(
        F.lit("["),
        F.to_json(full),
        F.lit(","),
        F.to_json(partial),
        F.lit(',{"s":"NULL","c":null},{"s":"WORD","c":"none"},"text",7]'),
    )
    messages = F.array(array, F.to_json(full), F.concat(F.lit("{"), F.col("symbol")))
    return ticks.select(F.explode(messages).alias("value"))


@_query
def mini_ticker_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_mini_tickers(_payloads(_message_ticks(events.ticks(spark, sf_dir))))


@_query
def dedup_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = events.ticks(spark, sf_dir)
    return dedup.dedup_ticks(ticks.unionByName(ticks))


# Written and read back


@_query
def rest_snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick lands as a ticker, two per line, with numbers as text and as numbers."""
    landed = scratch.new_folder(spark, "snapshot")
    ticks = _message_ticks(events.ticks(spark, sf_dir))

    def ticker(symbol: Column, number: Callable[[str], Column]) -> Column:
        return F.struct(
            symbol.alias("symbol"),
            number("close_price").alias("lastPrice"),
            number("open_price").alias("openPrice"),
            number("high_price").alias("highPrice"),
            number("low_price").alias("lowPrice"),
            number("volume").alias("volume"),
            number("quote_volume").alias("quoteVolume"),
            F.col("timestamp").alias("closeTime"),
        )

    line = F.concat(
        F.lit("["),
        F.to_json(ticker(F.col("symbol"), lambda name: F.col(name).cast("string"))),
        F.lit(","),
        F.to_json(ticker(F.concat(F.lit("N"), F.col("symbol")), F.col)),
        F.lit("]"),
    )
    ticks.select(line.alias("value")).write.mode("overwrite").text(landed)
    rows = load_snapshot(spark, landed, dt.datetime(2024, 2, 1))
    return rows.withColumn("run_ts", _ntz("run_ts"))


@_query
def snapshot_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create if absent (twice), append all snapshots, read the newest through its partition."""
    table = f"ticklake_snapshots_{uuid.uuid4().hex}"
    location = scratch.new_folder(spark, "snapshot-table")
    rows = events.ticks(spark, sf_dir).withColumn("close_time", clock.epoch_millis("timestamp_ts"))
    create_snapshot_table(spark, table, location)
    create_snapshot_table(spark, table, location)
    append_snapshot(rows.select(*SNAPSHOT_COLUMNS), table)
    schema = spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")
    stored = spark.read.schema(schema).parquet(location)
    newest = filters.latest_snapshot(stored, day="run_date")
    return newest.withColumn("run_ts", _ntz("run_ts"))


def _stored_stream(rows: DataFrame) -> DataFrame:
    return rows.select(*(_ntz(c) if c == "timestamp_ts" else F.col(c) for c in STREAM_COLUMNS))


@_query
def stream_ticks_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.new_folder(spark, "stream-parquet")
    ticks = _message_ticks(events.as_ticks(events.stream_events(spark, sf_dir)))
    stream = jobs.ticks_to_parquet(
        to_messages(ticks), f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW
    )
    stream.awaitTermination()
    return _stored_stream(spark.read.parquet(f"{folder}/table"))


@_query
def stream_mini_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload stream, normalised, published as tick messages and stored."""
    folder = scratch.new_folder(spark, "stream-mini")
    ticks = _message_ticks(events.as_ticks(events.stream_events(spark, sf_dir)))
    messages = to_messages(explode_mini_tickers(_payloads(ticks)))
    stream = jobs.ticks_to_parquet(
        messages, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW
    )
    stream.awaitTermination()
    return _stored_stream(spark.read.parquet(f"{folder}/table"))


def _landed_files(table: DataFrame, rows: int) -> int:
    """Files of a micro-batch of a table with so many rows: all batches have those of the input, at least."""
    return max(-(-len(table.inputFiles()) // LANDED_BATCHES), -(-rows // (LANDED_BATCHES * LANDED_ROWS)), 1)


def _land_repeated(spark: SparkSession, sf_dir: str, inbox: str) -> Iterator[None]:
    """Every message twice below ``inbox``, a folder at a time; the second copies come after all the first ones.

    Folders are ranges of seconds with about as many ticks each, so a folder holds all ticks of a
    second. What is landed between two steps is one micro-batch, however many files that is.
    """
    ticks = _message_ticks(events.ticks(spark, sf_dir)).withColumn("second", F.floor(F.col("timestamp") / 1000))
    shares = [n / LANDED_BATCHES for n in range(1, LANDED_BATCHES)]
    rows, cuts = ticks.agg(F.count(F.lit(1)), F.percentile_approx("second", shares)).first()
    cuts = sorted(set(cuts or []))
    files = _landed_files(events.read_events(spark, sf_dir), rows)
    place = sum((F.coalesce(F.col("second") >= cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    for n in range(len(cuts) + 1):
        part = ticks.filter(place == n).select(*TICK_MESSAGE.names)
        to_messages(part.repartition(files)).write.text(f"{inbox}/1-{n}")
        yield
    for n in range(len(cuts) + 1):
        spark.read.text(f"{inbox}/1-{n}").write.text(f"{inbox}/2-{n}")
        yield


def _dedup_stream(spark: SparkSession, sf_dir: str, name: str, cross_batch: bool) -> DataFrame:
    folder = scratch.new_folder(spark, name)
    store = writers.parquet_writer(f"{folder}/table")
    inbox = f"{folder}/inbox"
    for _ in _land_repeated(spark, sf_dir, inbox):
        stream = jobs.ticks_to_table(
            file_messages(spark, f"{inbox}/*"), store, f"{folder}/checkpoint", AVAILABLE_NOW, cross_batch=cross_batch
        )
        stream.awaitTermination()
    return _stored_stream(store.read(spark))


@_query
def stream_foreachbatch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats fall into other micro-batches, so each is stored twice."""
    return _dedup_stream(spark, sf_dir, "stream-dedup", cross_batch=False)


@_query
def stream_cross_batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick of the second half comes late and is known; none is dropped for its age."""
    return _dedup_stream(spark, sf_dir, "stream-dedup-all", cross_batch=True)


def _mixed_messages(ticks: DataFrame) -> DataFrame:
    """Per tick one good message and four that are none."""
    good = F.to_json(F.struct(*TICK_MESSAGE.names), {"ignoreNullFields": "false"})
    broken = F.concat(F.lit("{"), F.col("symbol"))
    bad_field = F.concat(F.lit('{"symbol":"'), F.col("symbol"), F.lit('","close_price":"none"}'))
    empty = F.lit(None).cast("string")
    return ticks.select(F.explode(F.array(good, broken, bad_field, F.lit("7"), empty)).alias("value"))


@_query
def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected messages, which make up all of them."""
    messages = _mixed_messages(_message_ticks(events.ticks(spark, sf_dir)))
    accepted = parse_ticks(messages, drop_malformed=True).select("symbol", F.lit("accepted").alias("kind"))
    rejected = parse.rejected_messages(messages).select(F.col("value"), F.lit("rejected").alias("kind"))
    return accepted.select("kind", F.col("symbol").alias("value")).union(rejected.select("kind", "value"))


@_query
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of good and bad messages for three sinks: ticks, all messages by day, rejects."""
    folder = scratch.new_folder(spark, "fan-out")
    store = writers.parquet_writer(f"{folder}/ticks")
    sinks = [
        fan_out.ticks_sink(store, drop_malformed=True),
        fan_out.parquet_sink(f"{folder}/all"),
        fan_out.rejects_sink(f"{folder}/rejects"),
    ]
    messages = _mixed_messages(_message_ticks(events.as_ticks(events.stream_events(spark, sf_dir))))
    fan_out.fan_out(messages, sinks, f"{folder}/checkpoint", AVAILABLE_NOW).awaitTermination()
    ticks = _stored_stream(store.read(spark)).select(F.lit("ticks").alias("sink"), "symbol", "timestamp_ts", "close_price")
    whole = spark.read.parquet(f"{folder}/all")
    whole = whole.select(F.lit("all").alias("sink"), "symbol", _ntz("timestamp_ts"), "close_price")
    rejects = spark.read.parquet(f"{folder}/rejects").select(F.lit("rejects").alias("sink"), F.col("value").alias("symbol"))
    return ticks.union(whole).unionByName(rejects, allowMissingColumns=True)


def _shuffled_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events as a stream of several micro-batches, in an order that has nothing to do with time."""
    table = events.read_events(spark, sf_dir)
    batch = -(-len(table.inputFiles()) // LANDED_BATCHES)
    table.repartition(batch * LANDED_BATCHES, F.xxhash64(ORDER)).write.parquet(f"{folder}/inbox")
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", batch).parquet(f"{folder}/inbox")


def _followed(spark: SparkSession, sf_dir: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    folder = scratch.new_folder(spark, "follow-latest")
    ticks = change(events.as_ticks(_shuffled_stream(spark, sf_dir, folder)))
    view = views.latest_view(ticks, f"{folder}/view")
    views.follow_latest(ticks, view, f"{folder}/checkpoint", AVAILABLE_NOW, order=ORDER).awaitTermination()
    return view.read(spark)


@_query
def stream_latest_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of the stream after all its batches."""
    return _followed(spark, sf_dir, _gaps)


@_query
def stream_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top lists and alerts read from the view that the stream keeps."""
    latest = scratch.checkpointed(_followed(spark, sf_dir, lambda ticks: ticks))
    lists = {
        "top_volume": ranking.latest_by_volume(latest).select("symbol", "volume"),
        "gainers": ranking.gainers(latest).select("symbol", "pct_change"),
        "losers": ranking.losers(latest).select("symbol", "pct_change"),
        "large_moves": alerts.large_moves(latest).select("symbol", "pct_change"),
        "high_volatility": alerts.high_volatility(latest).select("symbol", "volatility"),
        "alert_counts": alerts.alert_counts(latest).select("alert", F.col("nb_symbols").cast("double")),
    }
    named = [rows.toDF("name", "value").select(F.lit(key).alias("list"), "name", "value") for key, rows in lists.items()]
    return functools.reduce(DataFrame.union, named)


@_query
def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of ticks that come in order, but for every 97th, which comes last and is mostly late."""
    folder = scratch.new_folder(spark, "stream-bars")
    table = events.read_events(spark, sf_dir)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows, first, last = table.agg(F.count(F.lit(1)), F.min(at), F.max(at)).first()
    files, step = _landed_files(table, rows), (last - first) // LANDED_BATCHES + 1
    in_time = F.col(ORDER) % 97 != 0
    ranges = [in_time & (at >= first + n * step) & (at < first + (n + 1) * step) for n in range(LANDED_BATCHES)]
    store = bars.BarStore(f"{folder}/bars", BAR_WIDTH, BAR_DELAY, ORDER)
    for wanted in (*ranges, ~in_time):  # what is landed between two runs is one micro-batch, however many files that is
        table.filter(wanted).repartition(files).write.mode("append").parquet(f"{folder}/inbox")
        ticks = events.as_ticks(spark.readStream.schema(table.schema).parquet(f"{folder}/inbox"))
        ticks = ticks.withColumn("timestamp_ts", F.col("timestamp_ts").cast("timestamp"))
        bars.follow_bars(ticks, store, f"{folder}/checkpoint", AVAILABLE_NOW).awaitTermination()
    made = store.bars(spark).select(F.lit("bar").alias("kind"), "symbol", _ntz("bar_start"), "open_price", "close_price", "high_price", "low_price", "volume", "ticks", "final")
    beside = store.beside(spark).select(
        F.col("reason").alias("kind"),
        "symbol",
        _ntz("timestamp_ts").alias("bar_start"),
        "open_price",
        "close_price",
        "high_price",
        "low_price",
        "volume",
        F.lit(1).cast("bigint").alias("ticks"),
        F.lit(True).alias("final"),
    )
    return made.union(beside)


# Day partials


def _rolled_up(spark: SparkSession, sf_dir: str) -> rollup.DayRollup:
    """The whole table rolled up in two parts, the second of which has a day of the first anew."""
    store = rollup.DayRollup(scratch.new_folder(spark, "rollup"))
    ticks = events.ticks(spark, sf_dir)
    day = F.col("run_ts").cast("date")
    store.add(ticks.filter(F.day("run_ts") <= 20), day, ORDER)
    store.add(ticks.filter(F.day("run_ts") >= 20), day, ORDER)
    return store


@_query
def rollup_market_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rollup.market_kpis(_rolled_up(spark, sf_dir).partials(spark))
    names = ("total_quote_volume_million", "avg_market_return_pct", "avg_market_volatility_pct")
    return _rounded(rows, 8, *names)


@_query
def rollup_symbol_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(rollup.symbol_stats(_rolled_up(spark, sf_dir).partials(spark)))


@_query
def rollup_symbol_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rollup.symbol_overview(_rolled_up(spark, sf_dir).partials(spark))
    return _rounded(_rounded(rows, 8, "avg_close"), 12, "avg_volatility")


@_query
def rollup_distinct_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct symbols of each day and the six before it, from bitmaps alone."""
    return rollup.trailing_distinct_symbols(_rolled_up(spark, sf_dir).bitmaps(spark), 7)


# Pruned inside the plan


def _by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks as a table partitioned by day."""
    path = f"{scratch.new_folder(spark, 'ticks-by-day')}/ticks"
    ticks = events.ticks(spark, sf_dir)
    dated = ticks.withColumn("day", F.col("run_ts").cast("date"))
    dated.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return spark.read.schema(dated.schema).parquet(path)


@_query
def pruned_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.newest_days(_by_day(spark, sf_dir), "day").drop("day")


@_query
def pruned_period_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.newest_days(_by_day(spark, sf_dir), "day", 7 * 24)
    return indicators.with_dashboard_indicators(rows.select(*DASHBOARD_COLUMNS, ORDER))


@_query
def pruned_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of the days on which the market's quote volume was above its average day."""
    ticks = _by_day(spark, sf_dir)
    days = ticks.groupBy("day").agg(F.sum("quote_volume").alias("traded"))
    busy = days.filter(F.col("traded") > days.agg(F.avg("traded")).scalar())
    return filters.of_days(ticks, busy, "day").drop("day")


# As SQL text


@_query
def sql_recent_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_views.recent_ticks(events.ticks(spark, sf_dir), WATCHED, RECENT, "7J", ORDER).select(*DASHBOARD_COLUMNS, ORDER)


@_query
def sql_table_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top lists, large moves and one symbol's candles through SQL table functions."""
    sql_views.register(events.ticks(spark, sf_dir), ORDER)
    lists = """SELECT concat(:volume, place) AS name, symbol, volume AS value FROM top_by(:volume, :k)
        UNION ALL SELECT concat(:gain, place), symbol, pct_change FROM top_by(:gain, :k)
        UNION ALL SELECT concat(:loss, place), symbol, pct_change FROM top_by(:loss, :k)
        UNION ALL SELECT 'move', symbol, pct_change FROM large_moves(:percent)
        UNION ALL SELECT concat('candle ', color), :symbol, round(ma7, 8) FROM symbol_candles(:symbol)
        UNION ALL SELECT 'history', :symbol, round(ma25, 8) FROM symbol_history(:symbol)"""
    words = {"volume": "volume", "gain": "gain", "loss": "loss"}
    return spark.sql(lists, args=words | {"k": 5, "percent": 5.0, "symbol": WATCHED[0]})


# Bucketed by symbol


def _by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks in buckets by symbol. The catalogue's entry lives as long as the session."""
    name = f"ticklake_ticks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return save_by_symbol(events.ticks(spark, sf_dir), name, scratch.new_folder(spark, "ticks-by-symbol"), buckets)


@_query
def bucketed_symbol_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.symbol_overview(_by_symbol(spark, sf_dir), ORDER)
    return _rounded(_rounded(rows, 8, "avg_close"), 12, "avg_volatility")


@_query
def bucketed_candle_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.candle_series(_by_symbol(spark, sf_dir), tie=ORDER, slice_rows=None)
    return _rounded(rows, 8, "ma7", "ma25")
