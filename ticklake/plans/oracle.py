"""The registered queries as SQL for DuckDB, over the ``events`` view."""

from __future__ import annotations

_TICKS = """
WITH ticks AS (
  SELECT concat('S', cast(user_id AS varchar)) AS symbol,
         ts AS timestamp_ts, event_id,
         value AS close_price,
         value*(1+(kk-50)/1000.0::double) AS open_price,
         greatest(value, value*(1+(kk-50)/1000.0::double))*1.01::double AS high_price,
         least(value, value*(1+(kk-50)/1000.0::double))*0.99::double AS low_price,
         kk+1 AS volume, (kk+1)*value AS quote_volume,
         date_trunc('day', ts)::timestamp AS run_ts
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS double) AS kk FROM events) e
)"""

_RETURN = "(close_price-open_price)/nullif(open_price,0)"
_VOLATILITY = "(high_price-low_price)/nullif((high_price+low_price)/2,0)"
_PCT = f"round_even({_RETURN}*100,4)"
_CLOSE_VOLATILITY = "round_even((high_price-low_price)/nullif(close_price,0),6)"
_SPREAD = "round_even(high_price-low_price,8)"

_SNAPSHOT = ", snap AS (SELECT * FROM ticks WHERE run_ts = (SELECT max(run_ts) FROM ticks))"


def _stats(source: str) -> str:
    return f""", stats AS (
  SELECT symbol, avg({_RETURN}) AS r, avg({_VOLATILITY}) AS v, sum(quote_volume/1e6) AS q
  FROM {source} GROUP BY symbol)"""


_STATS_COLUMNS = (
    "symbol, round(r,8) AS avg_return_pct, round(v,8) AS avg_volatility_pct,"
    " round(q,8) AS total_quote_volume_million"
)


def _top(order: str) -> str:
    return (
        f"{_TICKS}{_SNAPSHOT}{_stats('snap')} SELECT {_STATS_COLUMNS} FROM stats"
        f" ORDER BY {order} NULLS LAST, symbol LIMIT 5"
    )


def _return_label(x: str) -> tuple[str, str]:
    text = (
        f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(CASE WHEN {x} > 0 THEN '+' ELSE '' END,"
        f" printf('%.2f', ({x})*100), '%') END"
    )
    return text, f"CASE WHEN {x} >= 0 THEN 'good' WHEN {x} < 0 THEN 'bad' END"


def _warning_label(x: str) -> tuple[str, str]:
    text = f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(printf('%.2f', ({x})*100), '%') END"
    return text, f"CASE WHEN {x} >= 0.02 THEN 'warn' WHEN {x} < 0.02 THEN 'good' END"


def _volume_text(x: str) -> str:
    return f"replace(format('{{:,}}', cast(round_even({x},0) AS bigint)), ',', ' ')"


def _label_columns(r: str, v: str, q: str) -> str:
    return (
        f"{_return_label(r)[0]} AS return_text, {_return_label(r)[1]} AS return_class,"
        f" {_warning_label(v)[0]} AS volatility_text, {_warning_label(v)[1]} AS volatility_class,"
        f" {_volume_text(q)} AS volume_text"
    )


def _ranking(section: str, value: str, direction: str) -> str:
    return f"""
  (SELECT '{section}' AS section, * FROM (
    SELECT row_number() OVER (ORDER BY {value} {direction} NULLS LAST, symbol) AS rank, *
    FROM stats) WHERE rank <= 5)"""


_RANKINGS = " UNION ALL ".join(
    [
        _ranking("winners", "r", "DESC"),
        _ranking("losers", "r", "ASC"),
        _ranking("volume", "q", "DESC"),
        _ranking("volatile", "v", "DESC"),
    ]
)

_KPIS = f"""
  count(DISTINCT symbol) AS nb_symbols, count(*) AS nb_rows,
  coalesce(sum(quote_volume/1e6),0) AS q, coalesce(avg({_RETURN}),0) AS r,
  coalesce(avg({_VOLATILITY}),0) AS v"""


def _leader(name: str, value: str, direction: str) -> str:
    return (
        f"{name} AS (SELECT symbol, {value} AS value FROM stats"
        f" ORDER BY {value} {direction} NULLS LAST, symbol LIMIT 1)"
    )


_SUMMARY = f"""{_TICKS}{_SNAPSHOT}{_stats('snap')}, kpi AS (SELECT {_KPIS} FROM snap),
{_leader('b', 'r', 'DESC')}, {_leader('w', 'r', 'ASC')},
{_leader('l', 'q', 'DESC')}, {_leader('x', 'v', 'DESC')}
SELECT kpi.nb_symbols, kpi.nb_rows, round(kpi.q,8) AS total_quote_volume_million,
  round(kpi.r,8) AS avg_market_return_pct, round(kpi.v,8) AS avg_market_volatility_pct,
  b.symbol AS best_symbol, round(b.value,8) AS best_value,
  w.symbol AS worst_symbol, round(w.value,8) AS worst_value,
  l.symbol AS most_liquid_symbol, round(l.value,8) AS most_liquid_value,
  x.symbol AS most_volatile_symbol, round(x.value,8) AS most_volatile_value,
  {_return_label('kpi.r')[0]} AS market_return_text,
  {_return_label('kpi.r')[1]} AS market_return_class,
  {_warning_label('kpi.v')[0]} AS market_volatility_text,
  {_warning_label('kpi.v')[1]} AS market_volatility_class,
  {_volume_text('kpi.q')} AS volume_text,
  concat('The market traded ', kpi.nb_symbols, ' symbols in ', kpi.nb_rows,
    ' rows for a volume of ', {_volume_text('kpi.q')}, ' M, with an average return of ',
    printf('%.2f', kpi.r*100), '% and an average volatility of ', printf('%.2f', kpi.v*100),
    '%. Best: ', b.symbol, ' (', printf('%.2f', b.value*100), '%); worst: ', w.symbol, ' (',
    printf('%.2f', w.value*100), '%); most liquid: ', l.symbol, ' (', {_volume_text('l.value')},
    ' M); most volatile: ', x.symbol, ' (', printf('%.2f', x.value*100), '%).') AS sentence
FROM kpi, b, w, l, x"""

_WORKING_COLUMNS = (
    "timestamp_ts, symbol, open_price, high_price, low_price, close_price, volume, event_id,"
    f" {_PCT} AS pct_change, {_CLOSE_VOLATILITY} AS volatility, {_SPREAD} AS spread"
)

_RECENT = "SELECT * FROM ticks ORDER BY timestamp_ts DESC, event_id DESC, symbol LIMIT 2000"


def _period(hours: int, source: str = "SELECT * FROM ticks") -> str:
    return f"""{_TICKS}, r AS ({source})
SELECT {_WORKING_COLUMNS} FROM r
WHERE timestamp_ts >= (SELECT max(timestamp_ts) FROM r) - INTERVAL {hours} HOUR"""


_LATEST_COLUMNS = [
    "timestamp_ts",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "pct_change",
    "volatility",
    "spread",
]


def _latest(source: str) -> str:
    picks = ", ".join(
        f"max_by({name}, event_id) FILTER (WHERE {name} IS NOT NULL) AS {name}"
        for name in _LATEST_COLUMNS
    )
    return f""", latest AS (
  SELECT symbol, {picks} FROM (SELECT {_WORKING_COLUMNS} FROM {source}) GROUP BY symbol)"""


_LATEST = _TICKS + _latest("ticks")

# Fixed values, as in the summary's plan.
_SUMMARY_METRICS = {
    "Prix Ouverture": "open_price",
    "Prix Clôture": "close_price",
    "Prix Haut": "high_price",
    "Prix Bas": "low_price",
    "Spread": "spread",
    "Variation (%)": "pct_change",
    "Volatilité": "volatility",
    "Volume": "volume",
}

_SYMBOL_SUMMARY = (
    f"{_TICKS}, newest AS (SELECT {_WORKING_COLUMNS} FROM ticks QUALIFY row_number() OVER"
    " (PARTITION BY symbol ORDER BY timestamp_ts DESC, event_id DESC) = 1) "
    + " UNION ALL ".join(
        f"SELECT symbol, '{label}' AS metric, {name} AS value FROM newest"
        for label, name in _SUMMARY_METRICS.items()
    )
)


def _means(direction: str) -> str:
    order = f"PARTITION BY symbol ORDER BY timestamp_ts {direction}, event_id {direction}"

    def mean(rows: int) -> str:
        frame = f"({order} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
        return (
            f"CASE WHEN count(close_price) OVER {frame} >= {rows}"
            f" THEN round(avg(close_price) OVER {frame}, 8) END AS ma{rows}"
        )

    return f"{mean(7)}, {mean(25)}"


_OHLCV = "symbol, timestamp_ts, open_price, high_price, low_price, close_price, volume, event_id"

_STREAM = """SELECT symbol, close_price, open_price, high_price, low_price, volume, quote_volume,
  date_trunc('second', timestamp_ts)::timestamp AS timestamp_ts,
  high_price-low_price AS spread, (high_price+low_price)/2 AS mid_price FROM ticks"""

_ONE_PER_SECOND = """QUALIFY row_number() OVER (
  PARTITION BY symbol, date_trunc('second', ticks.timestamp_ts) ORDER BY event_id DESC) = 1"""

_WATCHED = "('S1', 'S2', 'S3', 'S5', 'S8', 'S13')"

# Labels of the ranking and alert tables.
_TABLE_LABELS = {
    "symbol": 'symbol AS "Symbole"',
    "close_price": 'close_price AS "Prix Clôture"',
    "volume": 'volume AS "Volume"',
    "pct_change": 'pct_change AS "Variation (%)"',
    "volatility": 'volatility AS "Volatilité"',
}

_PARTIAL = """SELECT symbol, close_price, 0::double AS open_price, 0::double AS high_price,
  0::double AS low_price, 0::double AS volume, 0::double AS quote_volume, timestamp_ts FROM ticks"""

_MESSAGE = (
    "symbol, close_price, open_price, high_price, low_price, volume, quote_volume,"
    " epoch_us(timestamp_ts)//1000 AS timestamp"
)

_TICKER = (
    "close_price, open_price, high_price, low_price, volume, quote_volume,"
    " epoch_us(timestamp_ts)//1000 AS close_time"
)


_OVERVIEW = f"""{_TICKS}, o AS (
  SELECT symbol, max_by(close_price, event_id) AS latest_close,
    min_by(close_price, event_id) AS first_close, round(avg(close_price),8) AS avg_close,
    max(high_price) AS max_high, min(low_price) AS min_low,
    round(avg({_CLOSE_VOLATILITY}),12) AS avg_volatility, sum(volume) AS sum_reported_volume
  FROM ticks GROUP BY symbol)
SELECT *, latest_close-first_close AS change_abs,
  (latest_close-first_close)/nullif(first_close,0)*100 AS change_pct FROM o"""


def oracle_sql() -> dict[str, str]:
    return {
        "latest_snapshot": f"{_TICKS} SELECT * FROM ticks"
        " WHERE run_ts = (SELECT max(run_ts) FROM ticks)",
        "tick_indicators": f"""{_TICKS} SELECT event_id, symbol, high_price-low_price AS spread,
  (high_price+low_price)/2 AS mid_price, quote_volume/1e6 AS quote_volume_million,
  high_price-low_price AS volatility_abs, {_RETURN} AS return_pct,
  {_VOLATILITY} AS volatility_pct FROM ticks""",
        "snapshot_dates": f"{_TICKS} SELECT event_id, cast(run_ts AS date) AS date,"
        " cast(epoch(run_ts) AS bigint) AS event_time FROM ticks",
        "snapshot_counts": f"{_TICKS}{_SNAPSHOT} SELECT max(run_ts) AS last_run,"
        " count(*) AS nb_rows FROM snap",
        "market_kpis": f"""{_TICKS}{_SNAPSHOT}, kpi AS (SELECT {_KPIS} FROM snap)
SELECT nb_symbols, nb_rows, round(q,8) AS total_quote_volume_million,
  round(r,8) AS avg_market_return_pct, round(v,8) AS avg_market_volatility_pct FROM kpi""",
        "symbol_stats": f"{_TICKS}{_SNAPSHOT}{_stats('snap')} SELECT {_STATS_COLUMNS} FROM stats",
        "symbol_stats_all": f"{_TICKS}{_stats('ticks')} SELECT {_STATS_COLUMNS} FROM stats",
        "top_winners": _top("r DESC"),
        "top_losers": _top("r ASC"),
        "top_volume": _top("q DESC"),
        "top_volatile": _top("v DESC"),
        "report_rankings": f"""{_TICKS}{_SNAPSHOT}{_stats('snap')}
SELECT section, cast(rank AS integer) AS rank, {_STATS_COLUMNS}, {_label_columns('r', 'v', 'q')}
FROM ({_RANKINGS}) ranked""",
        "report_summary": _SUMMARY,
        "status_labels": f"{_TICKS} SELECT event_id,"
        f" {_label_columns(f'({_RETURN})', f'({_VOLATILITY})', 'quote_volume')} FROM ticks",
        "dash_indicators": f"{_TICKS} SELECT event_id, symbol, {_PCT} AS pct_change,"
        f" {_CLOSE_VOLATILITY} AS volatility, {_SPREAD} AS spread FROM ticks",
        "symbol_catalogue": f"{_TICKS} SELECT DISTINCT symbol FROM ticks ORDER BY symbol",
        "default_pairs": f"""{_TICKS}, names AS (SELECT DISTINCT symbol FROM ticks)
SELECT symbol FROM names ORDER BY CASE
  WHEN (SELECT count(*) FROM names WHERE symbol IN ('BTCUSDT','ETHUSDT')) = 2
   AND symbol IN ('BTCUSDT','ETHUSDT') THEN 0 ELSE 1 END, symbol LIMIT 2""",
        "recent_ticks": f"{_TICKS} {_RECENT}",
        "selected_ticks": f"""{_TICKS} SELECT {_WORKING_COLUMNS} FROM ticks
WHERE symbol IN (SELECT DISTINCT symbol FROM ticks ORDER BY symbol LIMIT 2)""",
        "period_window": _period(24),
        "period_window_1h": _period(1),
        "period_window_7d": _period(7 * 24),
        "period_window_30d": _period(30 * 24),
        "period_window_recent": _period(24, _RECENT),
        "symbol_overview": _OVERVIEW,
        "latest_per_symbol": f"""{_TICKS}, gaps AS (SELECT * REPLACE (
    CASE WHEN volume % 7 <> 0 THEN close_price END AS close_price,
    CASE WHEN volume % 3 <> 0 THEN volume END AS volume) FROM ticks){_latest('gaps')}
SELECT * FROM latest""",
        "dash_top_volume": f"{_LATEST} SELECT symbol, close_price, volume, pct_change, volatility"
        " FROM latest ORDER BY volume DESC NULLS LAST, symbol LIMIT 5",
        "dash_gainers": f"{_LATEST} SELECT symbol, close_price, pct_change FROM latest"
        " ORDER BY pct_change DESC NULLS LAST, symbol LIMIT 5",
        "dash_losers": f"{_LATEST} SELECT symbol, close_price, pct_change FROM latest"
        " ORDER BY pct_change ASC NULLS LAST, symbol LIMIT 5",
        "anomaly_large_move": f"{_LATEST} SELECT symbol, pct_change, volume, volatility"
        " FROM latest WHERE abs(pct_change) > 5",
        "anomaly_high_volatility": f"{_LATEST} SELECT symbol, volatility, pct_change, volume"
        " FROM latest WHERE volatility > (SELECT quantile_cont(volatility, 0.75) FROM latest)",
        "alert_counts": f"""{_LATEST}, alerts AS (
  SELECT 'large_move' AS alert FROM latest WHERE abs(pct_change) > 5 UNION ALL
  SELECT 'high_volatility' FROM latest
  WHERE volatility > (SELECT quantile_cont(volatility, 0.75) FROM latest))
SELECT alert, count(*) AS nb_symbols FROM alerts GROUP BY alert""",
        "symbol_summary": _SYMBOL_SUMMARY,
        "moving_averages": f"{_TICKS} SELECT symbol, timestamp_ts, event_id, close_price,"
        f" {_means('ASC')} FROM ticks",
        "moving_averages_forward": f"{_TICKS} SELECT symbol, timestamp_ts, event_id, close_price,"
        f" {_means('DESC')} FROM ticks",
        "candle_series": f"{_TICKS} SELECT {_OHLCV}, {_means('ASC')},"
        " CASE WHEN close_price >= open_price THEN 'green' ELSE 'red' END AS color FROM ticks",
        "symbol_history": f"{_TICKS} SELECT {_OHLCV}, {_means('DESC')}, {_PCT} AS pct_change,"
        f" {_CLOSE_VOLATILITY} AS volatility, {_SPREAD} AS spread FROM ticks",
        "gainers_base100": f"""{_LATEST}, best AS (
  SELECT symbol FROM latest ORDER BY pct_change DESC NULLS LAST, symbol LIMIT 5)
SELECT symbol, timestamp_ts, close_price, close_price/nullif(first_value(close_price)
  OVER (PARTITION BY symbol ORDER BY timestamp_ts, event_id),0)*100 AS price_index
FROM ticks WHERE symbol IN (SELECT symbol FROM best)""",
        "tick_timestamp": f"{_TICKS} SELECT event_id, epoch_us(timestamp_ts)//1000 AS timestamp,"
        " date_trunc('second', timestamp_ts)::timestamp AS timestamp_ts FROM ticks",
        "tick_json_roundtrip": f"{_TICKS} SELECT {_MESSAGE} FROM ticks",
        "mini_ticker_explode": f"""{_TICKS}, partial AS ({_PARTIAL})
SELECT {_MESSAGE} FROM ticks UNION ALL SELECT {_MESSAGE} FROM partial""",
        "dedup_ticks": f"{_TICKS} SELECT * FROM ticks",
        "rest_snapshot_load": f"""{_TICKS}
SELECT TIMESTAMP '2024-02-01 00:00:00' AS run_ts, symbol, {_TICKER} FROM ticks UNION ALL
SELECT TIMESTAMP '2024-02-01 00:00:00', concat('N', symbol), {_TICKER} FROM ticks""",
        "snapshot_table_roundtrip": f"{_TICKS}{_SNAPSHOT} SELECT run_ts, symbol, {_TICKER},"
        " cast(run_ts AS date) AS run_date FROM snap",
        "stream_ticks_parquet": f"{_TICKS} {_STREAM}",
        "stream_mini_tickers": f"""{_TICKS}, partial AS ({_PARTIAL})
{_STREAM} UNION ALL {_STREAM.replace('FROM ticks', 'FROM partial')}""",
        "stream_foreachbatch_dedup": f"{_TICKS}, one AS ({_STREAM} {_ONE_PER_SECOND})"
        " SELECT * FROM one UNION ALL SELECT * FROM one",
        "stream_cross_batch_dedup": f"{_TICKS} {_STREAM} {_ONE_PER_SECOND}",
        "rejected_messages": f"""{_TICKS}
SELECT 'accepted' AS kind, symbol AS value FROM ticks UNION ALL
SELECT 'rejected', unnest([concat('{{', symbol),
  concat('{{"symbol":"', symbol, '","close_price":"none"}}'), '7', NULL]) FROM ticks""",
        "stream_latest_per_symbol": f"""{_TICKS}, gaps AS (SELECT * REPLACE (
    CASE WHEN volume % 7 <> 0 THEN close_price END AS close_price,
    CASE WHEN volume % 3 <> 0 THEN volume END AS volume) FROM ticks){_latest('gaps')}
SELECT * FROM latest""",
        "stream_dashboard": f"""{_LATEST}, moves AS (SELECT * FROM latest WHERE abs(pct_change) > 5),
shaky AS (SELECT * FROM latest WHERE volatility > (SELECT quantile_cont(volatility, 0.75) FROM latest))
(SELECT 'top_volume' AS list, symbol AS name, volume AS value FROM latest ORDER BY volume DESC NULLS LAST, symbol LIMIT 5)
UNION ALL (SELECT 'gainers', symbol, pct_change FROM latest ORDER BY pct_change DESC NULLS LAST, symbol LIMIT 5)
UNION ALL (SELECT 'losers', symbol, pct_change FROM latest ORDER BY pct_change ASC NULLS LAST, symbol LIMIT 5)
UNION ALL SELECT 'large_moves', symbol, pct_change FROM moves
UNION ALL SELECT 'high_volatility', symbol, volatility FROM shaky
UNION ALL SELECT 'alert_counts', alert, count(*)::double FROM (SELECT 'large_move' AS alert FROM moves
  UNION ALL SELECT 'high_volatility' FROM shaky) GROUP BY alert""",
        "stream_bars": f"""{_TICKS}, ends AS (SELECT *, event_id % 97 = 0 AS behind,
    time_bucket(INTERVAL 6 HOUR, timestamp_ts, TIMESTAMP '1970-01-01') AS bar_start FROM ticks),
marks AS (SELECT max(timestamp_ts) FILTER (NOT behind) - INTERVAL 24 HOUR AS seen, max(timestamp_ts) - INTERVAL 24 HOUR AS last FROM ends),
split AS (SELECT *, behind AND bar_start + INTERVAL 6 HOUR <= (SELECT seen FROM marks) AS late FROM ends)
SELECT 'bar' AS kind, symbol, bar_start, arg_min(close_price, event_id) AS open_price, arg_max(close_price, event_id) AS close_price,
  max(high_price) AS high_price, min(low_price) AS low_price, sum(volume) AS volume, count(*) AS ticks,
  bar_start + INTERVAL 6 HOUR <= (SELECT last FROM marks) AS final
FROM split WHERE NOT late GROUP BY symbol, bar_start
UNION ALL SELECT 'late', symbol, timestamp_ts, open_price, close_price, high_price, low_price, volume, 1, true FROM split WHERE late""",
        "rollup_market_kpis": f"""{_TICKS}, kpi AS (SELECT {_KPIS} FROM ticks)
SELECT nb_symbols, nb_rows, round(q,8) AS total_quote_volume_million,
  round(r,8) AS avg_market_return_pct, round(v,8) AS avg_market_volatility_pct FROM kpi""",
        "rollup_symbol_stats": f"{_TICKS}{_stats('ticks')} SELECT {_STATS_COLUMNS} FROM stats",
        "rollup_symbol_overview": _OVERVIEW,
        "rollup_distinct_symbols": f"""{_TICKS}, days AS (SELECT DISTINCT run_ts FROM ticks)
SELECT cast(d.run_ts AS date) AS date, count(DISTINCT t.symbol) AS nb_symbols FROM days d JOIN ticks t
ON t.run_ts BETWEEN d.run_ts - INTERVAL 6 DAY AND d.run_ts GROUP BY d.run_ts""",
        "pruned_latest_snapshot": f"{_TICKS} SELECT * FROM ticks WHERE run_ts = (SELECT max(run_ts) FROM ticks)",
        "pruned_period_window": _period(7 * 24),
        "pruned_days": f"""{_TICKS}, days AS (SELECT run_ts, sum(quote_volume) AS traded FROM ticks GROUP BY run_ts)
SELECT * FROM ticks WHERE run_ts IN (SELECT run_ts FROM days WHERE traded > (SELECT avg(traded) FROM days))""",
        "sql_recent_ticks": f"""{_TICKS}, recent AS (SELECT * FROM ticks WHERE symbol IN {_WATCHED}
  ORDER BY timestamp_ts DESC, event_id DESC, symbol LIMIT 2000)
SELECT {_OHLCV} FROM recent WHERE timestamp_ts >= (SELECT max(timestamp_ts) FROM recent) - INTERVAL 168 HOUR""",
        "sql_table_functions": f"""{_LATEST}, volumes AS (SELECT row_number() OVER (ORDER BY volume DESC NULLS LAST, symbol) AS place, * FROM latest),
gains AS (SELECT row_number() OVER (ORDER BY pct_change DESC NULLS LAST, symbol) AS place, * FROM latest),
losses AS (SELECT row_number() OVER (ORDER BY pct_change ASC NULLS LAST, symbol) AS place, * FROM latest),
one AS (SELECT *, {_means('ASC')} FROM ticks WHERE symbol = 'S1'), back AS (SELECT *, {_means('DESC')} FROM ticks WHERE symbol = 'S1')
SELECT concat('volume', place) AS name, symbol, volume AS value FROM volumes WHERE place <= 5
UNION ALL SELECT concat('gain', place), symbol, pct_change FROM gains WHERE place <= 5
UNION ALL SELECT concat('loss', place), symbol, pct_change FROM losses WHERE place <= 5
UNION ALL SELECT 'move', symbol, pct_change FROM latest WHERE abs(pct_change) > 5
UNION ALL SELECT concat('candle ', CASE WHEN close_price >= open_price THEN 'green' ELSE 'red' END), symbol, ma7 FROM one
UNION ALL SELECT 'history', symbol, ma25 FROM back""",
        "bucketed_symbol_overview": _OVERVIEW,
        "bucketed_candle_series": f"{_TICKS} SELECT {_OHLCV}, {_means('ASC')},"
        " CASE WHEN close_price >= open_price THEN 'green' ELSE 'red' END AS color FROM ticks",
        "stream_fan_out": f"""{_TICKS}
SELECT 'ticks' AS sink, symbol, timestamp_ts, close_price FROM ({_STREAM} {_ONE_PER_SECOND}) UNION ALL
SELECT 'all', symbol, date_trunc('second', timestamp_ts)::timestamp, close_price FROM ticks UNION ALL
SELECT 'all', CASE WHEN good THEN symbol END, NULL, NULL FROM ticks, (SELECT unnest([true, false, false, false]) AS good) UNION ALL
SELECT 'rejects', unnest([concat('{{', symbol),
  concat('{{"symbol":"', symbol, '","close_price":"none"}}'), '7', NULL]), NULL, NULL FROM ticks""",
        "dashboard_read": f"""{_TICKS}, recent AS (SELECT * FROM ticks WHERE symbol IN {_WATCHED}
  ORDER BY timestamp_ts DESC, event_id DESC, symbol LIMIT 2000)
SELECT {_OHLCV} FROM recent WHERE timestamp_ts >= (SELECT max(timestamp_ts) FROM recent) - INTERVAL 168 HOUR""",
        "history_labels": f"""{_TICKS} SELECT timestamp_ts AS "Timestamp", open_price AS "Open",
  high_price AS "High", low_price AS "Low", close_price AS "Close", volume AS "Volume",
  {_PCT} AS "% Change", {_CLOSE_VOLATILITY} AS "Volatility", {_SPREAD} AS "Spread",
  cast(row_number() OVER (ORDER BY timestamp_ts DESC, open_price) AS integer) AS place
FROM ticks WHERE symbol = 'S1'""",
        "ranking_labels": f"""{_LATEST} SELECT {_TABLE_LABELS['symbol']}, {_TABLE_LABELS['close_price']},
  {_TABLE_LABELS['volume']}, {_TABLE_LABELS['pct_change']}, {_TABLE_LABELS['volatility']}
FROM latest ORDER BY volume DESC NULLS LAST, symbol LIMIT 5""",
        "alert_labels": f"""{_LATEST} SELECT {_TABLE_LABELS['symbol']}, {_TABLE_LABELS['pct_change']},
  {_TABLE_LABELS['volume']}, {_TABLE_LABELS['volatility']} FROM latest WHERE abs(pct_change) > 5""",
    }
