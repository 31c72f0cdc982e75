"""The dashboard's reads as SQL: statements with bound parameters, and SQL table functions.

Values never become part of a statement's text. Statements and functions run over any frame of ticks;
they give the rows of the DataFrame operators they are named after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ticklake.operators import filters
from ticklake.schemas import DASHBOARD_COLUMNS

#: Name under which ``register`` makes the ticks known to its functions.
VIEW = "ticklake_ticks"

_CHANGE = "round(try_divide(close_price - open_price, open_price) * 100, 4)"
_SHAKE = "round(try_divide(high_price - low_price, close_price), 6)"
_LATEST = """SELECT symbol,
    max_by(close_price, CASE WHEN close_price IS NOT NULL THEN {order} END) AS close_price,
    max_by(volume, CASE WHEN volume IS NOT NULL THEN {order} END) AS volume,
    max_by(change, CASE WHEN change IS NOT NULL THEN {order} END) AS pct_change,
    max_by(shake, CASE WHEN shake IS NOT NULL THEN {order} END) AS volatility
  FROM (SELECT *, {change} AS change, {shake} AS shake FROM {view} WHERE symbol IS NOT NULL) GROUP BY symbol"""


def recent_ticks(
    ticks: DataFrame, symbols: Sequence[str], limit: int, period: str = "Tout", tie: str = "symbol"
) -> DataFrame:
    """The dashboard's read: listed symbols, their newest ticks, then the period.

    One marker per symbol, so the list reaches the scan as an IN filter. ``tie`` names a column
    and is checked to be one.
    """
    if tie not in ticks.columns:
        raise ValueError(f"no column {tie!r}")
    names = {f"s{number}": symbol for number, symbol in enumerate(symbols)}
    listed = ", ".join(f":{name}" for name in names) or "NULL"
    columns = ", ".join(dict.fromkeys([*DASHBOARD_COLUMNS, tie]))
    hours = filters.PERIODS[period]
    since = "" if hours is None else "WHERE timestamp_ts >= (SELECT max(timestamp_ts) FROM newest) - make_interval(0, 0, 0, 0, :hours)"
    statement = f"""WITH newest AS (
      SELECT {columns} FROM {{ticks}} WHERE symbol IN ({listed})
      ORDER BY timestamp_ts DESC, `{tie}` DESC, symbol LIMIT :limit)
    SELECT * FROM newest {since}"""
    arguments = names | {"limit": limit} | ({} if hours is None else {"hours": hours})
    return ticks.sparkSession.sql(statement, args=arguments, ticks=ticks)


def register(ticks: DataFrame, order: str = "timestamp_ts") -> None:
    """Makes the ticks and these table functions known to the session's SQL.

    ``symbol_candles(symbol)``, ``symbol_history(symbol)``, ``top_by(measure, k)`` with the measures
    volume, gain and loss, ``large_moves(percent)``.
    """
    spark: SparkSession = ticks.sparkSession
    if order not in ticks.columns:
        raise ValueError(f"no column {order!r}")
    ticks.createOrReplaceTempView(VIEW)
    latest = _LATEST.format(order=f"`{order}`", change=_CHANGE, shake=_SHAKE, view=VIEW)
    frame = "(PARTITION BY symbol ORDER BY timestamp_ts {way}, `" + order + "` {way} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"

    def means(way: str) -> str:
        shown = []
        for name, rows in (("ma7", 7), ("ma25", 25)):
            over = frame.format(way=way, n=rows - 1)
            shown.append(f"CASE WHEN count(close_price) OVER {over} >= {rows} THEN avg(close_price) OVER {over} END AS {name}")
        return ", ".join(shown)

    prices = "timestamp_ts, open_price, high_price, low_price, close_price, volume"
    typed = "timestamp_ts {time}, open_price DOUBLE, high_price DOUBLE, low_price DOUBLE, close_price DOUBLE, volume DOUBLE"
    typed = typed.format(time=ticks.schema["timestamp_ts"].dataType.simpleString())
    functions = {
        f"symbol_candles(wanted STRING) RETURNS TABLE({typed}, ma7 DOUBLE, ma25 DOUBLE, color STRING)": f"""
            SELECT {prices}, {means('ASC')}, CASE WHEN close_price >= open_price THEN 'green' ELSE 'red' END
            FROM {VIEW} WHERE symbol = wanted""",
        f"symbol_history(wanted STRING) RETURNS TABLE({typed}, ma7 DOUBLE, ma25 DOUBLE, pct_change DOUBLE, volatility DOUBLE)": f"""
            SELECT {prices}, {means('DESC')}, {_CHANGE}, {_SHAKE} FROM {VIEW} WHERE symbol = wanted""",
        "top_by(measure STRING, k INT) RETURNS TABLE(place INT, symbol STRING, close_price DOUBLE, volume DOUBLE, pct_change DOUBLE)": f"""
            SELECT place, symbol, close_price, volume, pct_change FROM (
              SELECT *, row_number() OVER (ORDER BY CASE measure WHEN 'volume' THEN volume WHEN 'gain' THEN pct_change
                WHEN 'loss' THEN -pct_change END DESC NULLS LAST, symbol) AS place FROM ({latest}))
            WHERE place <= k""",
        "large_moves(percent DOUBLE) RETURNS TABLE(symbol STRING, pct_change DOUBLE, volume DOUBLE, volatility DOUBLE)": f"""
            SELECT symbol, pct_change, volume, volatility FROM ({latest}) WHERE abs(pct_change) > percent""",
    }
    for head, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
