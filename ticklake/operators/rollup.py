"""Day partials: what KPIs, symbol statistics and overviews of any range of days are merged from.

A partial holds a symbol's sums, counts and extreme values of one UTC day, with the order of its first and
last tick, so partials of days add up to what the ticks of these days give. Distinct symbols do
not add up; for them a day has bitmaps over a dictionary of symbols, which are or-ed. Both are tables
by date: a new or corrected day writes its own partition, and reports read a row per symbol
and day instead of every tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import scratch
from ticklake.functions import indicators
from ticklake.operators import stats

PARTIALS = (
    "symbol string, nb_rows bigint, return_sum double, return_count bigint, volatility_sum double, "
    "volatility_count bigint, total_quote_volume_million double, first_order bigint, first_close double, "
    "last_order bigint, latest_close double, close_sum double, close_count bigint, max_high double, min_low double, "
    "close_volatility_sum double, close_volatility_count bigint, sum_reported_volume double, date date"
)

_COLUMNS = [column.split()[0] for column in PARTIALS.split(", ")]

#: Added up over days; the others are extreme values.
_SUMS = [name for name in _COLUMNS if name.endswith(("_sum", "_count", "_million", "_volume")) or name == "nb_rows"]

BITMAPS = "bucket bigint, bits binary, date date"
DICTIONARY = "symbol string, id bigint"


def day_partials(ticks: DataFrame, day: Column, order: str) -> DataFrame:
    """One row per symbol and day. ``order`` is a number that grows with time, without ties inside a symbol."""
    rows = ticks.select(
        "symbol",
        day.alias("date"),
        F.col(order).cast("bigint").alias("order"),
        "close_price",
        "high_price",
        "low_price",
        "volume",
        indicators.return_pct().alias("return_pct"),
        indicators.volatility_pct().alias("volatility_pct"),
        indicators.quote_volume_million().alias("quote_volume_million"),
        indicators.close_volatility().alias("close_volatility"),
    )
    return rows.groupBy("date", "symbol").agg(
        F.count(F.lit(1)).alias("nb_rows"),
        F.sum("return_pct").alias("return_sum"),
        F.count("return_pct").alias("return_count"),
        F.sum("volatility_pct").alias("volatility_sum"),
        F.count("volatility_pct").alias("volatility_count"),
        F.sum("quote_volume_million").alias("total_quote_volume_million"),
        F.min("order").alias("first_order"),
        F.min_by("close_price", "order").alias("first_close"),
        F.max("order").alias("last_order"),
        F.max_by("close_price", "order").alias("latest_close"),
        F.sum("close_price").alias("close_sum"),
        F.count("close_price").alias("close_count"),
        F.max("high_price").alias("max_high"),
        F.min("low_price").alias("min_low"),
        F.sum("close_volatility").alias("close_volatility_sum"),
        F.count("close_volatility").alias("close_volatility_count"),
        F.sum("volume").alias("sum_reported_volume"),
    )


def merged(partials: DataFrame) -> DataFrame:
    """One row per symbol from the partials of any days; it can be merged again."""
    return partials.groupBy("symbol").agg(
        *(F.sum(name).alias(name) for name in _SUMS),
        F.min_by("first_close", "first_order").alias("first_close"),
        F.min("first_order").alias("first_order"),
        F.max_by("latest_close", "last_order").alias("latest_close"),
        F.max("last_order").alias("last_order"),
        F.max("max_high").alias("max_high"),
        F.min("min_low").alias("min_low"),
    )


def symbol_stats(partials: DataFrame) -> DataFrame:
    """As ``stats.symbol_stats`` of the ticks behind the partials."""
    return stats.stats_of(merged(partials))


def market_kpis(partials: DataFrame) -> DataFrame:
    """As ``stats.market_kpis`` of the ticks behind the partials."""
    return merged(partials).agg(*stats.kpi_columns())


def symbol_overview(partials: DataFrame) -> DataFrame:
    """As ``stats.symbol_overview`` of the ticks behind the partials."""
    known = merged(partials.filter(F.col("symbol").isNotNull()))
    change = F.col("latest_close") - F.col("first_close")
    return known.select(
        "symbol",
        "latest_close",
        "first_close",
        F.try_divide("close_sum", "close_count").alias("avg_close"),
        "max_high",
        "min_low",
        F.try_divide("close_volatility_sum", "close_volatility_count").alias("avg_volatility"),
        "sum_reported_volume",
        change.alias("change_abs"),
        (F.try_divide(change, F.col("first_close")) * 100).alias("change_pct"),
    )


def _write_days(rows: DataFrame, path: str) -> None:
    writer = rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(path)


class DayRollup:
    """Partials, bitmaps and the dictionary of symbols below ``path``."""

    def __init__(self, path: str) -> None:
        self.path = path

    def add(self, ticks: DataFrame, day: Column, order: str) -> None:
        """Rolls up whole days of ticks: their partitions are written, or written anew, and no others.

        The ticks are read once; partials are what the bitmaps are made from.
        """
        spark = ticks.sparkSession
        partials = scratch.checkpointed(day_partials(ticks, day, order).select(*_COLUMNS))
        _write_days(partials, f"{self.path}/partials")
        self._learn(partials.filter(F.col("symbol").isNotNull()).select("symbol").distinct())
        numbered = partials.select("date", "symbol").join(self.dictionary(spark), "symbol")
        bits = numbered.groupBy("date", F.bitmap_bucket_number("id").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
        )
        _write_days(bits.select("bucket", "bits", "date"), f"{self.path}/bitmaps")

    def _learn(self, symbols: DataFrame) -> None:
        """Numbers the symbols that are new, behind the known ones; a sort over all tasks, no single one."""
        spark = symbols.sparkSession
        known = self.dictionary(spark)
        fresh = symbols.join(known, "symbol", "left_anti")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = scratch.checkpointed(
            fresh.repartitionByRange(parts, "symbol").sortWithinPartitions("symbol").withColumn("at", F.monotonically_increasing_id())
        )
        part = F.shiftright("at", 33)
        sizes = sorted(map(tuple, placed.groupBy(part).count().collect()))  # one row per task
        if not sizes:
            return
        first = (known.agg(F.max("id")).first()[0] or 0) + 1
        shift = []
        for number, size in sizes:
            shift.append((number, first - (number << 33)))
            first += size
        shifts = F.broadcast(spark.createDataFrame(shift, "part bigint, shift bigint"))  # as many rows as tasks
        ids = placed.join(shifts, part == F.col("part")).select("symbol", (F.col("at") + F.col("shift")).alias("id"))
        ids.write.mode("append").parquet(f"{self.path}/symbols")

    def _read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        scratch.make_folder(spark, f"{self.path}/{name}")
        return spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def dictionary(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "symbols", DICTIONARY)

    def partials(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "partials", PARTIALS)

    def bitmaps(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "bitmaps", BITMAPS)


def distinct_symbols(bitmaps: DataFrame) -> DataFrame:
    """One row with the number of distinct symbols on the days of these bitmaps."""
    joined = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("nb_symbols"))


def trailing_distinct_symbols(bitmaps: DataFrame, days: int) -> DataFrame:
    """(date, nb_symbols) for every day that has ticks: distinct symbols of it and the ``days`` - 1 before."""
    own = bitmaps.select("date").distinct()
    reaching = bitmaps.select(
        F.explode(F.sequence("date", F.date_add("date", days - 1))).alias("date"), "bucket", "bits"
    )
    joined = reaching.join(own, "date", "left_semi").groupBy("date", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy("date").agg(F.sum(F.bitmap_count("bits")).alias("nb_symbols"))
