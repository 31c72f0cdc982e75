"""Candles by event time: windows under a watermark, with late ticks counted and kept beside.

A window is open until the watermark, the newest event time of earlier batches less a delay, has
passed its end; then its bar is final. Spark's own windowed aggregate drops what comes later
without a trace. Here a micro-batch is split: ticks of open windows become partial bars, ticks of closed
ones and ticks without a time go to a table of their own, and the three counts add up to
the ticks that came. Partial bars are kept by day in runs (see ``runs``) and joined when runs are
merged or read; a batch rewrites nothing but the days it has ticks of.

The watermark after a batch is kept as the name of an empty folder, so that a replayed batch
is split as it was before.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake import scratch
from ticklake.functions import indicators
from ticklake.functions.clock import utc_date
from ticklake.streaming import runs
from ticklake.streaming.jobs import Trigger, started
from ticklake.streaming.key_index import NO_DATE

log = logging.getLogger(__name__)

PARTIAL = (
    "symbol string, bar_start timestamp, bar_end timestamp, first_order bigint, open_price double, high_price double, "
    "low_price double, last_order bigint, close_price double, volume double, ticks bigint"
)

#: Watermarks of this many batches stay; a replay needs the one before its batch.
KEPT = 8

#: Why a tick is in no bar.
LATE, UNTIMED = "late", "no time"


def join_partials(partials: DataFrame) -> DataFrame:
    """One row per symbol and window; only fixed-width buffers, so a busy symbol is a row per task."""
    return partials.groupBy("symbol", "bar_start", "bar_end").agg(
        F.min("first_order").alias("first_order"),
        F.min_by("open_price", "first_order").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max("last_order").alias("last_order"),
        F.max_by("close_price", "last_order").alias("close_price"),
        F.sum("volume").alias("volume"),
        F.sum("ticks").alias("ticks"),
    )


def partial_bars(ticks: DataFrame, width: str, order: str) -> DataFrame:
    """Bars of ticks: the first and last close by ``order``, the highest and lowest price, the sum of volumes."""
    span = F.window("timestamp_ts", width)
    rows = ticks.select(
        "symbol",
        span.start.cast("timestamp").alias("bar_start"),
        span.end.cast("timestamp").alias("bar_end"),
        F.col(order).cast("bigint").alias("first_order"),
        F.col("close_price").alias("open_price"),
        "high_price",
        "low_price",
        F.col(order).cast("bigint").alias("last_order"),
        "close_price",
        "volume",
        F.lit(1).cast("bigint").alias("ticks"),
    )
    return join_partials(rows)


@dataclass(frozen=True)
class Accounts:
    """Where the ticks of a stream went."""

    in_bars: int
    late: int
    untimed: int


class BarStore:
    """Bars of one width below ``path``: a batch writer, and the readers of what it keeps."""

    def __init__(self, path: str, width: str, delay_seconds: int, order: str, fan: int = runs.FAN) -> None:
        self.path, self.width, self.order, self.fan = path, width, order, fan
        self.delay = delay_seconds * 1_000_000

    # what is kept

    def watermark(self, spark: SparkSession, batch_id: int | None = None) -> int | None:
        """In microseconds, for this batch or the next one to come; None before the first timed tick."""
        found = [tuple(map(int, name.split("_"))) for name in scratch.folder_sizes(spark, f"{self.path}/watermarks")]
        earlier = [(batch, newest) for batch, newest in found if batch_id is None or batch < batch_id]
        return max(earlier)[1] - self.delay if earlier else None

    def _advance(self, spark: SparkSession, batch_id: int, newest: int | None) -> None:
        before = self.watermark(spark, batch_id)
        known = [value for value in (newest, None if before is None else before + self.delay) if value is not None]
        if known:
            scratch.make_folder(spark, f"{self.path}/watermarks/{batch_id}_{max(known)}")
        for name in scratch.folder_sizes(spark, f"{self.path}/watermarks"):
            if int(name.split("_")[0]) <= batch_id - KEPT:
                scratch.delete_folder(spark, f"{self.path}/watermarks/{name}")

    def __call__(self, ticks: DataFrame, batch_id: int) -> None:
        spark = ticks.sparkSession
        watermark = self.watermark(spark, batch_id)
        # the window function passes over rows without a time, so it gets another time for them: the source is read once
        some = F.coalesce("timestamp_ts", F.lit("1970-01-01 00:00:00").cast(ticks.schema["timestamp_ts"].dataType))
        end = F.unix_micros(F.window(some, self.width).end.cast("timestamp"))
        closed = F.lit(False) if watermark is None else end <= watermark
        reason = F.when(F.col("timestamp_ts").isNull(), UNTIMED).when(closed, LATE)
        split = ticks.withColumn("reason", reason).persist()
        try:
            seen = Observation(f"bars_{batch_id}")
            moment = F.unix_micros(F.col("timestamp_ts").cast("timestamp"))
            counts = [F.count(F.when(F.col("reason") == why, 1)).alias(name) for why, name in ((LATE, "late"), (UNTIMED, "untimed"))]
            observed = split.observe(seen, F.max(moment).alias("newest"), F.count(F.lit(1)).alias("all"), *counts)
            beside = observed.filter(F.col("reason").isNotNull()).withColumn("batch_id", F.lit(batch_id))
            writer = beside.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("batch_id").parquet(f"{self.path}/late")
            on_time = split.filter(F.col("reason").isNull())
            bars = partial_bars(on_time, self.width, self.order)
            run = F.lit(runs.run_name(0, batch_id, batch_id)).alias("run")
            dated = bars.select("*", utc_date("bar_start").alias("date"), run).persist()
            try:
                days = [row.date for row in dated.select("date").distinct().collect()]  # days the batch has ticks of
                writer = dated.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy("date", "run").parquet(f"{self.path}/bars")
            finally:
                dated.unpersist()
            for folder in runs.due(spark, (f"{self.path}/bars/date={day}" for day in days), self.fan):
                runs.merge_due(spark, folder, PARTIAL, self.fan, "bar_start", join_partials)
            told = seen.get
            self._advance(spark, batch_id, told["newest"])
        finally:
            split.unpersist()
        log.info("batch %s: %s ticks, %s late, %s without a time", batch_id, told["all"], told["late"], told["untimed"])

    # what is read

    def bars(self, spark: SparkSession, days: list | None = None) -> DataFrame:
        """All bars, or those of some days, open ones as they stand: of a day only the runs that count are read."""
        names = scratch.folder_names(spark, f"{self.path}/bars") if days is None else [f"date={day}" for day in days]
        dated = [name for name in names if NO_DATE not in name]
        found = [run for day in scratch.for_each(lambda name: runs.listed(spark, f"{self.path}/bars/{name}"), dated) for run in day]
        bars = join_partials(runs.read(spark, found, PARTIAL)).drop("first_order", "last_order")
        watermark = self.watermark(spark)
        final = F.lit(False) if watermark is None else F.unix_micros("bar_end") <= watermark
        return bars.withColumns({"color": indicators.candle_direction(), "final": final})

    def beside(self, spark: SparkSession) -> DataFrame:
        """Ticks that are in no bar, with the reason; before the first one only these two columns."""
        if not scratch.folder_names(spark, f"{self.path}/late"):
            return spark.createDataFrame([], "reason string, batch_id bigint")
        return spark.read.parquet(f"{self.path}/late")

    def accounts(self, spark: SparkSession) -> Accounts:
        in_bars = self.bars(spark).agg(F.coalesce(F.sum("ticks"), F.lit(0))).first()[0]
        reasons = {row.reason: row["count"] for row in self.beside(spark).groupBy("reason").count().collect()}
        return Accounts(in_bars, reasons.get(LATE, 0), reasons.get(UNTIMED, 0))


def follow_bars(ticks: DataFrame, store: BarStore, checkpoint: str, trigger: Trigger | None = None) -> StreamingQuery:
    """Keeps the bars of a stream of ticks."""
    return started(ticks.writeStream.foreachBatch(store), checkpoint, trigger)
