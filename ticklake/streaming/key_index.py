"""The keys of a stored stream, kept so that a micro-batch finds its repeats in few files.

Keys lie by UTC day, and within a day in runs (see ``runs``). A batch adds one run to each day it has
new ticks of, and opens the days of its own ticks only; within them Parquet's statistics skip
what lies outside of its times, because runs are sorted by time. The index is a set: a run that is there
twice, or in part beside its sources, says the same, so a crash at any point leaves an index that
is whole. Each key carries its batch, and a replayed batch does not see its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import scratch
from ticklake.streaming import runs
from ticklake.streaming.runs import FAN, Run

#: The folder of keys without a time, as Spark names the partition of a NULL.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

KEYS = "symbol string, timestamp_ts timestamp, batch_id bigint"


class KeyIndex:
    """Keys (symbol, timestamp_ts) of stored ticks below ``path``, in folders date=*/run=*."""

    def __init__(self, path: str, fan: int = FAN) -> None:
        self.path, self.fan = path, fan

    def is_there(self, spark: SparkSession) -> bool:
        return scratch.exists(spark, self.path)

    def create(self, stored: DataFrame) -> None:
        """An index of ticks that are stored already; their columns include date and batch_id."""
        scratch.make_folder(stored.sparkSession, self.path)
        self._write(stored, runs.run_name(0, 0, 0))

    def _day_path(self, date: dt.date | None) -> str:
        return f"{self.path}/date={NO_DATE if date is None else date.isoformat()}"

    def runs(self, spark: SparkSession, date: dt.date | None) -> list[Run]:
        return runs.listed(spark, self._day_path(date))

    def keys(self, spark: SparkSession, dates: Iterable[dt.date | None], batch_id: int) -> DataFrame:
        """Keys of other batches on these days; only their runs are listed."""
        found = [run for day in scratch.for_each(lambda date: self.runs(spark, date), dates) for run in day]
        return runs.read(spark, found, KEYS).filter(F.col("batch_id") != batch_id)

    def add(self, stored: DataFrame, dates: Iterable[dt.date | None], batch_id: int) -> None:
        """A run for each day of a batch's stored ticks, then the merges that are due on these days.

        Adding a batch again overwrites its runs, or, once they are merged, repeats them.
        """
        self._write(stored, runs.run_name(0, batch_id, batch_id))
        for folder in runs.due(stored.sparkSession, map(self._day_path, dates), self.fan):
            runs.merge_due(stored.sparkSession, folder, KEYS, self.fan, "timestamp_ts")

    def _write(self, stored: DataFrame, run: str) -> None:
        keys = stored.select("symbol", "timestamp_ts", "batch_id", "date", F.lit(run).alias("run"))
        sorted_keys = keys.hint("rebalance", "date").sortWithinPartitions("date", "timestamp_ts")
        writer = sorted_keys.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date", "run").parquet(self.path)
