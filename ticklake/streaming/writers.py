"""Micro-batch writers for ``foreachBatch``."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake import scratch
from ticklake.functions.clock import utc_date
from ticklake.operators.dedup import dedup_ticks, latest_millisecond, not_stored
from ticklake.schemas import MEASURES, STREAM_COLUMNS
from ticklake.settings import JdbcSettings
from ticklake.sinks.tables import append_jdbc
from ticklake.streaming.key_index import NO_DATE, KeyIndex
from ticklake.streaming.runs import RUN_FILE_BYTES

log = logging.getLogger(__name__)

#: Writes the rows of one micro-batch; it must run exactly one action on them.
BatchWriter = Callable[[DataFrame, int], None]

#: Columns of the stored stream, then its partitions.
STORED = T.StructType(
    [T.StructField("symbol", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in MEASURES]
    + [T.StructField("timestamp_ts", T.TimestampType())]
    + [T.StructField(name, T.DoubleType()) for name in ("spread", "mid_price")]
    + [T.StructField("date", T.DateType()), T.StructField("batch_id", T.LongType())]
)


class ParquetTicks:
    """A Parquet table of ticks by UTC day, and by micro-batch inside a day.

    A replayed batch overwrites its own partitions, so it adds nothing; time filters on
    ``date`` prune the others. ``compact`` replaces a day's batches up to number n by one folder,
    ``batch_id=-(n + 1)``, which counts from the moment it is complete: ``read`` then passes over the folders
    it covers, whether they are deleted already or not, so each tick is seen once at any time. A tick that
    comes later for such a day is in a batch of its own and is seen beside it.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.index = KeyIndex(f"{path.rstrip('/')}_keys")

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        dated = rows.withColumns({"date": utc_date("timestamp_ts"), "batch_id": F.lit(batch_id)})
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date", "batch_id").parquet(self.path)

    def _live(self, spark, day: str) -> list[tuple[int, str, int]]:
        """(last batch in it, folder, bytes) of a day's folders that count, the compacted one first."""
        found = {int(name.removeprefix("batch_id=")): size for name, size in scratch.folder_sizes(spark, f"{self.path}/{day}").items()}
        whole = [number for number in found if number < 0 and scratch.exists(spark, f"{self.path}/{day}/batch_id={number}/_SUCCESS")]
        covered = -1 - min(whole) if whole else -1
        live = ([min(whole)] if whole else []) + sorted(number for number in found if number > covered)
        return [(max(number, -1 - number), f"{self.path}/{day}/batch_id={number}", found[number]) for number in live]

    def _days(self, spark) -> list[str]:
        return [name for name in scratch.folder_names(spark, self.path) if name.startswith("date=")]

    def read(self, spark) -> DataFrame:
        """All stored ticks, each once; none before the first batch."""
        live = scratch.for_each(lambda day: self._live(spark, day), self._days(spark))
        paths = [path for day in live for _, path, _ in day]
        if not paths:
            return spark.createDataFrame([], STORED)
        return spark.read.schema(STORED).option("basePath", self.path).parquet(*paths)

    def compact(self, spark, before: str) -> None:
        """Few files, in place, for each day before this one that has more than one folder."""
        for day in self._days(spark):
            name = day.removeprefix("date=")
            folders = self._live(spark, day)
            if name == NO_DATE or name >= before or len(folders) < 2:
                continue
            last = max(number for number, _, _ in folders)
            size = sum(bytes_ for _, _, bytes_ in folders)
            rows = spark.read.schema(STORED).option("basePath", self.path).parquet(*(path for _, path, _ in folders))
            dealt = rows.drop("date", "batch_id").repartitionByRange(max(1, -(-size // RUN_FILE_BYTES)), "timestamp_ts", "symbol")
            dealt.sortWithinPartitions("timestamp_ts", "symbol").write.mode("overwrite").parquet(f"{self.path}/{day}/batch_id={-1 - last}")
            for _, path, _ in folders:
                scratch.delete_folder(spark, path)

    def of_batch(self, spark, dates: list, batch_id: int) -> DataFrame:
        """What a batch has stored on these days; only its own folders are listed."""
        days = [NO_DATE if date is None else date.isoformat() for date in dates]
        paths = [f"{self.path}/date={day}/batch_id={batch_id}" for day in days]
        there = [path for path, found in zip(paths, scratch.for_each(lambda path: scratch.exists(spark, path), paths)) if found]
        reader = spark.read.schema(STORED).option("basePath", self.path)
        return reader.parquet(*there) if there else spark.createDataFrame([], STORED)

    def write_new(self, rows: DataFrame, batch_id: int, counted: Observation) -> None:
        """Stores the ticks that no other batch has stored, and notes their keys.

        ``rows`` are read twice: persist them. A table without an index of its keys gets one
        first, and is kept indexed from then on.
        """
        spark = rows.sparkSession
        if not self.index.is_there(spark):
            self.index.create(self.read(spark))
        days = rows.groupBy(utc_date("timestamp_ts").alias("date"))
        spans = days.agg(F.min(F.unix_micros("timestamp_ts")).alias("first"), F.max(F.unix_micros("timestamp_ts")).alias("last")).collect()
        dates = [row.date for row in spans]  # one row per day that the batch has ticks of
        known = self.index.keys(spark, dates, batch_id)
        times = [row for row in spans if row.date is not None]
        if times and len(times) == len(spans):  # literals, so Parquet skips keys of other times
            first, last = min(row.first for row in times), max(row.last for row in times)
            moment = F.col("timestamp_ts")
            known = known.filter((moment >= F.timestamp_micros(F.lit(first))) & (moment <= F.timestamp_micros(F.lit(last))))
        new = not_stored(rows, known).withColumn("date", utc_date("timestamp_ts"))
        dealt = new.hint("rebalance", "date")  # else each task writes a file into each day
        self(dealt.observe(counted, F.count(F.lit(1)).alias("rows")), batch_id)
        self.index.add(self.of_batch(spark, dates, batch_id), dates, batch_id)


def parquet_writer(path: str) -> ParquetTicks:
    return ParquetTicks(path)


def compact_days(stored: DataFrame, output: str, before: str) -> None:
    """Ticks of the days before a date in few files per day below ``output``.

    Running it again overwrites the same days. Readers take closed days from ``output`` and
    later ones from the stream's table, so no reader meets a half-written day.
    """
    closed = stored.filter(F.col("date") < F.lit(before).cast("date")).drop("batch_id")
    rows = closed.repartition("date", F.pmod(F.xxhash64("symbol", "timestamp_ts"), F.lit(8)))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(output)


def jdbc_writer(jdbc: JdbcSettings, table: str) -> BatchWriter:
    """Plain append: at least once, so a batch replayed after a crash is written again."""

    def write(rows: DataFrame, batch_id: int) -> None:
        append_jdbc(rows, jdbc, table)

    return write


def deduplicating(write: BatchWriter, cross_batch: bool = False) -> BatchWriter:
    """Dedup one micro-batch, keep the stream columns, write, and log the row count.

    Of repeats, the one with the latest millisecond stays, then the one a hash of the row
    picks, so a replayed batch writes the same rows. ``cross_batch`` also leaves out keys that
    another batch has stored, however late they come: it needs a ``ParquetTicks`` and its key
    index, and nothing is dropped for its age. The source is read and parsed once: the batch's rows are
    persisted where they are needed twice, and the count is observed during the write. Errors propagate: the query stops, its checkpoint stays, and a restart
    replays the batch.
    """
    if cross_batch and not isinstance(write, ParquetTicks):
        raise ValueError("cross-batch de-duplication looks stored ticks up: write them with parquet_writer")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        counted = Observation(f"batch_{batch_id}")
        rows = dedup_ticks(batch, order=latest_millisecond(batch)).select(*STREAM_COLUMNS)
        if cross_batch:
            rows.persist()
            try:
                write.write_new(rows, batch_id, counted)
            finally:
                rows.unpersist()
        else:
            write(rows.observe(counted, F.count(F.lit(1)).alias("rows")), batch_id)
        log.info("batch %s wrote %s rows", batch_id, counted.get["rows"])

    return write_batch
