"""One read of a message stream for many sinks.

Each micro-batch is read and parsed once, kept, and handed to every sink in turn. A sink that
has taken a batch leaves a mark below the checkpoint, so a batch that is replayed because
a later sink failed, or the driver was lost, goes only to the sinks that have not taken it. A sink that
dies after its write and before its mark gets the batch again: the folders written here overwrite what
the same batch wrote, so nothing is stored twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake import scratch
from ticklake.functions.clock import utc_date
from ticklake.streaming.jobs import Trigger, started
from ticklake.streaming.parse import GOOD, REJECTED, classified
from ticklake.streaming.writers import BatchWriter, deduplicating

#: Marks of this many batches stay; Spark replays the last one only.
MARKS = 8


@dataclass(frozen=True)
class Sink:
    """A name that its marks go by, the rows it takes of a classified batch, and its writer."""

    name: str
    rows: Callable[[DataFrame], DataFrame]
    write: BatchWriter


def accepted(batch: DataFrame) -> DataFrame:
    return batch.filter(GOOD).drop(GOOD, REJECTED)


def everything(batch: DataFrame) -> DataFrame:
    """A row per message; one that is no tick is a row of NULLs."""
    return batch.drop(GOOD, REJECTED)


def rejected(batch: DataFrame) -> DataFrame:
    return batch.filter(f"NOT {GOOD}").select(F.col(REJECTED).alias("value"))


def batch_folders(path: str, *partitions: str) -> BatchWriter:
    """Parquet by ``partitions`` and batch; a batch that comes again overwrites its own folders."""

    def write(rows: DataFrame, batch_id: int) -> None:
        if scratch.exists(rows.sparkSession, f"{path}/_spark_metadata"):
            raise ValueError(f"{path} belongs to a file sink, whose readers would not see these files")
        numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions, "batch_id").parquet(path)

    return write


def ticks_sink(write: BatchWriter, cross_batch: bool = False, drop_malformed: bool = False) -> Sink:
    """De-duplicated ticks, as ``jobs.ticks_to_table`` stores them."""
    return Sink("ticks", accepted if drop_malformed else everything, deduplicating(write, cross_batch))


def parquet_sink(path: str, drop_malformed: bool = False) -> Sink:
    """All ticks by UTC day."""

    def dated(batch: DataFrame) -> DataFrame:
        return (accepted if drop_malformed else everything)(batch).withColumn("date", utc_date("timestamp_ts"))

    return Sink("parquet", dated, batch_folders(path, "date"))


def rejects_sink(path: str) -> Sink:
    return Sink("rejects", rejected, batch_folders(path))


def console_sink(rows: int = 10) -> Sink:
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch: {batch_id}")
        batch.show(rows, truncate=False)

    return Sink("console", everything, show)


def fan_out(
    messages: DataFrame, sinks: Sequence[Sink], checkpoint: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """The stream's ticks and rejects to all of ``sinks`` from one read."""
    names = [sink.name for sink in sinks]
    if not sinks or len({*names}) < len(names):
        raise ValueError(f"sinks need a name each: {names}")
    marks = f"{checkpoint}/sinks"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = [sink for sink in sinks if not scratch.exists(spark, f"{marks}/{sink.name}/{batch_id}")]
        kept = batch.persist() if len(waiting) > 1 else batch
        try:
            for sink in waiting:
                sink.write(sink.rows(kept), batch_id)
                scratch.make_folder(spark, f"{marks}/{sink.name}/{batch_id}")
                if batch_id >= MARKS:
                    scratch.delete_folder(spark, f"{marks}/{sink.name}/{batch_id - MARKS}")
        finally:
            kept.unpersist()

    return started(classified(messages).writeStream.foreachBatch(write_batch), checkpoint, trigger)
