"""Streaming queries over a frame of messages (see ``ticklake.sources.messages``).

Every query has its own checkpoint. ``trigger`` is the keyword set of
``DataStreamWriter.trigger``, for instance ``{"processingTime": "1 second"}`` or
``{"availableNow": True}``; None runs micro-batches back to back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ticklake.functions.clock import utc_date
from ticklake.streaming.parse import enrich, parse_ticks, rejected_messages
from ticklake.streaming.writers import BatchWriter, deduplicating

Trigger = Mapping[str, object]

EVERY_SECOND: Trigger = {"processingTime": "1 second"}


def started(
    writer: DataStreamWriter, checkpoint: str, trigger: Trigger | None, mode: str = "append"
) -> StreamingQuery:
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def ticks_to_parquet(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    drop_malformed: bool = False,
) -> StreamingQuery:
    """Parsed and enriched ticks to Parquet, partitioned by UTC day; exactly once."""
    ticks = enrich(parse_ticks(messages, drop_malformed))
    dated = ticks.withColumn("date", utc_date("timestamp_ts"))
    writer = dated.writeStream.format("parquet").option("path", path).partitionBy("date")
    return started(writer, checkpoint, trigger)


def ticks_to_table(
    messages: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    trigger: Trigger | None = EVERY_SECOND,
    cross_batch: bool = False,
    drop_malformed: bool = False,
) -> StreamingQuery:
    """Parsed, enriched and de-duplicated ticks to a micro-batch writer.

    Repeats are removed inside a micro-batch; ``cross_batch`` also removes those of ticks
    stored by other batches. It keeps no state: each batch looks up the days it has ticks of.
    """
    ticks = enrich(parse_ticks(messages, drop_malformed))
    writer = ticks.writeStream.foreachBatch(deduplicating(write, cross_batch))
    return started(writer, checkpoint, trigger)


def rejects_to_parquet(
    messages: DataFrame, path: str, checkpoint: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """The messages that ``drop_malformed`` leaves out, exactly once, as a ``value`` column."""
    writer = rejected_messages(messages).writeStream.format("parquet").option("path", path)
    return started(writer, checkpoint, trigger)


def ticks_to_console(
    messages: DataFrame,
    checkpoint: str,
    trigger: Trigger | None = EVERY_SECOND,
    rows: int = 10,
    raw: bool = False,
) -> StreamingQuery:
    """A debug view of the newest micro-batch, parsed or (``raw``) as message text."""
    shown = messages.select(F.col("value").cast("string")) if raw else enrich(parse_ticks(messages))
    writer = shown.writeStream.format("console").option("truncate", False).option("numRows", rows)
    return started(writer, checkpoint, trigger)


def wait_for(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Block until all the queries end; the failure of any is raised as soon as it happens."""
    spark.streams.resetTerminated()
    while True:
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
        if not any(query.isActive for query in queries):
            return
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
