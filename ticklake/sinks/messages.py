"""Ticks as JSON messages, and the Kafka sink for them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ticklake.schemas import TICK_MESSAGE
from ticklake.settings import KafkaSettings


def to_messages(ticks: DataFrame) -> DataFrame:
    """One JSON object per tick in ``value``; NULL fields stay visible as JSON null."""
    return ticks.select(
        F.to_json(F.struct(*TICK_MESSAGE.names), {"ignoreNullFields": "false"}).alias("value")
    )


def kafka_sink_options(kafka: KafkaSettings, linger_ms: int = 500) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": kafka.bootstrap,
        "topic": kafka.topic,
        "kafka.acks": "all",
        "kafka.linger.ms": str(linger_ms),
    }


def publish(ticks: DataFrame, kafka: KafkaSettings) -> None:
    to_messages(ticks).write.format("kafka").options(**kafka_sink_options(kafka)).save()


def _started(writer: DataStreamWriter, checkpoint: str, trigger: Mapping | None) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def publish_stream(
    ticks: DataFrame, kafka: KafkaSettings, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    writer = to_messages(ticks).writeStream.format("kafka").options(**kafka_sink_options(kafka))
    return _started(writer, checkpoint, trigger)


def publish_files(
    ticks: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """The same messages as lines of text files, which the file source reads."""
    writer = to_messages(ticks).writeStream.format("text").option("path", path)
    return _started(writer, checkpoint, trigger)
