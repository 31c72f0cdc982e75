"""Streams of raw messages with a ``value`` column, from Kafka or from landed text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticklake.settings import KafkaSettings


def kafka_package(spark: SparkSession) -> str:
    """Connector coordinates for ``--packages``, at the running Spark version."""
    return f"org.apache.spark:spark-sql-kafka-0-10_2.13:{spark.version}"


def kafka_source_options(
    kafka: KafkaSettings,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Subscribe options; ``min_partitions`` splits a hot topic partition over several tasks."""
    options = {
        "kafka.bootstrap.servers": kafka.bootstrap,
        "subscribe": kafka.topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_messages(spark: SparkSession, kafka: KafkaSettings, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_source_options(kafka, **options))
    return reader.load()


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """One message per line of the text files that land in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
