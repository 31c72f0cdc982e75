"""Options of the sources and sinks that need a server, which tests do not start."""

from __future__ import annotations

import pytest

from ticklake import scratch
from ticklake.settings import JdbcSettings, KafkaSettings
from ticklake.sinks.messages import kafka_sink_options
from ticklake.sinks.tables import jdbc_sink_options
from ticklake.sources.messages import kafka_package, kafka_source_options
from ticklake.sources.tables import scan_options

JDBC = JdbcSettings("jdbc:some://host/db", user="reader")


def test_kafka_settings():
    assert KafkaSettings.from_env({}) == KafkaSettings("localhost:9092", "ticks")
    env = {"KAFKA_BOOTSTRAP": "a:1,b:2", "KAFKA_TOPIC": "t"}
    assert KafkaSettings.from_env(env) == KafkaSettings("a:1,b:2", "t")


def test_kafka_source_options():
    kafka = KafkaSettings("a:1", "t")
    assert kafka_source_options(kafka) == {
        "kafka.bootstrap.servers": "a:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    options = kafka_source_options(kafka, "earliest", False, min_partitions=64, max_offsets_per_trigger=10)
    assert options["failOnDataLoss"] == "false" and options["startingOffsets"] == "earliest"
    assert (options["minPartitions"], options["maxOffsetsPerTrigger"]) == ("64", "10")


def test_kafka_sink_options():
    assert kafka_sink_options(KafkaSettings("a:1", "t")) == {
        "kafka.bootstrap.servers": "a:1",
        "topic": "t",
        "kafka.acks": "all",
        "kafka.linger.ms": "500",
    }


def test_connector_follows_the_spark_version(spark):
    assert kafka_package(spark).endswith(f":{spark.version}")


def test_jdbc_settings():
    env = {"TICKLAKE_JDBC_URL": "u", "TICKLAKE_JDBC_USER": "me", "TICKLAKE_JDBC_PASSWORD": "p"}
    assert JdbcSettings.from_env(env).options() == {"url": "u", "user": "me", "password": "p"}
    with pytest.raises(KeyError):
        JdbcSettings.from_env({})


def test_jdbc_scan_options():
    assert scan_options(JDBC, "t") == {"url": "jdbc:some://host/db", "user": "reader", "dbtable": "t"}
    split = scan_options(JDBC, "t", partition_column="run_ts", lower="2024-01-01", upper="2024-02-01", partitions=31)
    assert (split["partitionColumn"], split["numPartitions"]) == ("run_ts", "31")
    with pytest.raises(ValueError):
        scan_options(JDBC, "t", partition_column="run_ts")


def test_jdbc_sink_options():
    options = jdbc_sink_options(JDBC, "t", partitions=8)
    assert (options["dbtable"], options["batchsize"], options["numPartitions"]) == ("t", "10000", "8")


def test_scratch_folders_are_below_the_shared_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch.new_folder(spark, "x"), scratch.new_folder(spark, "x")
    assert first.startswith(root) and first != second
