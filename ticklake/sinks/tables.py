"""Snapshot tables: create if absent, append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schemas import snapshot_table_schema
from ticklake.settings import JdbcSettings


def create_snapshot_table(
    spark: SparkSession, table: str, location: str | None = None, decimal: bool = False
) -> None:
    """An append-only Parquet table, one partition per snapshot day."""
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()}" for field in snapshot_table_schema(decimal)
    )
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY (run_date){place}"
    )


def append_snapshot(rows: DataFrame, table: str) -> None:
    """Append snapshot rows in one commit.

    The rebalance hint writes few files per day and splits a day that outgrows one task.
    """
    spark = rows.sparkSession
    schema = spark.table(table).schema
    dated = rows.withColumn("run_date", F.to_date("run_ts"))
    columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    dated.select(*columns).hint("rebalance", "run_date").write.mode("append").insertInto(table)


def jdbc_sink_options(
    jdbc: JdbcSettings, table: str, batch_size: int = 10_000, partitions: int | None = None
) -> dict[str, str]:
    options = jdbc.options() | {"dbtable": table, "batchsize": str(batch_size)}
    if partitions is not None:
        options["numPartitions"] = str(partitions)
    return options


def append_jdbc(rows: DataFrame, jdbc: JdbcSettings, table: str, **options) -> None:
    """Append to a database table, created on first use; a retried job may append twice."""
    writer = rows.write.format("jdbc").mode("append")
    writer.options(**jdbc_sink_options(jdbc, table, **options)).save()


def save_by_symbol(ticks: DataFrame, table: str, location: str, buckets: int, time: str = "timestamp_ts") -> DataFrame:
    """The ticks as a table in buckets by symbol, sorted by symbol and time; returns the table.

    Aggregates and windows by symbol over it need no exchange, and joins by symbol with a table of as many
    buckets none on either side. One task writes one bucket, so there is a file each. A symbol is in one
    bucket whatever its size: for tables in which one holds much of the data use range slices
    (``slices``), which cut it.
    """
    spark = ticks.sparkSession
    dealt = ticks.repartition(buckets, "symbol")
    writer = dealt.write.bucketBy(buckets, "symbol").sortBy("symbol", time).option("path", location)
    writer.format("parquet").mode("overwrite").saveAsTable(table)
    return spark.table(table)
