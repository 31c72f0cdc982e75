"""Table scans over JDBC and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticklake.settings import JdbcSettings


def scan_options(
    jdbc: JdbcSettings,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """JDBC reader options; the four partition arguments go together.

    Without them the whole table comes through one connection and one task.
    """
    options = jdbc.options() | {"dbtable": table}
    split = {
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": partitions,
    }
    given = {name: str(value) for name, value in split.items() if value is not None}
    if given and len(given) < len(split):
        raise ValueError(f"a split JDBC scan needs all of {sorted(split)}")
    return options | given


def scan_jdbc(spark: SparkSession, jdbc: JdbcSettings, table: str, **split) -> DataFrame:
    """A database table; plain column predicates and projections are pushed to the database."""
    return spark.read.format("jdbc").options(**scan_options(jdbc, table, **split)).load()
