"""What several operators need: tables, written intermediates, Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.scratch import delete_folder, new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The rows written once to the shared folder and read back.

    Each task's output is committed by one attempt, so readers agree on it even if
    the rows came in another order when a lost executor's work was done again.
    """
    spark = rows.sparkSession
    path = f"{new_folder(spark, name)}/rows"
    rows.write.option("compression", codec).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(rows: DataFrame) -> None:
    """Deletes what ``stored`` wrote, when nothing will read it any more."""
    delete_folder(rows.sparkSession, rows.inputFiles()[0].rpartition("/")[0])


def text_of(rows: DataFrame, text: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(rows[text], F.lit(""))


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that none holds much more than ``limit`` bytes of one column.

    A single value may be larger; it then comes alone.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for row, length in enumerate(sizes):
            if row > start and held + (length or 0) > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            values if isinstance(values, pa.Array) else pa.array(values, field.type)
            for field, values in zip(schema, columns, strict=True)
        ],
        schema=schema,
    )


def worker_memory() -> dict:
    """What a Python worker keeps from one task to the next: caches only, never results."""
    return sys.modules.setdefault("_ticklake_worker_memory", types.ModuleType("memory")).__dict__
