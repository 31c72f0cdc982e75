"""A stored set of rows that every micro-batch adds to, in few folders.

Rows lie in *runs*, a folder each. A batch adds one run of level 0; ``fan`` runs of one level are merged
into one run of the next, so after n batches there are at most ``fan`` - 1 runs in each of log n
levels and a row is rewritten once a level. A merge writes its run first and deletes its sources
after. Readers pass over a merged run that is not complete, and over runs that a complete one
covers, so each batch counts once at any point, also a batch that is replayed after its merge.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ticklake import scratch

#: Runs of one level before they are merged.
FAN = 8

#: Bytes of a merged run that go into one file.
RUN_FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class Run:
    level: int
    first: int
    last: int
    path: str
    bytes: int


def run_name(level: int, first: int, last: int) -> str:
    return f"{level}-{first}-{last}"


def listed(spark: SparkSession, folder: str) -> list[Run]:
    """The runs in a folder that count; nothing else of the table is listed."""
    found = []
    for name, size in scratch.folder_sizes(spark, folder).items():
        level, first, last = map(int, name.removeprefix("run=").split("-"))
        if level == 0 or scratch.exists(spark, f"{folder}/{name}/_SUCCESS"):
            found.append(Run(level, first, last, f"{folder}/{name}", size))
    return [
        run
        for run in found
        if not any(o.level > run.level and o.first <= run.first and run.last <= o.last for o in found)
    ]


def read(spark: SparkSession, runs: list[Run], schema: str) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(run.path for run in runs))


def due(spark: SparkSession, folders: Iterable[str], fan: int) -> list[str]:
    """Of these folders, those that have so many runs of the lowest level that they are to be merged."""
    folders = list(folders)
    names = scratch.for_each(lambda folder: scratch.folder_names(spark, folder), folders)
    return [folder for folder, found in zip(folders, names) if sum(name.startswith("run=0-") for name in found) >= fan]


def merge_due(
    spark: SparkSession,
    folder: str,
    schema: str,
    fan: int,
    order: str,
    fold: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Merges level after level while one has ``fan`` runs; ``fold`` may join rows of several batches."""
    levels: dict[int, list[Run]] = defaultdict(list)
    for run in listed(spark, folder):
        levels[run.level].append(run)
    level = 0
    while len(levels[level]) >= fan:
        merged = levels.pop(level)
        first, last = min(run.first for run in merged), max(run.last for run in merged)
        size = sum(run.bytes for run in merged)
        path = f"{folder}/run={run_name(level + 1, first, last)}"
        rows = fold(read(spark, merged, schema)).repartitionByRange(max(-(-size // RUN_FILE_BYTES), 1), order)
        rows.sortWithinPartitions(order).write.mode("overwrite").parquet(path)
        for run in merged:
            scratch.delete_folder(spark, run.path)
        levels[level + 1].append(Run(level + 1, first, last, path, size))
        level += 1
