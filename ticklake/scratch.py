"""Folders for data a job writes and reads back.

They lie below ``spark.checkpoint.dir``, the shared folder the cluster names, so every
executor sees them and a lost executor loses nothing.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

#: Folders that are looked at together.
LISTED_AT_ONCE = 16


def shared_root(spark: SparkSession) -> str:
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    # One process only, as in tests: local-cluster has executors of its own.
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return tempfile.gettempdir()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody used before, removed when the driver's JVM ends."""
    path = f"{shared_root(spark)}/ticklake/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(jvm_path)
    file_system.deleteOnExit(jvm_path)
    return path


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows computed once and kept in the shared folder, for plans that read them twice."""
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(new_folder(spark, "checkpoint"))
    return rows.checkpoint()


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def folder_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and bytes of the folders inside ``path``; one listing of it, and one of each folder."""
    file_system, folder = _file_system(spark, path)
    if not file_system.exists(folder):
        return {}
    found = [status.getPath() for status in file_system.listStatus(folder) if status.isDirectory()]
    return {child.getName(): file_system.getContentSummary(child).getLength() for child in found}


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside ``path``, from one listing of it."""
    file_system, folder = _file_system(spark, path)
    if not file_system.exists(folder):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(folder) if status.isDirectory()]


def for_each[A, B](look: Callable[[A], B], things: Iterable[A]) -> list[B]:
    """What ``look`` finds in the file system for each thing, in their order, several at a time.

    The wait for the file system is most of it; one after the other, a batch of thousands of days would wait for minutes.
    """
    with ThreadPoolExecutor(LISTED_AT_ONCE) as pool:
        return list(pool.map(look, things))


def exists(spark: SparkSession, path: str) -> bool:
    file_system, folder = _file_system(spark, path)
    return file_system.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    file_system, folder = _file_system(spark, path)
    file_system.mkdirs(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    file_system, folder = _file_system(spark, path)
    file_system.delete(folder, True)
