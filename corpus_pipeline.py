"""A training-data pipeline over documents: toxicity, line de-duplication, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticklake.llm import best_fit, line_variants, simhash_pivots, toxicity_trees
from ticklake.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels of this corpus, does not reject."""
    return toxicity_trees.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document, or an earlier place, has already."""
    return line_variants.without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash, the one with the smallest id.

    Four-word shingles, fingerprints of 64 bits, at most 4 of them different.
    """
    return simhash_pivots.kept_documents(docs, simhash_pivots.DOCUMENTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return best_fit.packing(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: Model scores and packing plans are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
