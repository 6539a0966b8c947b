"""The corpus pipeline: documents through five stages of the training-data operators.

Each stage is written as Parquet and read again by the next one. What runs here
is DataFrame code; the operators are in prflow.llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prflow.llm import decontaminate, lines, mixing, quality, simhash
from prflow.llm.common import table, written
from prflow.llm.queries import in_turn


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that break no rule."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without lines that an earlier line repeats."""
    return lines.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The first document of each group of near copies."""
    return simhash.keep_first(docs, shingle=3, bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, folder, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix: each document once for each of its repetitions."""
    return mixing.mixed_documents(docs, in_turn())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to weights", mixing_to_weights),
]

# SimHash majorities, latent vectors and connected components have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if i + 1 < len(STAGES):
            docs = written(docs, "stage")
    return docs
