"""Helpers of the training-data operators: words, row identity, written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prflow.plans.files import Files
from prflow.session import new_work_folder

# The word of every contract: a run without space, tab, newlines, \v, \f.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# Shuffle files of a finished execution are removed.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, so a lost
    executor costs a reread and not the work before. Once the table is there
    nothing reads the shuffle files it was made from, so they go at once and do
    not fill the disks until the driver's garbage collection finds them."""
    spark = frame.sparkSession
    folder = new_work_folder(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete work tables that nothing reads any more: the shared folder then
    holds what later steps need, and not all that was ever written."""
    for table in tables:
        files = Files(table.sparkSession)
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            files.delete(folder)


def words(text: Column) -> Column:
    """Words of a text; none for null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.filter(parts, lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, not once per use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_key(text: Column) -> Column:
    """With the id this tells rows apart; rows equal in both count as one
    document and get one decision."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def boxed(docs: DataFrame) -> DataFrame:
    """Rows as one column ``row``, so that no column's name clashes in a join;
    ``row.*`` gives them back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def same_document(doc_id: str, key: str) -> Column:
    """A boxed row is the document that the two columns name."""
    return F.col("row.doc_id").eqNullSafe(F.col(doc_id)) & (text_key(F.col("row.text")) == F.col(key))
