"""Resumable ingest: landed pages as a stream, each document stored once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from prflow import schemas
from prflow.plans.store import Store
from prflow.sources.pages import ACCEPTED, classify_pages, page_folder

# Which version of a document is the first.
ORDER = ("landed_at", "page_no", "pos")


def _table(shape: str) -> str:
    return f"ingested/{shape}"


def ingested(spark: SparkSession, target: str, shape: str, schema: StructType) -> DataFrame:
    """Documents stored by ``ingest_stream``; ``schema`` is theirs."""
    store = Store(spark, target)
    whole = StructType([*schema.fields, *[StructField(c, LongType()) for c in ORDER]])
    return store._rows(_table(shape), whole, "id", store.version(_table(shape))).select(*schema.names)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    shape: str,
    to_documents: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    max_files: int = 1_000,
):
    """Load what has landed since the last run, then stop.

    The checkpoint remembers which files were read, and the target keeps for
    each id the version that landed first (ties: page and place in it), with
    the columns that tell. So a rerun, a replayed micro-batch or a page landed
    twice adds nothing, and the result does not depend on how many files a
    micro-batch takes or in which order they come. A micro-batch reads the
    buckets of its own ids. ``to_documents`` turns accepted pages into
    documents with ``page_no`` and ``pos``, and ``landed_at`` if that counts.
    Returns the finished query."""
    store = Store(spark, target)

    def put(batch: DataFrame, _: int) -> None:
        # read twice below (ids, then rows); a lost executor only recomputes it
        batch.persist()
        try:
            rows = to_documents(batch)
            given = {c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) if c in rows.columns else F.lit(0).cast("long") for c in ORDER}
            plain = [c for c in rows.columns if c not in ORDER]
            store.put_first(_table(shape), rows.withColumns(given).select(*plain, *ORDER), ORDER)
        finally:
            batch.unpersist()

    pages = (
        spark.readStream.schema(schemas.page_schema(shape))
        .option("maxFilesPerTrigger", max_files)
        .json(page_folder(landing, shape))
    )
    accepted = classify_pages(pages).filter(F.col("outcome") == ACCEPTED).drop("outcome")
    query = (
        accepted.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
