"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prflow.llm.common import boxed, n_words, same_document, text_key, written

BUCKETS = 4096  # hash buckets of a source: the grain of fractional repetitions
FILL_PASSES = 3


def source_sizes(sized: DataFrame) -> DataFrame:
    """``(source, source_size, rank)``: rank by code point, null last.

    Ranks come from range partitions and the counts before them, so no task
    sees all sources; only one count per partition is added up in one place.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = written(
        per.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "sources",
    )
    before = placed.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    ranked = placed.join(before, "part").select(
        "source", "source_size", (F.col("before") + inside).alias("rank")
    )
    return written(ranked, "ranks")


def water_fill(sources: DataFrame, share: float = 1.0, max_epochs: float = 3.0) -> DataFrame:
    """``sources`` (source_size, weight, ...) with ``target``.

    The total is shared by weight; who exceeds max_epochs times its size stops
    there, and what is left is shared again by weight among the others. Only
    two sums come to the driver per round, and each round stops at least one
    more source or ends; with nobody left (or share over max_epochs) every
    source stays at its cap."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > cap
        fixed, open_weight, n_full = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.sum(full.cast("long")),
        ).first()
        if not open_weight:
            break
        raised = (total - (fixed or 0.0)) / open_weight
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _chosen(buckets: DataFrame) -> DataFrame:
    """Buckets whose documents get one repetition more.

    In hash order, buckets are taken as long as they fit into what is left;
    the next passes fill the rest with buckets that are small enough. The
    order is by hash, so it favours no document. A source has at most BUCKETS
    rows here, whatever its number of documents."""
    now = buckets.withColumn("left", F.col("wanted")).withColumn("taken", F.lit(False))
    for _ in range(FILL_PASSES):
        fits = ~F.col("taken") & (F.col("bucket_size") <= F.col("left"))
        order = Window.partitionBy("rank").orderBy("bucket")
        run = F.sum(F.when(fits, F.col("bucket_size")).otherwise(0)).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        now = now.withColumn("now", fits & (run <= F.col("left")))
        used = F.sum(F.when(F.col("now"), F.col("bucket_size")).otherwise(0)).over(Window.partitionBy("rank"))
        now = now.withColumn("left", F.col("left") - used).withColumn(
            "taken", F.col("taken") | F.col("now")
        ).drop("now")
    return now.filter("taken").select("rank", "bucket")


def mix(
    docs: DataFrame, weight: Column, share: float = 1.0, max_epochs: int = 3, seed: int = 42,
    text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """One row per input row: ``doc_id, key, size, source, source_size, weight,
    target, copies``; ``copies`` says how often the mix repeats the document.

    ``weight`` is an expression over ``source`` and ``rank`` (1 for the first
    source by code point, a null source is the last). A source's ratio of
    target to size gives whole repetitions of all its documents and one more
    for a seeded share of them; no document gets more than max_epochs. Sizes
    are words; null and empty texts have size 0, and so has a source of such
    texts, whose target is 0. Rows equal in id and text fall into one bucket.
    An empty table gives an empty result; other columns are not looked at.

    A hot source is spread over BUCKETS hash buckets before its rows meet.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"), text_key(F.col(text)).alias("key"),
    )
    sized = written(sized.withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("key")), F.lit(BUCKETS)).cast("int")
    ), "sizes")
    sources = source_sizes(sized).withColumn("weight", weight.cast("double"))
    filled = written(water_fill(sources, share, max_epochs), "targets")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    plan = filled.withColumn("whole", F.least(F.floor(ratio), F.lit(max_epochs)).cast("long"))
    plan = plan.withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
    per_bucket = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    named = per_bucket.join(
        plan.filter("whole < " + str(max_epochs)), per_bucket["source"].eqNullSafe(plan["source"])
    ).select("rank", "bucket", "bucket_size", "wanted")
    more = _chosen(named).withColumn("extra", F.lit(1))
    # the plan of a bucket, so that a hot source joins in BUCKETS pieces
    deal = per_bucket.select(F.col("source").alias("s"), F.col("bucket").alias("b")).join(
        plan, F.col("s").eqNullSafe(plan["source"])
    ).select("s", "b", "rank", "source_size", "weight", "target", "whole")
    deal = deal.join(
        more.select(F.col("rank").alias("r"), F.col("bucket").alias("rb"), "extra"),
        (F.col("rank") == F.col("r")) & (F.col("b") == F.col("rb")), "left",
    )
    return sized.join(deal, sized["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select(
        "doc_id", "key", "size", "source", "source_size", "weight", "target",
        (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"),
    )


def mixed_documents(docs: DataFrame, weight: Column, seed: int = 42, max_epochs: int = 3) -> DataFrame:
    """The rows of the mix: each document, with its columns untouched, once for
    each of its repetitions. The documents are not shuffled by source."""
    copies = mix(docs, weight, seed=seed, max_epochs=max_epochs).filter("copies > 0")
    copies = copies.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "copies").distinct()
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("i")
    return boxed(docs).join(copies, same_document("d", "k")).select("row", times).select("row.*")
