"""Joins that survive a key which holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is heavy: about what one task should get. Its
# rows are dealt over as many salts as it has times this many. So of N rows
# there are at most N / HEAVY_ROWS heavy keys (the only table that is broadcast
# by a hint: 250,000 keys for 10^12 rows) and their lookup rows are repeated at
# most 2 N / HEAVY_ROWS times; no key is passed over.
HEAVY_ROWS = 4_000_000


def heavy_keys(rows: DataFrame, on: Sequence[str], heavy_rows: int | None = None) -> DataFrame:
    """The keys with many rows, and over how many salts each is dealt. Counts
    are combined map-side and only the key columns are read, so the hot key
    itself is never gathered."""
    most = HEAVY_ROWS if heavy_rows is None else heavy_rows
    counted = rows.select(*on).dropna().groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter(F.col("_rows") > most).select(*on, F.ceil(F.col("_rows") / most).cast("int").alias("_salts"))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate is under its broadcast limit, in
    which case it broadcasts by itself and a hot key needs no treatment."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = plan.queryExecution().optimizedPlan().stats().sizeInBytes()
    return 0 <= int(str(estimate)) <= int(limit)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Sequence[str | Column],
    how: str = "left",
    heavy_rows: int | None = None,
    force: bool = False,
    counted: DataFrame | None = None,
    together: bool = False,
) -> DataFrame:
    """Join many ``rows`` to a ``lookup`` that has one row per key.

    A lookup too large to broadcast is joined by shuffle, with the heavy keys
    salted: their rows are spread by ``spread`` (columns that differ within a
    key) and by the input split, so that copies of one row part ways too; only
    the few lookup rows of heavy keys are repeated. Rows whose key is NULL match
    nothing and are spread as well. A retried task keeps its split number, so
    it repeats the same salts. ``how`` is ``left``, ``inner`` or ``left_semi``.

    ``counted`` may be a cheaper frame with at least the keys of ``rows`` to
    find the heavy keys in, such as the same pages before they were joined; a
    key salted needlessly or over other salts does no harm.

    With ``together`` rows that are equal in ``spread`` are not parted, and the
    result keeps its ``_salt`` (0 where nothing is salted): it is partitioned by
    the key and ``_salt``, and grouping by these and more needs no exchange.
    """
    on = list(on)
    if not force and fits_broadcast(lookup):
        joined = rows.join(lookup, on, how)
        return joined.withColumn("_salt", F.lit(0).cast("long")) if together else joined
    heavy = F.broadcast(heavy_keys(rows if counted is None else counted, on, heavy_rows))
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    parted = [] if together else [F.spark_partition_id()]
    dealt = F.xxhash64(*parted, *spread)
    salt = F.when(has_null, dealt).when(F.col("_salts").isNotNull(), F.pmod(dealt, F.col("_salts")))
    salted_rows = rows.join(heavy, on, "left").withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("long")).drop("_salts")
    each = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_salts") - 1, F.lit(0)).cast("long"))
    salted_lookup = lookup.join(heavy, on, "left").withColumn("_salt", F.explode(each)).drop("_salts")
    joined = salted_rows.join(salted_lookup, [*on, "_salt"], how)
    return joined if together else joined.drop("_salt")


def inherit_parent_keys(
    rows: DataFrame,
    parents: DataFrame,
    inherited: dict[str, str],
    spread: Sequence[str | Column] = ("page_no",),
    **options,
) -> DataFrame:
    """Give pages (or edges) the keys of the parent they were requested for.

    ``inherited`` maps a parent column to its name on the child. Rows whose
    parent is not stored are dropped."""
    keys = parents.select(
        F.col("id").alias("request_id"),
        *[F.col(column).alias(name) for column, name in inherited.items()],
    )
    return lookup_join(rows, keys, ["request_id"], spread=spread, how="inner", **options)
