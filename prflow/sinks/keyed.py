"""Keyed writes as DataFrame results: insert if absent, set fields, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_versions(
    incoming: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row per key. Spark limits each map task to one row per key
    before the shuffle, so many copies of one key are not gathered."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return (
        incoming.withColumn("_place", F.row_number().over(place))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def rows_to_insert(
    stored: DataFrame,
    incoming: DataFrame,
    order: Sequence[str | Column],
    keys: Sequence[str] = ("id",),
    small_increment: bool = False,
) -> DataFrame:
    """Incoming rows whose key is not stored yet, the first version of each.

    With ``small_increment`` the stored keys are first cut down to those that
    occur in the increment: a small increment is then broadcast to the scan of
    the stored table, which is not shuffled."""
    keys = list(keys)
    known = stored.select(*keys)
    if small_increment:
        known = known.join(incoming.select(*keys).distinct(), keys, "left_semi")
    return first_versions(incoming, keys, order).join(known, keys, "left_anti")


def insert_if_absent(
    stored: DataFrame,
    incoming: DataFrame,
    order: Sequence[str | Column],
    keys: Sequence[str] = ("id",),
) -> DataFrame:
    """The table after the insert. The stored version always wins."""
    new = rows_to_insert(stored, incoming, order, keys)
    return stored.unionByName(new.select(*stored.columns))


def set_fields(
    target: DataFrame, updates: DataFrame, fields: Sequence[str], key: str = "id"
) -> DataFrame:
    """Set ``fields`` of the rows ``updates`` names, leave everything else.

    ``updates`` has one row per key. A matched row takes the new value even if
    that is NULL. Fields the target does not have yet are added, NULL where
    never set."""
    new = updates.select(key, F.struct(*fields).alias("_new"))
    joined = target.join(new, key, "left")
    matched = F.col("_new").isNotNull()
    kept = [
        F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in target.columns
    ]
    added = [F.col(f"_new.{c}").alias(c) for c in fields if c not in target.columns]
    return joined.select(*kept, *added)


def without_replaced(rows: DataFrame, replaced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys no later load has replaced. Few keys are ever replaced,
    so this is a broadcast beside the scan of the rows."""
    return rows.join(replaced.select(*keys), list(keys), "left_anti")


def upsert_repositories(stored: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """New repositories get both stamps; known ones only a new count and update
    stamp, and keep their id and insert stamp. ``now`` is passed in, so a rerun
    gives the same result. Key is (owner, name)."""
    keys = ["owner", "name"]
    new = first_versions(incoming, keys, ["id", "total_pull_requests"]).select(
        *keys,
        F.struct("id", "total_pull_requests").alias("_new"),
    )
    old = stored.select(*keys, F.struct(*stored.columns).alias("_old"))
    is_new = F.col("_new").isNotNull()
    return old.join(new, keys, "full_outer").select(
        F.coalesce("_old.id", "_new.id").alias("id"),
        "name",
        "owner",
        F.when(is_new, F.col("_new.total_pull_requests"))
        .otherwise(F.col("_old.total_pull_requests"))
        .alias("total_pull_requests"),
        F.when(F.col("_old").isNull(), now).otherwise(F.col("_old.insert_timestamp")).alias(
            "insert_timestamp"
        ),
        F.when(is_new, now).otherwise(F.col("_old.update_timestamp")).alias("update_timestamp"),
        F.lit("REPOSITORY").alias("object_type"),
    )
