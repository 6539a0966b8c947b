"""What is referenced but not stored, and what was asked for but not found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.operators.actors import distinct_ids


def unsaved(references: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct referenced ids that no stored document has. Repeats are removed
    before the anti join, so neither side has a hot key."""
    return distinct_ids(references).join(stored.select("id"), "id", "left_anti")


def ids_in_lists(lists: DataFrame) -> DataFrame:
    return lists.select(F.explode("items").alias("id"))


def ids_in_column(documents: DataFrame, column: str) -> DataFrame:
    return documents.select(F.col(column).alias("id"))


def referenced_organizations(
    users: DataFrame, user_organizations: DataFrame, commits: DataFrame
) -> DataFrame:
    """Organization ids: from users who declare any, and from commits made on
    behalf of one."""
    declaring = users.filter(F.col("total_organizations") > 0).select("id")
    from_users = ids_in_lists(
        user_organizations.join(declaring, user_organizations.parent_id == declaring.id, "left_semi")
    )
    from_commits = ids_in_column(commits, "for_organization_id")
    return distinct_ids(from_users, from_commits)


def not_found(requested: DataFrame, nodes: DataFrame, key: str = "id") -> DataFrame:
    """Requested ids for which no node was returned."""
    return requested.select("id").distinct().join(
        nodes.select(F.col(key).alias("id")), "id", "left_anti"
    )


def unsaved_count(
    references: DataFrame, stored: DataFrame, known_missing: DataFrame | None = None
) -> DataFrame:
    """One row: how many referenced ids are still unsaved; 0 when all are
    stored. Ids the API has answered "not found" for are not counted."""
    remaining = unsaved(references, stored)
    if known_missing is not None:
        remaining = remaining.join(known_missing.select("id"), "id", "left_anti")
    return remaining.agg(F.count(F.lit(1)).alias("unsaved"))
