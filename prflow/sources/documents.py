"""Stored documents: scans, repository lookups and the list of repositories
one run is about."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prflow.operators.joins import lookup_join


def documents_of(documents: DataFrame, repository_id: str | None = None, **equal: str) -> DataFrame:
    """Documents with the given repository and field values (all, when none
    are given). Plain equalities, so they are pushed into the parquet scan."""
    conditions = dict(equal)
    if repository_id is not None:
        conditions["repository_id"] = repository_id
    for column, value in conditions.items():
        documents = documents.filter(F.col(column) == value)
    return documents


def repositories_df(spark: SparkSession, repositories: Iterable[Mapping[str, str]]) -> DataFrame:
    """The (owner, name) pairs a run is about, in the order given. This is a
    parameter of the run, not data; duplicates are removed."""
    pairs: dict[tuple[str, str], int] = {}
    for place, r in enumerate(repositories):
        pairs.setdefault((r["owner"], r["name"]), place)
    rows = [(owner, name, place) for (owner, name), place in pairs.items()]
    return spark.createDataFrame(rows, "owner string, name string, place long")


def lookup_repository(repositories: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored repositories that are wanted, as (id, owner, name, total)."""
    return (
        repositories.select("id", "owner", "name", "total_pull_requests")
        .join(wanted.select("owner", "name").distinct(), ["owner", "name"], "left_semi")
        .select("id", "owner", "name", "total_pull_requests")
    )


def repository_exists(repositories: DataFrame, wanted: DataFrame) -> DataFrame:
    """(owner, name, is_stored) for every wanted pair."""
    stored = repositories.select("owner", "name").distinct().withColumn("_stored", F.lit(True))
    return (
        wanted.select("owner", "name")
        .distinct()
        .join(stored, ["owner", "name"], "left")
        .select("owner", "name", F.coalesce("_stored", F.lit(False)).alias("is_stored"))
    )


def in_scope(documents: DataFrame, scope: DataFrame) -> DataFrame:
    """Documents of the repositories in scope, all of them in one job.

    A repository may hold a large share of all documents, so the join is by a
    broadcast of the scope when it is small and by salted keys when not."""
    ids = scope.select(F.col("id").alias("repository_id")).distinct()
    return lookup_join(documents, ids, ["repository_id"], spread=["id"], how="left_semi")
