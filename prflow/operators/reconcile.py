"""Declared counts against loaded counts: per parent, per repository, and
through the graph of steps. All sums are combined map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prflow.functions import scalars as S

_REPOSITORY = "repository_id"


# -- per parent -------------------------------------------------------------


def list_size(lists: DataFrame) -> Column:
    """Items of a list row; the number stored beside them, where there is one."""
    return F.col("n_items") if "n_items" in lists.columns else F.size("items")


def list_counts(lists: DataFrame) -> DataFrame:
    """Items per parent, over all its segments."""
    return lists.groupBy(F.col("parent_id").alias("id")).agg(
        F.sum(list_size(lists).cast("long")).alias("loaded")
    )


def child_counts(children: DataFrame, parent: str) -> DataFrame:
    """Child documents per parent."""
    return (
        children.groupBy(F.col(parent).alias("id"))
        .agg(F.count(F.lit(1)).alias("loaded"))
        .filter(F.col("id").isNotNull())
    )


def with_loaded(parents: DataFrame, counts: DataFrame) -> DataFrame:
    """Parents with ``loaded``, 0 where nothing was loaded."""
    return parents.join(counts, "id", "left").withColumn(
        "loaded", F.coalesce(F.col("loaded"), F.lit(0).cast("long"))
    )


def incomplete_parents(parents: DataFrame, declared: str, counts: DataFrame) -> DataFrame:
    """Parents that declare more than was loaded."""
    return with_loaded(parents, counts).filter(F.col(declared) > F.col("loaded"))


def commit_load_status(parents: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, commit_id_load_status) of parents whose commit lists were fetched."""
    return with_loaded(parents, counts).select(
        "id",
        S.load_status(F.col("total_commits"), F.col("loaded")).alias("commit_id_load_status"),
    )


# -- per repository ---------------------------------------------------------


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value.cast("long")), F.lit(0).cast("long"))


def documents_per_repository(documents: DataFrame) -> DataFrame:
    return documents.groupBy(_REPOSITORY, "object_type").agg(F.count(F.lit(1)).alias("documents"))


def expected_totals(documents: DataFrame, /, *declared: str, **more: Column) -> DataFrame:
    """Sums per repository, all in one pass: declared counts by name, and any
    further columns to sum."""
    return documents.groupBy(_REPOSITORY).agg(
        *[_sum(F.col(d)).alias(d) for d in declared],
        *[_sum(value).alias(name) for name, value in more.items()],
    )


def actual_list_totals(lists: DataFrame, name: str = "actual") -> DataFrame:
    return lists.groupBy(_REPOSITORY).agg(_sum(list_size(lists)).alias(name))


def actual_child_totals(children: DataFrame, name: str = "actual") -> DataFrame:
    return children.groupBy(_REPOSITORY).agg(F.count(F.lit(1)).alias(name))


def counted_commits() -> Column:
    """What a parent's loaded commits count as: its declared total when the API
    is known to return fewer."""
    return F.when(
        F.col("commit_id_load_status") == S.GIT_RETURNED_LESS, F.col("total_commits")
    ).otherwise(F.col("loaded"))


def actual_commit_totals(parents: DataFrame, counts: DataFrame, name: str = "actual") -> DataFrame:
    return with_loaded(parents, counts).groupBy(_REPOSITORY).agg(_sum(counted_commits()).alias(name))


def global_totals(documents: DataFrame, declared: str, lists: DataFrame) -> DataFrame:
    """Expected and actual over all repositories, as one row."""
    expected = documents.agg(_sum(F.col(declared)).alias("expected"), F.lit(0).cast("long").alias("actual"))
    actual = lists.agg(F.lit(0).cast("long").alias("expected"), _sum(list_size(lists)).alias("actual"))
    return expected.unionByName(actual).agg(
        F.sum("expected").alias("expected"), F.sum("actual").alias("actual")
    )


def mismatched_parents(parents: DataFrame, declared: str, counts: DataFrame) -> DataFrame:
    """Parents per repository whose own counts differ. Sums can agree while an
    excess in one parent hides a shortage in another; this shows it."""
    return (
        with_loaded(parents, counts)
        .groupBy(_REPOSITORY)
        .agg(F.count_if(F.col(declared) != F.col("loaded")).alias("mismatched"))
    )


def sides(totals: DataFrame, /, **columns: Sequence[tuple[int, str]]) -> DataFrame:
    """Totals per repository as report rows (repository_id, step, expected,
    actual). Each column names the (step, side) it counts for, so one pass over
    a table serves every step about it."""
    zero = F.lit(0).cast("long")
    rows = [
        F.struct(
            F.lit(step).alias("step"),
            (F.col(column).cast("long") if side == "expected" else zero).alias("expected"),
            (F.col(column).cast("long") if side == "actual" else zero).alias("actual"),
        )
        for column, targets in columns.items()
        for step, side in targets
    ]
    return totals.select(_REPOSITORY, F.inline(F.array(*rows)))


def step_report(
    parts: Sequence[DataFrame], repositories: DataFrame, steps: Sequence[int]
) -> DataFrame:
    """(step, repository_id, expected, actual, ok) for every step and every
    repository in scope, also where there is nothing to load. The parts are a
    few rows per repository already, so a union and a sum join them."""
    zero = F.lit(0).cast("long")
    every = repositories.select(
        F.col("id").alias(_REPOSITORY),
        F.explode(F.array(*[F.lit(s) for s in steps])).alias("step"),
        zero.alias("expected"),
        zero.alias("actual"),
    )
    return (
        reduce(DataFrame.unionByName, parts, every)
        .groupBy("step", _REPOSITORY)
        .agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
        .withColumn("ok", F.col("expected") == F.col("actual"))
    )


def missing_report(missing: DataFrame, steps: Sequence[int]) -> DataFrame:
    """Report rows of wanted repositories (owner, name) that are not stored:
    one is expected in step 1 and none is there; the other steps have nothing
    to count yet, and depend on step 1."""
    first = (F.col("step") == 1).cast("long")
    return missing.select(
        "owner", "name", F.explode(F.array(*[F.lit(s) for s in steps])).alias("step")
    ).select(
        F.lit(None).cast("string").alias(_REPOSITORY), "owner", "name", "step",
        first.alias("expected"), F.lit(0).cast("long").alias("actual"), (first == 0).alias("ok"),
    )


# -- through the graph ------------------------------------------------------


def upstream(parents: Mapping[int, Sequence[int]]) -> list[tuple[int, int]]:
    """(step, step it depends on, itself included), directly or indirectly."""
    pairs: set[tuple[int, int]] = set()
    for step in sorted(parents):
        pending, seen = [step], set()
        while pending:
            current = pending.pop()
            if current not in seen:
                seen.add(current)
                pending.extend(parents[current])
        pairs.update((step, dependency) for dependency in seen)
    return sorted(pairs)


def recursive_report(
    spark: SparkSession,
    report: DataFrame,
    parents: Mapping[int, Sequence[int]],
    global_steps: Sequence[int] = (),
) -> DataFrame:
    """A step is done for a repository only if it and all steps it depends on
    are. A dependency without a report row is not done. Global steps (reported
    once, without a repository) need their dependencies in every repository.
    Repositories are told apart by id, and by owner and name if the report has
    them, so that those without an id are not taken for one."""
    pairs = upstream(parents)
    needs = {step: sum(1 for s, _ in pairs if s == step) for step in parents}
    # the step graph is a parameter: some dozen steps, a few hundred pairs
    graph = F.broadcast(
        spark.createDataFrame(
            [(step, needed, needs[step], step in global_steps) for step, needed in pairs],
            "step int, needs int, needed long, is_global boolean",
        )
    )
    # every row is sent to the steps that need it (itself included), so the
    # report is computed once; rows for a global step meet in one group, which
    # counts a dependency when every repository has it
    own = F.when(F.col("needs") == F.col("for_step"), F.struct(*[F.col(c) for c in report.columns]))
    named = [c for c in (_REPOSITORY, "owner", "name") if c in report.columns]
    local = [F.when(~F.col("is_global"), F.col(c)).alias(f"for_{c}") for c in named]
    per_repository = [f"for_{c}" for c in named]
    sent = report.join(graph.withColumnRenamed("step", "for_step"), F.col("step") == F.col("needs"))
    return (
        sent.groupBy(
            "for_step",
            "needs",
            "needed",
            *local,
        )
        .agg(F.bool_and("ok").alias("met"), F.max(own).alias("own"))
        .groupBy("for_step", "needed", *per_repository)
        .agg(F.count_if("met").alias("met"), F.max("own").alias("own"))
        .filter(F.col("own").isNotNull())
        .select("own.*", (F.col("met") == F.col("needed")).alias("ok_recursive"))
    )
