"""Actors: from an id or a login to {id, author_type}, and who is referenced."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from prflow.functions import scalars as S
from prflow.operators.flatten import join_lists
from prflow.operators.joins import lookup_join


def actor_types(pages: DataFrame) -> DataFrame:
    """(actor_id, author_type) from landed node-type pages, one row per id. An
    id whose node is NULL or of an unknown type is UNKNOWN and keeps its id."""
    return pages.groupBy(F.col("request_id").alias("actor_id")).agg(
        S.actor_type(F.max("body.data.node.__typename")).alias("author_type")
    )


def login_matches(pages: DataFrame) -> DataFrame:
    """(login, actor_id) from landed user-search pages, one row per login.

    A hit counts only when its login equals the searched one exactly, case
    included; hits without a login are ignored. The first in page order wins.
    The equality is applied inside the array, so the near misses of a search
    (up to a whole page) are never exploded or shuffled."""
    exact = F.filter(
        F.transform(
            F.col("body.data.search.nodes"),
            lambda node, pos: F.struct(
                F.col("page_no").alias("page_no"),
                pos.alias("pos"),
                node["id"].alias("id"),
                node["login"].alias("login"),
            ),
        ),
        lambda hit: hit["login"] == F.col("request_id"),
    )
    return (
        pages.select("request_id", F.try_element_at(exact, F.lit(1)).alias("hit"))
        .filter(F.col("hit").isNotNull())
        .groupBy(F.col("request_id").alias("login"))
        .agg(F.min("hit").alias("hit"))
        .select("login", F.col("hit.id").alias("actor_id"))
    )


def resolve_by_id(
    rows: DataFrame,
    actor_id: Column,
    types: DataFrame,
    name: str,
    spread: Sequence[str | Column],
    counted: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Add actor column ``name`` for an actor known by id. An id without a
    landed type is UNKNOWN; no id at all is the nobody actor. ``counted`` is a
    cheaper frame to find the most frequent actors in."""
    joined = lookup_join(
        rows.withColumn("_actor_id", actor_id),
        types.select(F.col("actor_id").alias("_actor_id"), "author_type"),
        ["_actor_id"],
        spread,
        counted=None if counted is None else counted.select(actor_id.alias("_actor_id")),
        **options,
    )
    found = S.actor(
        F.col("_actor_id"), F.coalesce(F.col("author_type"), F.lit(S.UNKNOWN))
    )
    return joined.withColumn(
        name, F.when(F.col("_actor_id").isNotNull(), found).otherwise(S.unknown_actor())
    ).drop("_actor_id", "author_type")


def resolve_by_login(
    rows: DataFrame,
    login: Column,
    matches: DataFrame,
    name: str,
    spread: Sequence[str | Column],
    counted: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Add actor column ``name`` for an actor known by login. A login nobody
    matched becomes the id of an UNKNOWN actor; no login is the nobody actor."""
    joined = lookup_join(
        rows.withColumn("_login", login),
        matches.select(F.col("login").alias("_login"), F.col("actor_id").alias("_found")),
        ["_login"],
        spread,
        counted=None if counted is None else counted.select(login.alias("_login")),
        **options,
    )
    return joined.withColumn(
        name,
        F.when(F.col("_found").isNotNull(), S.actor(F.col("_found"), F.lit(S.USER))).otherwise(
            S.unresolved_actor(F.col("_login"))
        ),
    ).drop("_login", "_found")


def resolve_in_lists(
    lists: DataFrame,
    keys: Sequence[str],
    known_by: Callable[[Column], Column],
    resolve: Callable[[DataFrame], DataFrame],
    item: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Lists ``(keys, segment, items)`` with the actors of their items.

    Only what an actor is ``known_by`` leaves the list: places and names are
    joined to the lookup (``resolve`` adds ``actor`` to rows with ``known``) and
    come back as one array per list row, in order. ``item(old, actor)`` makes
    the new item; without it the items are the actors, and the old lists are
    not needed again."""
    places = lists.select(
        *keys, "segment", F.posexplode(F.transform("items", known_by)).alias("pos", "known")
    )
    resolved = resolve(places).groupBy(*keys, "segment").agg(
        F.array_sort(F.collect_list(F.struct("pos", "actor"))).alias("found")
    )
    found = resolved.select(*keys, "segment", F.col("found")["actor"].alias("actors"))
    if item is None:
        return found.withColumnRenamed("actors", "items")
    joined = join_lists(lists, found, keys, "inner")
    return joined.withColumn("items", F.zip_with("items", "actors", item)).drop("actors")


def referenced_users(df: DataFrame, *actors: str, keep: Sequence[str] = ()) -> DataFrame:
    """Ids of the USER actors in the named actor columns, arrays of actors
    included, in one scan, with the columns to ``keep``. Not yet distinct."""
    kinds = df.select(*[F.col(path).alias(f"c{i}") for i, path in enumerate(actors)]).schema

    def as_array(path: str, kind) -> Column:
        if isinstance(kind, ArrayType):
            return F.coalesce(F.col(path), F.array().cast(kind))
        return F.array(path)

    if len(actors) == 1 and not isinstance(kinds[0].dataType, ArrayType):
        found = df.select(*keep, F.col(actors[0]).alias("actor"))
    else:
        every = F.concat(*[as_array(path, f.dataType) for path, f in zip(actors, kinds)])
        found = df.select(*keep, F.explode(every).alias("actor"))
    return found.filter(F.col("actor.author_type") == S.USER).select(
        *keep, F.col("actor.id").alias("id")
    )


def distinct_ids(*references: DataFrame) -> DataFrame:
    """Distinct non-NULL ids of several one-column frames. Repeats collapse
    map-side, so a much-referenced id is not gathered."""
    union = reduce(DataFrame.unionAll, references)
    return union.filter(F.col("id").isNotNull()).distinct()


def document_users(
    documents: DataFrame,
    lists: dict[str, DataFrame],
    actors: Sequence[str] = ("author",),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Distinct user ids a document type refers to: its actor columns (author,
    committer) and the actors in its list tables (participants, edits,
    reactions, authors)."""
    inside = {"edits": "items.editor", "reactions": "items.author"}
    references = [referenced_users(documents, *actors, keep=keep)]
    references += [
        referenced_users(table, inside.get(field, "items"), keep=keep)
        for field, table in lists.items()
    ]
    return distinct_ids(*references)
