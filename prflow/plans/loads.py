"""What each loading step computes, from DataFrames to DataFrames.

Steps of the same kind are one function with the document type's names as
parameters. Nothing here reads or writes; ``run`` does. Parents are documents
of all repositories in scope, so one job serves them all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prflow import schemas
from prflow.functions import scalars as S
from prflow.operators import actors, discover, flatten, project, reconcile
from prflow.operators.joins import fits_broadcast, inherit_parent_keys, lookup_join
from prflow.sinks import keyed
from prflow.sources.pages import PLACE

_SPREAD = ["request_id", "page_no", "pos"]


class Children(NamedTuple):
    """New child documents, and the id lists of the parents loaded now."""

    documents: DataFrame
    ids: DataFrame


# -- shared parts -----------------------------------------------------------


def edges_of_parents(
    pages: DataFrame,
    shape: str,
    parents: DataFrame,
    inherited: dict[str, str],
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Edges of the pages that belong to the given parents, with their keys.
    Pages are joined before they are exploded (a hundredth of the rows) and
    after they are cut down to the node ``fields`` in use."""
    path = schemas.CONNECTION_PATHS[shape]
    taken = flatten.take_edges(pages, path, fields=fields)
    owned = inherit_parent_keys(taken, parents, inherited)
    return flatten.explode_edges(owned, [*flatten.ENVELOPE, *inherited.values()], fields)


def actors_seen(pages: DataFrame, shape: str, *fields: str) -> DataFrame:
    """The actor fields of all edges of the pages, before any join: where the
    most frequent actors are counted."""
    path = schemas.CONNECTION_PATHS[shape]
    return flatten.flatten_connection(pages, path, ["request_id"], fields)


_LIST = ["repository_id", "parent_id"]


def lists_of_parents(
    pages: DataFrame,
    shape: str,
    parents: DataFrame,
    item: Callable[[Column], Column],
    pages_per_segment: int = flatten.PAGES_PER_SEGMENT,
) -> DataFrame:
    """List rows (repository_id, parent_id, segment, items) of the given
    parents; ``item`` makes an item of an edge. A page is one array from the
    scan to the list. It is exchanged once: by its parent, to be joined, or by
    its list row, where the parents are few enough to be broadcast. Pages of
    a hot parent are dealt by segment, which is also how they are grouped."""
    edges = F.col(f"body.data.{schemas.CONNECTION_PATHS[shape]}.edges")
    per_page = pages.select(
        "request_id", "page_no", flatten.landed_order(pages).alias("landed_at"), F.transform(edges, item).alias("_items")
    ).filter(F.size("_items") > 0)
    segment = F.floor(F.col("page_no") / pages_per_segment)
    owned = inherit_parent_keys(
        per_page, parents, {"repository_id": "repository_id"}, spread=[segment], together=True,
        counted=pages.select("request_id"),
    )
    renamed = owned.withColumnRenamed("request_id", "parent_id")
    return flatten.page_lists(renamed, F.col("_items"), _LIST, pages_per_segment, also=["_salt"])


def _actors_in_pages(pages: DataFrame, shape: str, known_by: Callable[[Column], Column]) -> DataFrame:
    """What the actors of all pages are known by, before any join: where the
    most frequent ones are counted."""
    edges = F.col(f"body.data.{schemas.CONNECTION_PATHS[shape]}.edges")
    return pages.select(F.explode(F.transform(edges, lambda e: known_by(e["node"]))).alias("known"))


def _known(by: Callable, lookup: DataFrame, counted: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Adds ``actor`` to rows of ``known``."""
    return lambda places: by(places, F.col("known"), lookup, "actor", ["parent_id", "segment", "pos"], counted)


def _located(pages: DataFrame) -> bool:
    """Whether the pages say where they lie, as those of the store do."""
    return set(PLACE) <= set(pages.columns)


def _pages_by_id(
    pages: DataFrame,
    wanted: DataFrame,
    keep: Sequence[str] = (),
    known: Callable[[DataFrame], DataFrame] | None = None,
    also: Callable[[Column], Sequence[Column]] = lambda node: (),
) -> DataFrame:
    """Single-node pages of the wanted ids, the first of each. Few wanted ids
    are looked for first; many are joined after the copies have gone, on the
    partitioning that removed them. ``known`` adds columns to rows that have
    the columns ``also`` takes from a node.

    Pages that say where they lie are chosen without their nodes: only ids,
    places and ``also`` are compared, joined and resolved. The nodes come last,
    by place, and cross one exchange at most."""
    ids = wanted.select(F.col("id").alias("request_id"), *keep)
    add = (lambda rows: rows) if known is None else known
    if not _located(pages):
        nodes = project.node_pages(pages).select("*", *also(F.col("node")))
        order = ["page_no", F.xxhash64("node")]
        if fits_broadcast(ids):
            return add(keyed.first_versions(nodes.join(ids, "request_id"), ["request_id"], order))
        return add(keyed.first_versions(nodes, ["request_id"], order).join(ids, "request_id"))
    node = F.col("body.data.node")
    landed = flatten.landed_order(pages)
    narrow = pages.filter(node.isNotNull()).select("request_id", "page_no", landed.alias("_landed"), *PLACE, *also(node))
    order = ["page_no", F.desc("_landed"), *PLACE]
    chosen = keyed.first_versions(narrow.join(ids, "request_id"), ["request_id"], order)
    bodies = pages.select(*PLACE, node.alias("node"))
    return bodies.join(add(chosen), list(PLACE))


# -- repositories and pull requests -----------------------------------------


def repositories(
    pages: DataFrame, stored: DataFrame, scope: DataFrame, now: Column
) -> DataFrame:
    """The repository table after the upsert."""
    wanted = scope.select("owner", "name").distinct()
    found = project.to_repository(pages.join(wanted, ["owner", "name"], "left_semi"))
    return keyed.upsert_repositories(stored, found, now)


def pull_requests(
    pages: DataFrame, repositories: DataFrame, stored: DataFrame, matches: DataFrame
) -> DataFrame:
    """New merged pull requests of the repositories."""
    keys = repositories.select("owner", "name", F.col("id").alias("repository_id"))
    return _new_documents(
        pages, "pull_requests",
        lambda taken: lookup_join(taken, keys, ["owner", "name"], spread=["page_no"], how="inner"),
        ["repository_id"], stored, project.to_pull_request, matches, merged=True,
    )


def _new_documents(
    pages: DataFrame,
    shape: str,
    owned: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    stored: DataFrame,
    to_document: Callable[..., DataFrame],
    matches: DataFrame | None,
    merged: bool = False,
) -> DataFrame:
    """Documents that are not stored yet, the first version of each. ``owned``
    gives pages the ``keys`` of their parents.

    Pages that say where they lie: ids, logins and places are taken out of
    them; copies of pages, stored ids and later versions are dropped and
    authors resolved among these. What is left fetches its nodes from the
    pages, which thereby cross one exchange at most, or none if little is new.
    The last tie-break is the place. Other pages have to be one copy of each,
    and their nodes are carried along."""
    path = schemas.CONNECTION_PATHS[shape]
    order = ["repository_id", "request_id", "page_no", "pos"]

    def with_author(rows: DataFrame, login: Column, seen: DataFrame) -> DataFrame:
        return actors.resolve_by_login(rows, login, matches, "_author", _SPREAD, seen)

    def documents(rows: DataFrame) -> DataFrame:
        return to_document(rows) if matches is None else to_document(rows, F.col("_author"))

    if not _located(pages):
        edges = flatten.explode_edges(owned(flatten.take_edges(pages, path)), [*flatten.ENVELOPE, *keys])
        edges = project.merged_only(edges) if merged else edges
        new = keyed.rows_to_insert(stored, edges.withColumn("id", F.col("node.id")), order).drop("id")
        if matches is not None:
            new = with_author(new, F.col("node.author.login"), actors_seen(pages, shape, "author"))
        return documents(new)

    login = matches is not None
    edges = F.col(f"body.data.{path}.edges")
    item = lambda e: F.struct(
        e["node"]["id"].alias("id"),
        *([e["node"]["author"]["login"].alias("login")] if login else []),
        *([e["node"]["state"].alias("state")] if merged else []),
    )
    taken = pages.select(
        *flatten.ENVELOPE, *PLACE, flatten.landed_order(pages).alias("_landed"), F.transform(edges, item).alias("_items")
    )
    copy = Window.partitionBy(*flatten.ENVELOPE).orderBy(F.desc("_landed"), "_items", *PLACE)
    once = taken.withColumn("_copy", F.row_number().over(copy)).filter("_copy = 1")
    rows = owned(once).select(*flatten.ENVELOPE, *PLACE, *keys, F.posexplode("_items").alias("pos", "_item"))
    rows = rows.select("*", "_item.*").drop("_item")
    rows = rows.filter(F.col("state") == S.MERGED).drop("state") if merged else rows
    new = keyed.rows_to_insert(stored, rows, [*order, *PLACE])
    if login:
        new = with_author(new, F.col("login"), taken.select(F.explode(F.col("_items")["login"]).alias("login")))
    columns = [c for c in new.columns if c not in (*PLACE, "id", "login")]
    wanted = new.groupBy(*PLACE).agg(F.collect_list(F.struct(*columns)).alias("_wanted"))  # of one page
    bodies = pages.select(*PLACE, edges.alias("_edges")).join(wanted, list(PLACE))
    found = bodies.select(
        F.explode(F.transform("_wanted", lambda w: F.struct(w.alias("w"), F.get("_edges", w["pos"])["node"].alias("node")))).alias("f")
    )
    return documents(found.select("f.w.*", "f.node"))


# -- lists of incomplete parents --------------------------------------------


def _incomplete(
    parents: DataFrame, declared: str, loaded: DataFrame, *keys: str
) -> DataFrame:
    """The narrow part of the parents that declare more than was loaded."""
    narrow = parents.select("id", "repository_id", declared, *keys)
    return reconcile.incomplete_parents(narrow, declared, loaded).drop("loaded")


def participants(
    pages: DataFrame, parents: DataFrame, loaded: DataFrame, types: DataFrame
) -> DataFrame:
    todo = _incomplete(parents, "total_participants", loaded)
    ids = lists_of_parents(pages, "pr_participants", todo, lambda e: e["node"]["id"])
    seen = _actors_in_pages(pages, "pr_participants", lambda n: n["id"])
    return actors.resolve_in_lists(ids, _LIST, lambda i: i, _known(actors.resolve_by_id, types, seen))


def commit_ids(pages: DataFrame, parents: DataFrame, loaded: DataFrame) -> DataFrame:
    todo = _incomplete(parents, "total_commits", loaded)
    return lists_of_parents(pages, "pr_commit_ids", todo, lambda e: e["node"]["commit"]["id"])


def commit_status(pages: DataFrame, parents: DataFrame, loaded: DataFrame) -> DataFrame:
    """Load status of the parents whose commits were fetched, from the lists as
    stored by now. A parent loaded before gets the status it has."""
    fetched = pages.select(F.col("request_id").alias("id")).distinct()
    declaring = parents.select("id", "total_commits").filter(F.col("total_commits") > 0)
    return reconcile.commit_load_status(declaring.join(fetched, "id", "left_semi"), loaded)


def edits(
    pages: DataFrame, shape: str, parents: DataFrame, loaded: DataFrame, matches: DataFrame
) -> DataFrame:
    """Edit lists; each segment also says whether it has a deletion, so that
    the flag of the parent needs no second pass. Differences can be long, so a
    segment is a single page."""
    todo = _incomplete(parents, "total_edits", loaded)
    nodes = lists_of_parents(pages, shape, todo, lambda e: e["node"], pages_per_segment=1)
    seen = _actors_in_pages(pages, shape, project.edit_login)
    flagged = nodes.withColumn("has_deletion", F.exists("items", project.is_deletion))
    return actors.resolve_in_lists(
        flagged, _LIST, project.edit_login, _known(actors.resolve_by_login, matches, seen),
        lambda node, editor: project.to_edit(editor, node),
    )


def reactions(
    pages: DataFrame, shape: str, parents: DataFrame, loaded: DataFrame, types: DataFrame
) -> DataFrame:
    todo = _incomplete(parents, "total_reactions", loaded)
    nodes = lists_of_parents(pages, shape, todo, lambda e: e["node"])
    seen = _actors_in_pages(pages, shape, lambda n: n["user"]["id"])
    return actors.resolve_in_lists(
        nodes, _LIST, lambda n: n["user"]["id"], _known(actors.resolve_by_id, types, seen),
        lambda node, author: project.to_reaction(author, node),
    )


def commit_pull_request_ids(pages: DataFrame, parents: DataFrame, loaded: DataFrame) -> DataFrame:
    todo = _incomplete(parents, "total_associated_pull_requests", loaded)
    return lists_of_parents(pages, "commit_pull_request_ids", todo, lambda e: e["node"]["id"])


def commit_authors(
    pages: DataFrame, parents: DataFrame, loaded: DataFrame, types: DataFrame
) -> DataFrame:
    """Authors of commits. The same cursor on two pages is one author, so here
    items are compared one by one; an item is no more than a cursor and an id."""
    todo = _incomplete(parents, "total_authors", loaded)
    edges = edges_of_parents(pages, "commit_authors", todo, {"repository_id": "repository_id"})
    seen = actors_seen(pages, "commit_authors", "user")
    found = actors.resolve_by_id(edges, F.col("node.user.id"), types, "_actor", _SPREAD, seen)
    lists = flatten.stitch_pages(found, F.col("_actor"), ["repository_id", "request_id"], identity="cursor")
    return lists.withColumnRenamed("request_id", "parent_id")


def user_organizations(pages: DataFrame, users: DataFrame, loaded: DataFrame) -> DataFrame:
    parents = users.withColumn("repository_id", F.lit(None).cast("string"))
    todo = _incomplete(parents, "total_organizations", loaded)
    return lists_of_parents(pages, "user_organization_ids", todo, lambda e: e["node"]["id"])


# -- child documents --------------------------------------------------------


def _children(
    pages: DataFrame,
    shape: str,
    todo: DataFrame,
    inherited: dict[str, str],
    stored: DataFrame,
    to_document: Callable[..., DataFrame],
    matches: DataFrame | None,
) -> Children:
    ids = lists_of_parents(pages, shape, todo, lambda e: e["node"]["id"])
    documents = _new_documents(
        pages, shape, lambda taken: inherit_parent_keys(taken, todo, inherited), list(inherited.values()),
        stored, to_document, matches,
    )
    return Children(documents, ids)


def pr_comments(
    pages: DataFrame, parents: DataFrame, stored: DataFrame, matches: DataFrame
) -> Children:
    loaded = reconcile.child_counts(stored, "pull_request_id")
    todo = _incomplete(parents, "total_comments", loaded)
    inherited = {"repository_id": "repository_id", "id": "pull_request_id"}
    return _children(
        pages, "pr_comments", todo, inherited, stored, project.to_pr_comment, matches
    )


def reviews(
    pages: DataFrame, parents: DataFrame, stored: DataFrame, matches: DataFrame
) -> Children:
    loaded = reconcile.child_counts(stored, "pull_request_id")
    todo = _incomplete(parents, "total_reviews", loaded)
    inherited = {"repository_id": "repository_id", "id": "pull_request_id"}
    return _children(
        pages, "reviews", todo, inherited, stored, project.to_review, matches
    )


def review_comments(
    pages: DataFrame, parents: DataFrame, stored: DataFrame, matches: DataFrame
) -> Children:
    """Comments take the pull request of their review."""
    loaded = reconcile.child_counts(stored, "pull_request_review_id")
    todo = _incomplete(parents, "total_comments", loaded, "pull_request_id")
    inherited = {
        "repository_id": "repository_id",
        "id": "pull_request_review_id",
        "pull_request_id": "pull_request_id",
    }
    return _children(
        pages, "review_comments", todo, inherited, stored, project.to_review_comment, matches
    )


def commit_comments(
    pages: DataFrame, parents: DataFrame, loaded: DataFrame, stored: DataFrame, matches: DataFrame
) -> Children:
    todo = _incomplete(parents, "total_comments", loaded)
    inherited = {"repository_id": "repository_id", "id": "commit_id"}
    return _children(
        pages, "commit_comments", todo, inherited, stored, project.to_commit_comment, matches
    )


def check_suites(
    pages: DataFrame, parents: DataFrame, loaded: DataFrame, stored: DataFrame
) -> Children:
    todo = _incomplete(parents, "total_check_suites", loaded)
    inherited = {"repository_id": "repository_id"}
    return _children(
        pages, "check_suites", todo, inherited, stored, project.to_check_suite, None
    )


# -- referenced documents ---------------------------------------------------


def commits(
    pages: DataFrame, references: DataFrame, stored: DataFrame, types: DataFrame
) -> DataFrame:
    """New commits among ``references`` (id, repository_id, place). A commit
    that several repositories refer to belongs to the one listed first."""
    first = references.filter(F.col("id").isNotNull()).groupBy("id").agg(
        F.min(F.struct("place", "repository_id")).alias("first")
    )
    todo = first.select("id", "first.repository_id").join(stored.select("id"), "id", "left_anti")
    seen = project.node_pages(pages).select(*_people(F.col("node")))

    def with_actors(rows: DataFrame) -> DataFrame:
        for person, name in (("author_id", "_author"), ("committer_id", "_committer")):
            rows = actors.resolve_by_id(rows, F.col(person), types, name, ["request_id"], seen)
        return rows

    nodes = _pages_by_id(pages, todo, ["repository_id"], with_actors, _people)
    return project.to_commit(nodes, F.col("_author"), F.col("_committer"))


def _people(node: Column) -> list[Column]:
    """Ids of a commit's author and committer."""
    return [node[side]["user"]["id"].alias(f"{side}_id") for side in ("author", "committer")]


def users(pages: DataFrame, references: DataFrame, stored: DataFrame) -> DataFrame:
    """New users among the referenced ids."""
    return project.to_user(_pages_by_id(pages, discover.unsaved(references, stored)))


def organizations(pages: DataFrame, references: DataFrame, stored: DataFrame) -> DataFrame:
    """New organizations among the referenced ids."""
    return project.to_organization(_pages_by_id(pages, discover.unsaved(references, stored)))


def default_deleted(documents: DataFrame, object_type: str) -> DataFrame:
    """Comments whose edits were never evaluated are not deleted; for the other
    types that is unknown."""
    if object_type in schemas.NOT_DELETED_BY_DEFAULT:
        return documents.withColumn("is_deleted", F.coalesce("is_deleted", F.lit(False)))
    return documents


def scoped_references(ids: DataFrame, scope: DataFrame) -> DataFrame:
    """References (id, repository_id) with the repository's place in the list."""
    places = scope.select(F.col("id").alias("repository_id"), "place")
    return lookup_join(ids, places, ["repository_id"], spread=["id"], how="inner")


def known_missing(requested: DataFrame, pages: DataFrame) -> DataFrame:
    """Ids that were asked for and answered with a NULL node."""
    answered = pages.select(F.col("request_id").alias("id")).distinct()
    asked = requested.select("id").distinct().join(answered, "id", "left_semi")
    return discover.not_found(asked, project.node_pages(pages), "request_id")
