"""Documents from flattened edges or single-node pages.

Each function is one ``select`` over rows that carry a ``node`` struct and the
parent keys already joined. ``author`` and ``committer`` are actor structs
resolved before (see ``actors``); NULL means the API named nobody. ``keep``
names further columns to carry along, such as the page order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prflow.functions import scalars as S


def _total(name: str) -> Column:
    return F.col(f"node.{name}.totalCount")


def _type(name: str) -> Column:
    return F.lit(name).alias("object_type")


def _created() -> Column:
    return S.parse_timestamp(F.col("node.createdAt")).alias("create_timestamp")


def _author(author: Column | None) -> Column:
    value = S.unresolved_actor(F.col("node.author.login")) if author is None else author
    return S.actor_or_unknown(value).alias("author")


def _minimized() -> Column:
    return S.minimized_status(F.col("node.isMinimized"), F.col("node.minimizedReason")).alias(
        "minimized_status"
    )


def node_pages(pages: DataFrame, node: str = "node") -> DataFrame:
    """Single-node pages as rows with a ``node``; pages whose node is NULL (not
    found) are dropped."""
    return pages.select(
        "owner", "name", "request_id", "page_no", F.col(f"body.data.{node}").alias("node")
    ).filter(F.col("node").isNotNull())


def to_repository(pages: DataFrame) -> DataFrame:
    """id, owner, name and declared total; the stamps are set by the upsert."""
    return node_pages(pages, "repository").select(
        F.col("node.id").alias("id"),
        "name",
        "owner",
        _total("pullRequests").alias("total_pull_requests"),
        _type("REPOSITORY"),
    )


def to_pull_request(
    edges: DataFrame, author: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    return edges.select(
        *keep,
        F.col("node.id").alias("id"),
        "repository_id",
        _author(author),
        F.col("node.authorAssociation").alias("author_association"),
        _created(),
        F.col("node.bodyText").alias("text"),
        _total("participants").alias("total_participants"),
        _total("comments").alias("total_comments"),
        _total("reviews").alias("total_reviews"),
        _total("commits").alias("total_commits"),
        _total("userContentEdits").alias("total_edits"),
        _total("reactions").alias("total_reactions"),
        F.col("node.state").alias("state"),
        _type("PULL_REQUEST"),
    )


def merged_only(edges: DataFrame) -> DataFrame:
    """Only merged pull requests are in scope."""
    return edges.filter(F.col("node.state") == S.MERGED)


def to_pr_comment(
    edges: DataFrame, author: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    return edges.select(
        *keep,
        F.col("node.id").alias("id"),
        "pull_request_id",
        "repository_id",
        _author(author),
        F.col("node.authorAssociation").alias("author_association"),
        _created(),
        F.col("node.bodyText").alias("text"),
        _minimized(),
        S.empty_if_null(F.col("node.issue.id")).alias("issue_id"),
        _total("userContentEdits").alias("total_edits"),
        _total("reactions").alias("total_reactions"),
        _type("PULL_REQUEST_COMMENT"),
    )


def to_review(
    edges: DataFrame, author: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    return edges.select(
        *keep,
        F.col("node.id").alias("id"),
        "pull_request_id",
        "repository_id",
        _author(author),
        F.col("node.authorAssociation").alias("author_association"),
        _created(),
        F.col("node.commit.id").alias("commit_id"),
        F.col("node.bodyText").alias("text"),
        _total("comments").alias("total_comments"),
        _total("onBehalfOf").alias("total_for_teams"),
        _total("userContentEdits").alias("total_edits"),
        _total("reactions").alias("total_reactions"),
        F.col("node.state").alias("state"),
        _type("PULL_REQUEST_REVIEW"),
    )


def to_review_comment(
    edges: DataFrame, author: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    return edges.select(
        *keep,
        F.col("node.id").alias("id"),
        "pull_request_id",
        "pull_request_review_id",
        "repository_id",
        _author(author),
        F.col("node.authorAssociation").alias("author_association"),
        F.col("node.originalCommit.id").alias("original_commit_id"),
        F.col("node.commit.id").alias("commit_id"),
        F.col("node.replyTo.id").alias("reply_to_comment_id"),
        _created(),
        F.col("node.bodyText").alias("text"),
        S.inline_comment(F.col("node.originalPosition")).alias("inline_comment"),
        F.col("node.diffHunk").alias("diff_hunk"),
        F.col("node.path").alias("path"),
        S.zero_if_null(F.col("node.originalPosition")).alias("original_position"),
        S.zero_if_null(F.col("node.position")).alias("position"),
        _minimized(),
        _total("userContentEdits").alias("total_edits"),
        _total("reactions").alias("total_reactions"),
        F.col("node.state").alias("state"),
        _type("PULL_REQUEST_REVIEW_COMMENT"),
    )


def entries(tree_entries: Column) -> Column:
    """Tree entries of a commit; object and submodule may be NULL."""
    return F.transform(
        F.coalesce(tree_entries, F.array()),
        lambda e: F.struct(
            e["object"]["id"].alias("id"),
            e["name"].alias("name"),
            e["extension"].alias("extension"),
            e["path"].alias("path"),
            e["isGenerated"].alias("is_generated"),
            e["mode"].alias("mode"),
            e["type"].alias("type"),
            e["submodule"]["name"].alias("submodule_name"),
        ),
    )


def to_commit(
    nodes: DataFrame,
    author: Column | None = None,
    committer: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    def person(value: Column | None, side: str) -> Column:
        if value is None:
            value = S.unresolved_actor(F.col(f"node.{side}.user.id"))
        return S.actor_or_unknown(value).alias(side)

    return nodes.select(
        *keep,
        F.col("node.id").alias("id"),
        "repository_id",
        person(author, "author"),
        F.col("node.authoredByCommitter").alias("authored_by_committer"),
        person(committer, "committer"),
        _total("authors").alias("total_authors"),
        F.col("node.onBehalfOf.id").alias("for_organization_id"),
        S.parse_timestamp(F.col("node.committedDate")).alias("create_timestamp"),
        S.parse_timestamp(F.col("node.pushedDate")).alias("push_timestamp"),
        F.col("node.messageHeadline").alias("message_headline"),
        F.col("node.messageBody").alias("message_text"),
        _total("comments").alias("total_comments"),
        _total("checkSuites").alias("total_check_suites"),
        F.col("node.tree.id").alias("tree_id"),
        entries(F.col("node.tree.entries")).alias("entries"),
        F.col("node.additions").alias("additions"),
        F.col("node.deletions").alias("deletions"),
        F.col("node.changedFiles").alias("changed_files"),
        _total("associatedPullRequests").alias("total_associated_pull_requests"),
        F.col("node.status.state").alias("state"),
        _type("COMMIT"),
    )


def commit_entries(commits: DataFrame) -> DataFrame:
    """Tree entries as rows, with the commit's id."""
    return commits.select(F.col("id").alias("commit_id"), F.inline("entries"))


def to_commit_comment(
    edges: DataFrame, author: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    return edges.select(
        *keep,
        F.col("node.id").alias("id"),
        "commit_id",
        "repository_id",
        _author(author),
        F.col("node.authorAssociation").alias("author_association"),
        _created(),
        F.col("node.bodyText").alias("text"),
        F.col("node.path").alias("path"),
        S.zero_if_null(F.col("node.position")).alias("position"),
        _minimized(),
        _total("userContentEdits").alias("total_edits"),
        _total("reactions").alias("total_reactions"),
        _type("COMMIT_COMMENT"),
    )


def to_check_suite(edges: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The repository and the commit come from the node, not from the parent."""
    return edges.select(
        *keep,
        F.col("node.id").alias("id"),
        F.col("node.commit.id").alias("commit_id"),
        F.col("node.repository.id").alias("repository_id"),
        F.col("node.app.id").alias("application_id"),
        F.col("node.branch.id").alias("branch_id"),
        _created(),
        _total("checkRuns").alias("total_check_runs"),
        F.col("node.conclusion").alias("conclusion"),
        _total("matchingPullRequests").alias("total_matching_pull_requests"),
        F.col("node.status").alias("state"),
        _type("CHECK_SUITE"),
    )


def to_user(nodes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return nodes.select(
        *keep,
        F.col("node.id").alias("id"),
        F.col("node.name").alias("name"),
        F.col("node.login").alias("login"),
        F.col("node.location").alias("location"),
        F.col("node.company").alias("company"),
        F.col("node.bio").alias("bio"),
        F.col("node.url").alias("url"),
        F.col("node.email").alias("email"),
        F.col("node.twitterUsername").alias("twitter_user_name"),
        F.col("node.avatarUrl").alias("avatar_url"),
        F.col("node.websiteUrl").alias("website_url"),
        _total("organizations").alias("total_organizations"),
        _type("USER"),
    )


def to_organization(nodes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The id is the one asked for."""
    return nodes.select(
        *keep,
        F.col("request_id").alias("id"),
        F.col("node.name").alias("name"),
        F.col("node.description").alias("description"),
        _type("ORGANIZATION"),
    )


# --------------------------------------------------------------------------
# Edits and reactions: items of embedded lists, the same for every parent type


def is_deletion(node: Column | None = None) -> Column:
    return (F.col("node") if node is None else node)["deletedAt"].isNotNull()


def edit_login(node: Column | None = None) -> Column:
    """The login an edit is attributed to: who deleted it, when it was deleted
    and that is known, else who edited. One lookup per edit instead of two."""
    node = F.col("node") if node is None else node
    deleter = F.when(is_deletion(node), node["deletedBy"]["login"])
    return F.coalesce(deleter, node["editor"]["login"])


def to_edit(editor: Column | None = None, node: Column | None = None) -> Column:
    """Edit item; a deletion replaces the time and, if known, the editor."""
    node = F.col("node") if node is None else node
    value = S.unresolved_actor(edit_login(node)) if editor is None else editor
    when = F.when(is_deletion(node), node["deletedAt"]).otherwise(node["editedAt"])
    return F.struct(
        node["id"].alias("id"),
        S.actor_or_unknown(value).alias("editor"),
        S.parse_timestamp(when).alias("edited_timestamp"),
        S.empty_if_null(node["diff"]).alias("difference"),
    )


def any_delete_flag(edges: DataFrame, key: str = "request_id") -> DataFrame:
    """Per parent, whether any of its edits is a deletion."""
    return edges.groupBy(F.col(key).alias("id")).agg(
        F.bool_or(is_deletion()).alias("is_deleted")
    )


def deleted_parents(edit_lists: DataFrame) -> DataFrame:
    """The same from stored edit lists."""
    return edit_lists.groupBy(F.col("parent_id").alias("id")).agg(
        F.bool_or("has_deletion").alias("is_deleted")
    )


def to_reaction(author: Column | None = None, node: Column | None = None) -> Column:
    node = F.col("node") if node is None else node
    value = S.unresolved_actor(node["user"]["id"]) if author is None else author
    return F.struct(
        node["id"].alias("id"),
        S.actor_or_unknown(value).alias("author"),
        S.parse_timestamp(node["createdAt"]).alias("create_timestamp"),
        node["content"].alias("content"),
    )
