"""Sources, lookups, flattening and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.functions import scalars as S
from prflow.operators import flatten, project
from prflow.operators.joins import inherit_parent_keys
from prflow.queries import tables as P
from prflow.queries.registry import query
from prflow.queries.tables import Tables, stamp, tag, text
from prflow.sources import documents, pages

# -- sources ----------------------------------------------------------------


@query(
    "page_accept",
    """
    SELECT event_type,
           CASE event_type WHEN 'error' THEN 'errors' WHEN 'signup' THEN 'other'
                           ELSE 'accepted' END AS outcome,
           count(*) AS pages, count(DISTINCT user_id) AS requests
    FROM events GROUP BY event_type
    """,
)
def page_accept(t: Tables) -> DataFrame:
    """Errors without data fail, sign-ups are null data or a torn line,
    purchases have data and errors."""
    data = F.format_string(
        '"data":{"node":{"id":"%d","name":"%s","description":%s}}',
        "event_id", "event_type", F.to_json(F.struct("props")),
    )
    errors = F.format_string('"errors":[{"message":"%s"}]', "event_type")
    body = (
        F.when(F.col("event_type") == "error", errors)
        .when(F.col("event_type") == "signup", F.lit('"data":null'))
        .when(F.col("event_type") == "purchase", F.concat(data, F.lit(","), errors))
        .otherwise(data)
    )
    line = F.concat(
        F.format_string('{"shape":"organization","request_id":"%d","page_no":0,"body":{', "user_id"),
        body,
        F.lit("}}"),
    )
    torn = (F.col("event_type") == "signup") & (F.col("value") > 20)
    lines = t.events.withColumn("line", line).select(
        "event_type",
        "user_id",
        F.when(torn, F.substring("line", F.lit(1), F.length("line") - 5))
        .otherwise(F.col("line"))
        .alias("line"),
    )
    classified = pages.classify_pages(pages.parse_pages(lines, "organization", "line"))
    return classified.groupBy("event_type", "outcome").agg(
        F.count(F.lit(1)).alias("pages"), F.countDistinct("user_id").alias("requests")
    )


@query(
    "scan_docs_by_repository",
    f"SELECT id, author_id, state FROM ({P.PULL_REQUESTS_SQL}) WHERE repository_id = 'R7'",
)
def scan_docs_by_repository(t: Tables) -> DataFrame:
    found = documents.documents_of(t.once(P.pull_requests), repository_id="R7")
    return found.select("id", F.col("author.id").alias("author_id"), "state")


@query(
    "scan_docs_all",
    f"SELECT id, repository_id, author_id, author_type, state FROM ({P.PULL_REQUESTS_SQL})",
)
def scan_docs_all(t: Tables) -> DataFrame:
    found = documents.documents_of(t.once(P.pull_requests), object_type="PULL_REQUEST")
    return found.select(
        "id",
        "repository_id",
        F.col("author.id").alias("author_id"),
        F.col("author.author_type").alias("author_type"),
        "state",
    )


def _wanted(t: Tables) -> DataFrame:
    """Repositories of the suppliers, and the same names under a wrong owner."""
    right = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("r_name").alias("owner"), F.col("n_name").alias("name"))
        .distinct()
    )
    return right.unionByName(right.select(F.upper("name").alias("owner"), "name"))


_WANTED_SQL = """
    SELECT DISTINCT unnest([r_name, upper(n_name)]) AS owner, n_name AS name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


@query(
    "repository_lookup",
    f"""
    SELECT id, owner, name, total_pull_requests FROM ({P.REPOSITORIES_SQL}) r
    WHERE EXISTS (SELECT 1 FROM ({_WANTED_SQL}) w WHERE w.owner = r.owner AND w.name = r.name)
    """,
)
def repository_lookup(t: Tables) -> DataFrame:
    return documents.lookup_repository(t.once(P.repositories), _wanted(t))


@query(
    "repository_exists",
    f"""
    SELECT w.owner, w.name, r.id IS NOT NULL AS is_stored
    FROM ({_WANTED_SQL}) w LEFT JOIN ({P.REPOSITORIES_SQL}) r
      ON w.owner = r.owner AND w.name = r.name
    """,
)
def repository_exists(t: Tables) -> DataFrame:
    return documents.repository_exists(t.once(P.repositories), _wanted(t))


@query(
    "multi_repository_scope",
    f"""
    SELECT id, repository_id, state FROM ({P.PULL_REQUESTS_SQL})
    WHERE repository_id IN (
      SELECT r.id FROM ({P.REPOSITORIES_SQL}) r JOIN ({_WANTED_SQL}) w
        ON w.owner = r.owner AND w.name = r.name)
    """,
)
def multi_repository_scope(t: Tables) -> DataFrame:
    """One run over all the listed repositories."""
    scope = documents.lookup_repository(t.once(P.repositories), _wanted(t))
    return documents.in_scope(t.once(P.pull_requests), scope).select("id", "repository_id", "state")


# -- connections ------------------------------------------------------------


@query(
    "connection_flatten",
    """
    SELECT CAST(conv_id AS VARCHAR) AS request_id, CAST(turn // 3 AS BIGINT) AS page_no,
           CAST(turn % 3 AS INTEGER) AS pos, CAST(turn AS VARCHAR) AS cursor,
           CASE WHEN role <> 'system' THEN role END AS login, text
    FROM conversations
    """,
)
def connection_flatten(t: Tables) -> DataFrame:
    edges = flatten.flatten_connection(
        P.turn_pages(t, "pr_comments", P.comment_fields()), "node.comments"
    )
    return edges.select(
        "request_id",
        "page_no",
        "pos",
        "cursor",
        F.col("node.author.login").alias("login"),
        F.col("node.bodyText").alias("text"),
    )


def _associations():
    return F.col("body.data.node.comments.edges")["node"]["authorAssociation"]


@query(
    "page_stitch",
    """
    SELECT CAST(conv_id AS VARCHAR) AS request_id, CAST(turn // 6 AS BIGINT) AS segment,
           string_agg(role || ':' || turn, ',' ORDER BY turn) AS items
    FROM conversations GROUP BY conv_id, turn // 6
    """,
)
def page_stitch(t: Tables) -> DataFrame:
    """Every page has landed twice; the lists come out once and in order."""
    landed = P.turn_pages(
        t, "pr_comments", {"id": P.turn_id(), "authorAssociation": F.concat_ws(":", "role", text("turn"))}
    )
    lists = flatten.page_lists(landed.unionByName(landed), _associations(), pages_per_segment=2)
    return lists.select("request_id", "segment", F.array_join("items", ",").alias("items"))


@query(
    "page_relanded",
    """
    SELECT CAST(conv_id AS VARCHAR) AS request_id, CAST(turn // 6 AS BIGINT) AS segment,
           string_agg(CASE WHEN conv_id % 2 = 0 THEN 'new:' ELSE '' END || role || ':' || turn, ','
                      ORDER BY turn) AS items
    FROM conversations GROUP BY conv_id, turn // 6
    """,
)
def page_relanded(t: Tables) -> DataFrame:
    """Every second conversation was asked again and had changed: its old pages
    are gone, also those the new fetch does not reach; the others landed twice."""

    def fetch(prefix: str, landed_at: int) -> DataFrame:
        value = F.concat(F.lit(prefix), F.concat_ws(":", "role", text("turn")))
        landed = P.turn_pages(t, "pr_comments", {"id": P.turn_id(), "authorAssociation": value})
        return landed.withColumn("landed_at", F.lit(landed_at).cast("bigint"))

    changed = F.col("request_id").cast("long") % 2 == 0
    old = fetch("", 1)
    beyond = old.filter(changed).withColumn("page_no", F.col("page_no") + 1000)
    landed = old.unionByName(old).unionByName(beyond).unionByName(fetch("new:", 2).filter(changed))
    lists = flatten.page_lists(flatten.current_fetch(landed), _associations(), pages_per_segment=2)
    return lists.select("request_id", "segment", F.array_join("items", ",").alias("items"))


@query(
    "page_progress",
    f"""
    SELECT id AS request_id, CAST(last_turn // 3 + 1 AS BIGINT) AS pages, turns AS items,
           CAST(last_turn AS VARCHAR) AS next_cursor, last_role <> 'user' AS complete
    FROM ({P.LAST_TURNS_SQL})
    """,
)
def page_progress(t: Tables) -> DataFrame:
    """A conversation whose last turn is the user's still has a page to come."""
    last = P.last_turns(t)

    def has_next(paged: DataFrame) -> DataFrame:
        ends = F.element_at("turns", -1)["turn"] == F.col("last_turn")
        return paged.join(last, "request_id").withColumn(
            "has_next", ~ends | (F.col("last_role") == "user")
        )

    landed = P.turn_pages(t, "pr_commit_ids", {"commit": {"id": P.turn_id()}}, more=has_next)
    return flatten.page_progress(landed, "node.commits")


# -- documents --------------------------------------------------------------


@query(
    "project_repository",
    f"""
    SELECT id, name, owner, total_pull_requests, 'REPOSITORY' AS object_type
    FROM ({P.REPOSITORIES_SQL}) WHERE owner <> 'AFRICA'
    """,
)
def project_repository(t: Tables) -> DataFrame:
    """Repositories of one owner are not visible: their node is NULL."""
    r = t.once(P.repositories)
    node = P.only_if(
        F.col("owner") != "AFRICA",
        {"id": F.col("id"), "pullRequests": P.total(F.col("total_pull_requests"))},
        "id string, pullRequests struct<totalCount:int>",
    )
    landed = P.pages(
        r, "repository", {"repository": node}, F.col("id"), owner=F.col("owner"), name=F.col("name")
    )
    return project.to_repository(landed)


@query(
    "project_organization",
    """
    SELECT 'O' || r_regionkey AS id, r_name AS name,
           CASE WHEN r_name <> 'ASIA' THEN lower(r_name) END AS description,
           'ORGANIZATION' AS object_type
    FROM region WHERE r_name <> 'EUROPE'
    """,
)
def project_organization(t: Tables) -> DataFrame:
    node = P.only_if(
        F.col("r_name") != "EUROPE",
        {
            "id": tag("O", "r_regionkey"),
            "name": F.col("r_name"),
            "description": F.when(F.col("r_name") != "ASIA", F.lower("r_name")),
        },
        "id string, name string, description string",
    )
    landed = P.pages(t.region, "organization", {"node": node}, tag("O", "r_regionkey"))
    return project.to_organization(project.node_pages(landed))


def pull_request_edges(t: Tables) -> DataFrame:
    """Orders as edges of their repository's pull requests."""
    node = {
        "id": text("o_orderkey"),
        "createdAt": P.api_time(F.col("o_orderdate")),
        "bodyText": F.concat_ws(" ", "o_orderpriority", "c_mktsegment"),
        "author": P.only_if(F.col("c_acctbal") >= 0, {"login": F.col("c_name")}, "login string"),
        "authorAssociation": F.col("o_orderpriority"),
        "participants": P.total(F.col("lines")),
        "comments": P.total(F.col("numbers")),
        "reviews": P.total(F.col("lines") - F.col("numbers")),
        "userContentEdits": P.total(F.col("c_nationkey")),
        "reactions": P.total(F.lit(0)),
        "commits": P.total(P.declared_commits()),
        "state": P.pr_state(),
    }
    landed = P.edge_pages(
        t.once(P.order_rows), "pull_requests", node, tag("R", "c_nationkey"), F.col("o_orderkey"),
        owner=F.col("r_name"), name=F.col("n_name"),
    )
    return flatten.flatten_connection(landed, "repository.pullRequests").withColumn(
        "repository_id", F.col("request_id")
    )


PULL_REQUEST_DOCS_SQL = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'R' || c_nationkey AS repository_id,
           CASE WHEN c_acctbal >= 0 THEN c_name ELSE '' END AS author_id,
           'UNKNOWN' AS author_type, o_orderpriority AS author_association,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created,
           o_orderpriority || ' ' || c_mktsegment AS text,
           CAST(lines AS INTEGER) AS total_participants, CAST(numbers AS INTEGER) AS total_comments,
           CAST(lines - numbers AS INTEGER) AS total_reviews,
           CAST(CASE WHEN r_name IN {P.EXACT_OWNERS} THEN numbers ELSE lines END AS INTEGER)
             AS total_commits,
           c_nationkey AS total_edits, CAST(0 AS INTEGER) AS total_reactions,
           CASE o_orderstatus WHEN 'F' THEN 'MERGED' WHEN 'O' THEN 'OPEN' ELSE 'CLOSED' END AS state,
           'PULL_REQUEST' AS object_type
    FROM ({P.ORDER_ROWS_SQL}) r
"""


def flat(df: DataFrame, actors=("author",), times=("create_timestamp",), drop=()) -> DataFrame:
    """Documents with scalar columns only, for comparison."""
    names = {"create_timestamp": "created", "push_timestamp": "pushed"}
    columns = []
    for c in df.columns:
        if c in drop:
            continue
        if c in actors:
            columns += [
                F.col(f"{c}.id").alias(f"{c}_id"), F.col(f"{c}.author_type").alias(f"{c}_type")
            ]
        elif c in times:
            columns.append(stamp(c).alias(names[c]))
        else:
            columns.append(F.col(c))
    return df.select(*columns)


@query("project_pull_request", PULL_REQUEST_DOCS_SQL)
def project_pull_request(t: Tables) -> DataFrame:
    return flat(project.to_pull_request(pull_request_edges(t)))


@query(
    "merged_only",
    f"SELECT id, repository_id, state FROM ({PULL_REQUEST_DOCS_SQL}) WHERE state = 'MERGED'",
)
def merged_only(t: Tables) -> DataFrame:
    return project.to_pull_request(project.merged_only(pull_request_edges(t))).select(
        "id", "repository_id", "state"
    )


def pr_comment_edges(t: Tables) -> DataFrame:
    landed = P.comment_pages(
        t, "pr_comments",
        issue=P.only_if(F.col("role") != "user", {"id": tag("I", "conv_id")}, "id string"),
    )
    return flatten.flatten_connection(landed, "node.comments")


def _owned(edges: DataFrame, *keys: str) -> DataFrame:
    """Edges with the keys a parent would give them."""
    for key in keys:
        edges = edges.withColumn(key, F.col("request_id"))
    return edges


@query(
    "project_pr_comment",
    f"""
    SELECT id, parent_id AS pull_request_id, parent_id AS repository_id, author_id, author_type,
           author_association, created, text, minimized_status,
           CASE WHEN role <> 'user' THEN 'I' || parent_id ELSE '' END AS issue_id,
           total_edits, total_reactions, 'PULL_REQUEST_COMMENT' AS object_type
    FROM ({P.COMMENT_SQL})
    """,
)
def project_pr_comment(t: Tables) -> DataFrame:
    return flat(project.to_pr_comment(_owned(pr_comment_edges(t), "pull_request_id", "repository_id")))


def review_edges(t: Tables) -> DataFrame:
    node = {k: v for k, v in P.comment_fields().items() if k not in ("isMinimized", "minimizedReason")}
    node |= {
        "commit": P.only_if(F.col("role") == "assistant", {"id": tag("C", "turn")}, "id string"),
        "comments": P.total(F.col("turn") + 1),
        "onBehalfOf": P.total(F.lit(0)),
        "state": F.col("role"),
    }
    landed = P.edge_pages(t.conversations, "reviews", node, text("conv_id"), F.col("turn"))
    return flatten.flatten_connection(landed, "node.reviews")


@query(
    "project_review",
    f"""
    SELECT id, parent_id AS pull_request_id, parent_id AS repository_id, author_id, author_type,
           author_association, created, CASE WHEN role = 'assistant' THEN 'C' || turn END AS commit_id,
           text, CAST(turn + 1 AS INTEGER) AS total_comments, CAST(0 AS INTEGER) AS total_for_teams,
           total_edits, total_reactions, role AS state, 'PULL_REQUEST_REVIEW' AS object_type
    FROM ({P.COMMENT_SQL})
    """,
)
def project_review(t: Tables) -> DataFrame:
    return flat(project.to_review(_owned(review_edges(t), "pull_request_id", "repository_id")))


def review_comment_edges(t: Tables) -> DataFrame:
    """The first turn has no position; replies answer the first turn."""
    later = F.col("turn") > 0
    landed = P.comment_pages(
        t, "review_comments",
        diffHunk=F.col("text"),
        path=F.concat_ws("/", "role", text("turn")),
        originalPosition=F.when(later, F.col("turn") - 1),
        position=F.when(later, F.col("turn")),
        originalCommit=P.only_if(later, {"id": tag("C", "turn")}, "id string"),
        commit=P.only_if(F.col("role") == "user", {"id": tag("C", "conv_id")}, "id string"),
        replyTo=P.only_if(later, {"id": F.concat(text("conv_id"), F.lit("-0"))}, "id string"),
        state=F.col("role"),
    )
    return flatten.flatten_connection(landed, "node.comments")


_REVIEW_COMMENT_SQL = f"""
    SELECT *, CASE WHEN turn > 0 THEN 'C' || turn END AS original_commit_id,
           CASE WHEN role = 'user' THEN 'C' || parent_id END AS commit_id,
           CASE WHEN turn > 0 THEN parent_id || '-0' END AS reply_to_comment_id,
           turn > 1 AS inline_comment, text AS diff_hunk, role || '/' || turn AS path,
           CAST(CASE WHEN turn > 0 THEN turn - 1 ELSE 0 END AS INTEGER) AS original_position,
           CAST(turn AS INTEGER) AS position, role AS state
    FROM ({P.COMMENT_SQL})
"""


@query(
    "project_review_comment",
    f"""
    SELECT id, parent_id AS pull_request_id, parent_id AS pull_request_review_id,
           parent_id AS repository_id, author_id, author_type, author_association,
           original_commit_id, commit_id, reply_to_comment_id, created, text, inline_comment,
           diff_hunk, path, original_position, position, minimized_status, total_edits,
           total_reactions, state, 'PULL_REQUEST_REVIEW_COMMENT' AS object_type
    FROM ({_REVIEW_COMMENT_SQL})
    """,
)
def project_review_comment(t: Tables) -> DataFrame:
    edges = _owned(
        review_comment_edges(t), "pull_request_id", "pull_request_review_id", "repository_id"
    )
    return flat(project.to_review_comment(edges))


def commit_comment_edges(t: Tables) -> DataFrame:
    landed = P.comment_pages(
        t, "commit_comments",
        path=F.col("role"),
        position=F.when(F.col("turn") > 0, F.col("turn")),
    )
    return flatten.flatten_connection(landed, "node.comments")


@query(
    "project_commit_comment",
    f"""
    SELECT id, parent_id AS commit_id, parent_id AS repository_id, author_id, author_type,
           author_association, created, text, role AS path, CAST(turn AS INTEGER) AS position,
           minimized_status, total_edits, total_reactions, 'COMMIT_COMMENT' AS object_type
    FROM ({P.COMMENT_SQL})
    """,
)
def project_commit_comment(t: Tables) -> DataFrame:
    return flat(project.to_commit_comment(_owned(commit_comment_edges(t), "commit_id", "repository_id")))


def commits(t: Tables) -> DataFrame:
    nodes = project.node_pages(P.commit_pages(t)).withColumn("repository_id", F.lit("R0"))
    return project.to_commit(nodes)


@query(
    "project_commit",
    """
    SELECT 'C' || p_partkey AS id, 'R0' AS repository_id,
           CASE WHEN p_type <> 'ECONOMY' THEN p_brand ELSE '' END AS author_id,
           'UNKNOWN' AS author_type, p_size > 10 AS authored_by_committer,
           CASE WHEN p_size <= 40 THEN p_type ELSE '' END AS committer_id,
           'UNKNOWN' AS committer_type, p_size AS total_authors,
           CASE WHEN p_type <> 'LARGE' THEN 'O' || p_size END AS for_organization_id,
           strftime(TIMESTAMP '2024-01-01' + to_hours(p_size), '%Y-%m-%d %H:%M:%S') AS created,
           CAST(NULL AS VARCHAR) AS pushed, p_name AS message_headline,
           p_brand || ' ' || p_type || ' ' || p_name AS message_text,
           CAST(0 AS INTEGER) AS total_comments, CAST(2 AS INTEGER) AS total_check_suites,
           'T' || p_partkey AS tree_id, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS entries,
           p_size AS additions, CAST(p_size + 1 AS INTEGER) AS deletions,
           CAST(p_size + 2 AS INTEGER) AS changed_files,
           CAST(1 AS INTEGER) AS total_associated_pull_requests,
           CASE WHEN p_size > 5 THEN p_type END AS state, 'COMMIT' AS object_type
    FROM part
    """,
)
def project_commit(t: Tables) -> DataFrame:
    sized = commits(t).withColumn("entries", F.size("entries"))
    return flat(sized, ("author", "committer"), ("create_timestamp", "push_timestamp"))


@query(
    "commit_entries",
    """
    SELECT 'C' || p_partkey AS commit_id,
           CASE WHEN word <> 'ring' THEN p_partkey || ':' || word END AS id, word AS name,
           p_type AS extension, p_brand || '/' || word AS path, p_size > 25 AS is_generated,
           p_size AS mode, 'blob' AS type, CASE WHEN p_type = 'PROMO' THEN p_brand END AS submodule_name
    FROM (SELECT *, unnest(string_split(p_name, ' ')) AS word FROM part)
    """,
)
def commit_entries(t: Tables) -> DataFrame:
    return project.commit_entries(commits(t))


def check_suite_edges(t: Tables) -> DataFrame:
    """Line items as check suites of their part."""
    node = {
        "id": F.concat_ws("-", text("l_partkey"), text("l_suppkey")),
        "app": P.only_if(F.col("l_returnflag") != "N", {"id": tag("P", "l_suppkey")}, "id string"),
        "branch": P.only_if(F.col("l_linestatus") == "F", {"id": tag("B", "l_orderkey")}, "id string"),
        "commit": {"id": tag("C", "l_partkey")},
        "checkRuns": P.total(F.col("l_linenumber")),
        "conclusion": F.col("l_returnflag"),
        "createdAt": P.api_time(F.col("l_shipdate")),
        "matchingPullRequests": P.total(F.col("l_quantity")),
        "repository": {"id": tag("R", "l_suppkey")},
        "status": F.col("l_linestatus"),
    }
    landed = P.edge_pages(t.lineitem, "check_suites", node, tag("C", "l_partkey"), F.col("l_orderkey"))
    return flatten.flatten_connection(landed, "node.checkSuites")


CHECK_SUITES_SQL = """
    SELECT l_partkey || '-' || l_suppkey AS id, 'C' || l_partkey AS commit_id,
           'R' || l_suppkey AS repository_id,
           CASE WHEN l_returnflag <> 'N' THEN 'P' || l_suppkey END AS application_id,
           CASE WHEN l_linestatus = 'F' THEN 'B' || l_orderkey END AS branch_id,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created,
           l_linenumber AS total_check_runs, l_returnflag AS conclusion,
           CAST(l_quantity AS INTEGER) AS total_matching_pull_requests, l_linestatus AS state,
           'CHECK_SUITE' AS object_type
    FROM lineitem
"""


@query("project_check_suite", CHECK_SUITES_SQL)
def project_check_suite(t: Tables) -> DataFrame:
    return flat(project.to_check_suite(check_suite_edges(t)))


@query(
    "project_user",
    """
    SELECT 'U' || c_custkey AS id, c_name AS name, lower(c_name) AS login,
           c_mktsegment AS location, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS company,
           CAST(NULL AS VARCHAR) AS bio, 'u/' || c_custkey AS url, CAST(NULL AS VARCHAR) AS email,
           CASE WHEN c_nationkey > 12 THEN c_name END AS twitter_user_name,
           'a/' || c_custkey AS avatar_url, 'w/' || c_custkey AS website_url,
           c_nationkey AS total_organizations, 'USER' AS object_type
    FROM customer
    """,
)
def project_user(t: Tables) -> DataFrame:
    node = {
        "id": tag("U", "c_custkey"),
        "name": F.col("c_name"),
        "login": F.lower("c_name"),
        "location": F.col("c_mktsegment"),
        "company": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
        "url": tag("u/", "c_custkey"),
        "twitterUsername": F.when(F.col("c_nationkey") > 12, F.col("c_name")),
        "avatarUrl": tag("a/", "c_custkey"),
        "websiteUrl": tag("w/", "c_custkey"),
        "organizations": P.total(F.col("c_nationkey")),
    }
    landed = P.pages(t.customer, "user", {"node": node}, tag("U", "c_custkey"))
    return project.to_user(project.node_pages(landed))


# -- edits and reactions ----------------------------------------------------


def edit_edges(t: Tables) -> DataFrame:
    return flatten.flatten_connection(P.edit_pages(t), "node.userContentEdits")


@query(
    "edit_delete_overlay",
    f"""
    SELECT parent_id, id, editor_id, 'UNKNOWN' AS editor_type, edited, difference
    FROM ({P.EDITS_SQL})
    """,
)
def edit_delete_overlay(t: Tables) -> DataFrame:
    edits = edit_edges(t).select(F.col("request_id").alias("parent_id"), project.to_edit().alias("e"))
    return edits.select(
        "parent_id",
        "e.id",
        F.col("e.editor.id").alias("editor_id"),
        F.col("e.editor.author_type").alias("editor_type"),
        stamp("e.edited_timestamp").alias("edited"),
        "e.difference",
    )


@query(
    "any_delete_flag",
    f"SELECT parent_id AS id, bool_or(is_delete) AS is_deleted FROM ({P.EDITS_SQL}) GROUP BY parent_id",
)
def any_delete_flag(t: Tables) -> DataFrame:
    return project.any_delete_flag(edit_edges(t))


@query(
    "project_reaction",
    f"""
    SELECT {P.EVENT_PARENT_SQL} AS parent_id, 'X' || event_id AS id,
           CASE WHEN event_type <> 'signup' THEN 'A' || user_id ELSE '' END AS author_id,
           'UNKNOWN' AS author_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created,
           upper(event_type) AS content
    FROM events
    """,
)
def project_reaction(t: Tables) -> DataFrame:
    edges = flatten.flatten_connection(P.reaction_pages(t), "node.reactions")
    found = edges.select(F.col("request_id").alias("parent_id"), project.to_reaction().alias("r"))
    return found.select(
        "parent_id",
        "r.id",
        F.col("r.author.id").alias("author_id"),
        F.col("r.author.author_type").alias("author_type"),
        stamp("r.create_timestamp").alias("created"),
        "r.content",
    )


# -- scalars ----------------------------------------------------------------


@query(
    "null_object_defaults",
    f"""
    SELECT id, author_id, author_type, CASE WHEN role <> 'user' THEN 'I' || parent_id ELSE '' END
             AS issue_id, original_commit_id, original_position, position, inline_comment
    FROM ({_REVIEW_COMMENT_SQL})
    """,
)
def null_object_defaults(t: Tables) -> DataFrame:
    """Missing objects: the nobody actor, the empty id, zero positions."""
    issue = F.when(F.col("node.author.login").eqNullSafe("user"), F.lit(None)).otherwise(
        tag("I", "request_id")
    )
    return review_comment_edges(t).select(
        F.col("node.id").alias("id"),
        S.unresolved_actor(F.col("node.author.login")).alias("author"),
        S.empty_if_null(issue).alias("issue_id"),
        F.col("node.originalCommit.id").alias("original_commit_id"),
        S.zero_if_null(F.col("node.originalPosition")).alias("original_position"),
        S.zero_if_null(F.col("node.position")).alias("position"),
        S.inline_comment(F.col("node.originalPosition")).alias("inline_comment"),
    ).select(
        "id", F.col("author.id").alias("author_id"), F.col("author.author_type").alias("author_type"),
        "issue_id", "original_commit_id", "original_position", "position", "inline_comment",
    )


@query("minimized_status", f"SELECT id, minimized_status FROM ({P.COMMENT_SQL})")
def minimized_status(t: Tables) -> DataFrame:
    return pr_comment_edges(t).select(
        F.col("node.id").alias("id"),
        S.minimized_status(F.col("node.isMinimized"), F.col("node.minimizedReason")).alias(
            "minimized_status"
        ),
    )


@query(
    "parse_timestamp",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                WHEN 'view' THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
                WHEN 'purchase' THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S')
           END AS parsed
    FROM events
    """,
)
def parse_timestamp(t: Tables) -> DataFrame:
    """Accepted: Z and an offset with or without colon. Rejected: a fraction,
    no offset."""
    seconds = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    written = (
        F.when(F.col("event_type") == "click", F.concat(seconds, F.lit("Z")))
        .when(F.col("event_type") == "view", F.concat(seconds, F.lit("+02:00")))
        .when(F.col("event_type") == "purchase", F.concat(seconds, F.lit("-0500")))
        .when(F.col("event_type") == "error", F.concat(seconds, F.lit(".250Z")))
        .otherwise(seconds)
    )
    return t.events.select("event_id", stamp(S.parse_timestamp(written)).alias("parsed"))


# -- parents ----------------------------------------------------------------


@query(
    "inherit_parent_keys",
    """
    SELECT c.conv_id || '-' || c.turn AS id, 'PR' || c.conv_id AS pull_request_id,
           'R' || length(p.text) AS repository_id
    FROM conversations c JOIN conversations p
      ON c.conv_id = p.conv_id AND p.turn = 0 AND p.role = 'user'
    """,
)
def inherit_keys(t: Tables) -> DataFrame:
    """Comments of conversations a user opened; the others have no stored parent."""
    parents = t.conversations.filter((F.col("turn") == 0) & (F.col("role") == "user")).select(
        text("conv_id").alias("id"),
        tag("PR", "conv_id").alias("pull_request_id"),
        tag("R", F.length("text")).alias("repository_id"),
    )
    keys = {"pull_request_id": "pull_request_id", "repository_id": "repository_id"}
    owned = inherit_parent_keys(pr_comment_edges(t), parents, keys, ["page_no", "pos"])
    return owned.select(F.col("node.id").alias("id"), "pull_request_id", "repository_id")
