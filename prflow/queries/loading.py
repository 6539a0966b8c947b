"""The loading steps end to end: landed pages and stored documents in, new
documents, lists and late fields out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.operators import actors, discover, project, reconcile
from prflow.plans import loads
from prflow.queries import linking as L
from prflow.queries import reading as R
from prflow.queries import tables as P
from prflow.queries.registry import query
from prflow.queries.tables import Tables, stamp, tag, text


def flat_lists(lists: DataFrame, *fields: str) -> DataFrame:
    """List rows with the items as one text, for comparison."""
    one = (lambda i: F.concat_ws(":", *[i[f] for f in fields])) if fields else (lambda i: i)
    items = F.array_join(F.transform("items", one), ",")
    return lists.select("repository_id", "parent_id", "segment", items.alias("items"))


def empty_counts(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([], "id string, loaded long")


# -- repositories and pull requests -----------------------------------------


@query(
    "load_repositories",
    f"""
    WITH wanted AS ({R._WANTED_SQL}), all_r AS ({P.REPOSITORIES_SQL})
    SELECT r.id, r.name, r.owner,
           CAST(total_pull_requests + CASE WHEN w.name IS NULL THEN 0 ELSE 1 END AS INTEGER)
             AS total_pull_requests,
           CASE WHEN r.owner = 'AFRICA' THEN '2020-01-01 00:00:00'
                ELSE '2024-06-01 12:00:00' END AS inserted,
           CASE WHEN w.name IS NULL THEN '2020-01-01 00:00:00'
                ELSE '2024-06-01 12:00:00' END AS updated
    FROM all_r r LEFT JOIN wanted w ON w.owner = r.owner AND w.name = r.name
    WHERE r.owner = 'AFRICA' OR w.name IS NOT NULL
    """,
)
def load_repositories(t: Tables) -> DataFrame:
    """Step 1: one owner's repositories are stored, the wanted ones landed."""
    every = t.once(P.repositories)
    before = F.lit("2020-01-01 00:00:00").cast("timestamp")
    stored = every.filter(F.col("owner") == "AFRICA").select(
        "*", before.alias("insert_timestamp"), before.alias("update_timestamp")
    )
    node = {"id": F.col("id"), "pullRequests": P.total(F.col("total_pull_requests") + 1)}
    landed = P.pages(
        every, "repository", {"repository": node}, F.col("id"),
        owner=F.col("owner"), name=F.col("name"),
    )
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    after = loads.repositories(landed, stored, R._wanted(t), now)
    return after.select(
        "id",
        "name",
        "owner",
        "total_pull_requests",
        stamp("insert_timestamp").alias("inserted"),
        stamp("update_timestamp").alias("updated"),
    )


def customer_matches(t: Tables) -> DataFrame:
    """Logins found by search: the names of customers outside one segment."""
    data = {
        "search": {
            "nodes": [
                {"id": tag("W", "c_custkey"), "login": F.upper("c_name")},
                {
                    "id": tag("U", "c_custkey"),
                    "login": F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_name")),
                },
            ]
        }
    }
    return actors.login_matches(P.pages(t.customer, "user_search", data, F.col("c_name")))


def pull_request_pages(t: Tables) -> DataFrame:
    node = {
        "id": text("o_orderkey"),
        "createdAt": P.api_time(F.col("o_orderdate")),
        "author": P.only_if(F.col("c_acctbal") >= 0, {"login": F.col("c_name")}, "login string"),
        "authorAssociation": F.col("o_orderpriority"),
        "commits": P.total(F.col("lines")),
        "state": P.pr_state(),
    }
    return P.edge_pages(
        t.once(P.order_rows), "pull_requests", node, F.col("n_name"), F.col("o_orderkey"),
        owner=F.col("r_name"), name=F.col("n_name"),
    )


@query(
    "load_pull_requests",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'R' || c_nationkey AS repository_id,
           CASE WHEN c_acctbal < 0 THEN '' WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name
                ELSE 'U' || c_custkey END AS author_id,
           CASE WHEN c_acctbal < 0 OR c_mktsegment = 'HOUSEHOLD' THEN 'UNKNOWN' ELSE 'USER' END
             AS author_type,
           o_orderpriority AS author_association,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created,
           CAST(lines AS INTEGER) AS total_commits, 'MERGED' AS state
    FROM ({P.ORDER_ROWS_SQL}) WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'
    """,
)
def load_pull_requests(t: Tables) -> DataFrame:
    """Step 2: the urgent ones are stored already."""
    stored = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        text("o_orderkey").alias("id")
    )
    new = loads.pull_requests(pull_request_pages(t), t.once(P.repositories), stored, customer_matches(t))
    columns = [
        "id", "repository_id", "author", "author_association", "create_timestamp",
        "total_commits", "state",
    ]
    return R.flat(new.select(*columns))


# -- lists ------------------------------------------------------------------


def line_pages(t: Tables, shape: str, node: dict) -> DataFrame:
    return P.edge_pages(t.lineitem, shape, node, text("l_orderkey"), F.col("l_linenumber"))


def supplier_types(t: Tables) -> DataFrame:
    """Suppliers in debt are unknown, the others users or bots by nation."""
    typename = F.when(F.col("s_nationkey") > 12, "Bot").otherwise("User")
    node = P.only_if(
        F.col("s_acctbal") >= 0,
        {"__typename": typename, "id": tag("S", "s_suppkey")},
        "__typename string, id string",
    )
    return actors.actor_types(
        P.pages(t.supplier, "node_type", {"node": node}, tag("S", "s_suppkey"))
    )


_SUPPLIER_TYPE_SQL = """
    CASE WHEN s_acctbal < 0 THEN 'UNKNOWN' WHEN s_nationkey > 12 THEN 'BOT' ELSE 'USER' END
"""


@query(
    "load_participants",
    f"""
    WITH once AS (
        SELECT l_orderkey, l_linenumber,
               min({{'id': 'S' || l_suppkey, 'type': {_SUPPLIER_TYPE_SQL}}}) AS item
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey, l_linenumber),
      done AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey
               HAVING count(*) = count(*) FILTER (l_returnflag = 'R'))
    SELECT 'R' || c_nationkey AS repository_id, CAST(l_orderkey AS VARCHAR) AS parent_id,
           CAST(0 AS BIGINT) AS segment, string_agg(item.id || ':' || item.type, ',' ORDER BY l_linenumber) AS items
    FROM once JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    WHERE l_orderkey NOT IN (SELECT l_orderkey FROM done)
    GROUP BY l_orderkey, c_nationkey
    """,
)
def load_participants(t: Tables) -> DataFrame:
    """Step 3: pull requests with only returned items are complete already."""
    loaded = (
        t.lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy(text("l_orderkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("loaded"))
    )
    landed = line_pages(t, "pr_participants", {"id": tag("S", "l_suppkey")})
    lists = loads.participants(landed, t.once(P.pull_requests), loaded, supplier_types(t))
    return flat_lists(lists, "id", "author_type")


@query(
    "load_commit_ids",
    f"""
    SELECT repository_id, id AS parent_id, CAST(0 AS BIGINT) AS segment, items,
           CASE WHEN total_commits = numbers THEN 'LOADED_SUCCESSFULLY' ELSE 'GIT_RETURNED_LESS' END
             AS commit_id_load_status
    FROM ({P.PULL_REQUESTS_SQL}) JOIN
         (SELECT l_orderkey, string_agg('C' || first, ',' ORDER BY l_linenumber) AS items
          FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS first
                FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY l_orderkey)
      ON id = CAST(l_orderkey AS VARCHAR)
    """,
)
def load_commit_ids(t: Tables) -> DataFrame:
    """Step 4: lists with their load status."""
    # part keys padded, so that the smallest text is the smallest key
    padded = F.lpad(text("l_partkey"), 20, "0")
    landed = line_pages(t, "pr_commit_ids", {"commit": {"id": padded}})
    parents = t.once(P.pull_requests)
    lists = loads.commit_ids(landed, parents, empty_counts(t))
    status = loads.commit_status(landed, parents, reconcile.list_counts(lists))
    plain = lists.withColumn("items", F.transform("items", lambda i: tag("C", i.cast("bigint"))))
    return flat_lists(plain).join(status.withColumnRenamed("id", "parent_id"), "parent_id")


def event_parents(t: Tables, declared: str) -> DataFrame:
    """A user's day as a document that declares all its events."""
    return t.events.groupBy(P.event_parent().alias("id"), "user_id").agg(
        F.count(F.lit(1)).cast("int").alias(declared)
    ).select("id", tag("R", "user_id").alias("repository_id"), declared)


def viewed(t: Tables) -> DataFrame:
    return (
        t.events.filter(F.col("event_type") == "view")
        .groupBy(P.event_parent().alias("id"))
        .agg(F.count(F.lit(1)).alias("loaded"))
    )


_NOT_ONLY_VIEWED_SQL = f"""
    SELECT {P.EVENT_PARENT_SQL} FROM events GROUP BY 1
    HAVING count(*) > count(*) FILTER (event_type = 'view')
"""


def editor_matches(t: Tables) -> DataFrame:
    """Logins of editors that a search finds: customers not in debt."""
    data = {
        "search": {
            "nodes": [
                {
                    "id": tag("U", "c_custkey"),
                    "login": F.when(F.col("c_acctbal") >= 0, tag("L", "c_custkey")),
                }
            ]
        }
    }
    return actors.login_matches(P.pages(t.customer, "user_search", data, tag("L", "c_custkey")))


@query(
    "load_edits",
    f"""
    SELECT 'R' || user_id AS repository_id, parent_id, segment,
           string_agg(id || ':' || editor || ':' || edited, ',' ORDER BY event_id) AS items,
           any_value(deleted) AS is_deleted
    FROM (SELECT e.parent_id, e.user_id, e.id, e.edited, CAST(substr(e.id, 2) AS BIGINT) AS event_id,
                 CAST(substr(e.id, 2) AS BIGINT) AS segment,
                 CASE WHEN editor_id LIKE 'L%' AND c_acctbal >= 0 THEN 'U' || e.user_id || ':USER'
                      ELSE editor_id || ':UNKNOWN' END AS editor,
                 bool_or(is_delete) OVER (PARTITION BY e.parent_id) AS deleted
          FROM ({P.EDITS_SQL}) e LEFT JOIN customer ON c_custkey = e.user_id)
    WHERE parent_id IN ({_NOT_ONLY_VIEWED_SQL})
    GROUP BY parent_id, user_id, segment
    """,
)
def load_edits(t: Tables) -> DataFrame:
    """Steps 5, 8, 11, 14, 23: edits by login, deletions, the deletion flag."""
    lists = loads.edits(
        P.edit_pages(t), "pr_edits", event_parents(t, "total_edits"), viewed(t), editor_matches(t)
    )
    shown = lists.withColumn(
        "items",
        F.transform(
            "items",
            lambda i: F.concat_ws(
                ":", i["id"], i["editor"]["id"], i["editor"]["author_type"],
                stamp(i["edited_timestamp"]),
            ),
        ),
    )
    flags = project.deleted_parents(lists).withColumnRenamed("id", "parent_id")
    return flat_lists(shown).join(flags, "parent_id")


def reactor_types(t: Tables) -> DataFrame:
    typename = F.when(F.col("c_acctbal") >= 0, "User").otherwise("Bot")
    node = {"__typename": typename, "id": tag("A", "c_custkey")}
    return actors.actor_types(
        P.pages(t.customer, "node_type", {"node": node}, tag("A", "c_custkey"))
    )


@query(
    "load_reactions",
    f"""
    SELECT 'R' || user_id AS repository_id, parent_id, event_id // 10 AS segment,
           string_agg('X' || event_id || ':' || author || ':' || upper(event_type), ','
                      ORDER BY event_id) AS items
    FROM (SELECT *, {P.EVENT_PARENT_SQL} AS parent_id,
                 CASE WHEN event_type = 'signup' THEN ':UNKNOWN'
                      WHEN c_acctbal >= 0 THEN 'A' || user_id || ':USER'
                      WHEN c_acctbal < 0 THEN 'A' || user_id || ':BOT'
                      ELSE 'A' || user_id || ':UNKNOWN' END AS author
          FROM events LEFT JOIN customer ON c_custkey = user_id)
    WHERE parent_id IN ({_NOT_ONLY_VIEWED_SQL})
    GROUP BY parent_id, user_id, event_id // 10
    """,
)
def load_reactions(t: Tables) -> DataFrame:
    """Steps 6, 9, 12, 15, 24: reactions by node id."""
    lists = loads.reactions(
        P.reaction_pages(t), "pr_reactions", event_parents(t, "total_reactions"), viewed(t),
        reactor_types(t),
    )
    shown = lists.withColumn(
        "items",
        F.transform(
            "items",
            lambda i: F.concat_ws(
                ":", i["id"], i["author"]["id"], i["author"]["author_type"], i["content"]
            ),
        ),
    )
    return flat_lists(shown)


def part_parents(t: Tables, declared: str, count: str) -> DataFrame:
    """Parts as commits that declare something per line item or order."""
    counted = {
        "lines": F.count(F.lit(1)),
        "orders": F.countDistinct("l_orderkey"),
    }[count]
    totals = t.lineitem.groupBy("l_partkey").agg(counted.cast("int").alias(declared))
    return t.part.join(totals, F.col("p_partkey") == F.col("l_partkey")).select(
        tag("C", "p_partkey").alias("id"), tag("R", "p_size").alias("repository_id"), declared
    )


@query(
    "load_commit_pull_request_ids",
    """
    SELECT 'R' || p_size AS repository_id, 'C' || p_partkey AS parent_id,
           l_orderkey // 10 AS segment,
           string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey) AS items
    FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) JOIN part ON p_partkey = l_partkey
    GROUP BY p_partkey, p_size, l_orderkey // 10
    """,
)
def load_commit_pull_request_ids(t: Tables) -> DataFrame:
    """Step 19: the orders of a part."""
    landed = P.edge_pages(
        t.lineitem, "commit_pull_request_ids", {"id": text("l_orderkey")},
        tag("C", "l_partkey"), F.col("l_orderkey"),
    )
    parents = part_parents(t, "total_associated_pull_requests", "orders")
    return flat_lists(loads.commit_pull_request_ids(landed, parents, empty_counts(t)))


@query(
    "load_commit_authors",
    f"""
    WITH authors AS (
        SELECT l_partkey, l_suppkey, l_linenumber, l_orderkey,
               CASE WHEN l_returnflag = 'N' THEN ':UNKNOWN'
                    ELSE 'S' || l_suppkey || ':' || {_SUPPLIER_TYPE_SQL} END AS actor
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
      once AS (
        SELECT l_partkey, l_suppkey,
               min({{'page': l_orderkey, 'id': split_part(actor, ':', 1), 'type': split_part(actor, ':', 2)}}) AS f
        FROM authors GROUP BY l_partkey, l_suppkey)
    SELECT 'R' || p_size AS repository_id, 'C' || p_partkey AS parent_id, f.page // 10 AS segment,
           string_agg(f.id || ':' || f.type, ',' ORDER BY f.page, f.id, f.type) AS items
    FROM once JOIN part ON p_partkey = l_partkey GROUP BY p_partkey, p_size, f.page // 10
    """,
)
def load_commit_authors(t: Tables) -> DataFrame:
    """Step 20: the cursor is the supplier, so an author that comes again on a
    later page counts once."""
    user = P.only_if(F.col("l_returnflag") != "N", {"id": tag("S", "l_suppkey")}, "id string")
    landed = P.pages(
        t.lineitem, "commit_authors",
        {"node": {"authors": {"edges": [{"cursor": text("l_suppkey"), "node": {"user": user}}]}}},
        tag("C", "l_partkey"), F.col("l_orderkey"),
    )
    parents = part_parents(t, "total_authors", "lines")
    lists = loads.commit_authors(landed, parents, empty_counts(t), supplier_types(t))
    return flat_lists(lists, "id", "author_type")


@query(
    "load_user_organizations",
    """
    SELECT CAST(NULL AS VARCHAR) AS repository_id, 'U' || c_custkey AS parent_id,
           CAST(0 AS BIGINT) AS segment, 'G' || c_nationkey AS items
    FROM customer WHERE c_acctbal >= 0
    """,
)
def load_user_organizations(t: Tables) -> DataFrame:
    """Step 31: only users who declare organizations are asked."""
    landed = P.edge_pages(
        t.customer, "user_organization_ids", {"id": tag("G", "c_nationkey")},
        tag("U", "c_custkey"), F.lit(0),
    )
    users = L.user_documents(t)
    return flat_lists(loads.user_organizations(landed, users, empty_counts(t)))


# -- child documents --------------------------------------------------------


def conversation_parents(t: Tables, declared: str) -> DataFrame:
    """A conversation declares its turns; one the user ended declares only one."""
    return P.last_turns(t).select(
        F.col("request_id").alias("id"),
        tag("R", "request_id").alias("repository_id"),
        tag("PR", "request_id").alias("pull_request_id"),
        F.when(F.col("last_role") == "user", 1)
        .otherwise(F.col("last_turn") + 1)
        .cast("int")
        .alias(declared),
    )


def replies(t: Tables, *keys: str) -> DataFrame:
    """Stored children: what the assistant said."""
    return t.conversations.filter(F.col("role") == "assistant").select(
        P.turn_id().alias("id"), *[text("conv_id").alias(k) for k in keys]
    )


# a parent is incomplete when it declares more than its stored replies
_CHILDREN_SQL = f"""
    SELECT c.* FROM ({P.COMMENT_SQL}) c JOIN
      (SELECT l.id, CASE WHEN last_role = 'user' THEN 1 ELSE last_turn + 1 END AS declared,
              (SELECT count(*) FROM conversations r
               WHERE r.role = 'assistant' AND CAST(r.conv_id AS VARCHAR) = l.id) AS loaded
       FROM ({P.LAST_TURNS_SQL}) l) p
      ON c.parent_id = p.id AND declared > loaded
    WHERE role <> 'assistant'
"""


def login_of_roles(t: Tables) -> DataFrame:
    """The role ``user`` is found by search, by way of its conversations."""
    data = {"search": {"nodes": [{"id": tag("U-", "role"), "login": F.col("role")}]}}
    found = t.conversations.filter(F.col("role") == "user")
    return actors.login_matches(
        P.pages(found, "user_search", data, F.col("role"), F.col("conv_id"))
    )


_ROLE_AUTHOR_SQL = """
    CASE WHEN role = 'user' THEN 'U-user' ELSE '' END AS author_id,
    CASE WHEN role = 'user' THEN 'USER' ELSE 'UNKNOWN' END AS author_type
"""


@query(
    "load_pr_comments",
    f"""
    SELECT id, parent_id AS pull_request_id, 'R' || parent_id AS repository_id, {_ROLE_AUTHOR_SQL},
           created, text, minimized_status, '' AS issue_id
    FROM ({_CHILDREN_SQL})
    """,
)
def load_pr_comments(t: Tables) -> DataFrame:
    """Step 7: comments of incomplete pull requests that are not stored."""
    children = loads.pr_comments(
        P.comment_pages(t, "pr_comments"),
        conversation_parents(t, "total_comments"),
        replies(t, "pull_request_id"),
        login_of_roles(t),
    )
    return R.flat(
        children.documents.drop(
            "author_association", "total_edits", "total_reactions", "object_type"
        )
    )


@query(
    "load_comment_ids",
    f"""
    SELECT 'R' || p.id AS repository_id, p.id AS parent_id, CAST(turn // 10 AS BIGINT) AS segment,
           string_agg(conv_id || '-' || turn, ',' ORDER BY turn) AS items
    FROM conversations JOIN (SELECT DISTINCT parent_id AS id FROM ({_CHILDREN_SQL})) p
      ON p.id = CAST(conv_id AS VARCHAR)
    GROUP BY p.id, turn // 10
    """,
)
def load_comment_ids(t: Tables) -> DataFrame:
    """Step 7: the id lists of the same pull requests."""
    children = loads.pr_comments(
        P.comment_pages(t, "pr_comments"),
        conversation_parents(t, "total_comments"),
        replies(t, "pull_request_id"),
        login_of_roles(t),
    )
    return flat_lists(children.ids)


@query(
    "load_reviews",
    f"""
    SELECT id, parent_id AS pull_request_id, 'R' || parent_id AS repository_id, {_ROLE_AUTHOR_SQL},
           created, text, role AS state, CAST(turn + 1 AS INTEGER) AS total_comments
    FROM ({_CHILDREN_SQL})
    """,
)
def load_reviews(t: Tables) -> DataFrame:
    """Step 10."""
    node = {
        k: v for k, v in P.comment_fields().items() if k not in ("isMinimized", "minimizedReason")
    } | {"comments": P.total(F.col("turn") + 1), "state": F.col("role")}
    landed = P.edge_pages(t.conversations, "reviews", node, text("conv_id"), F.col("turn"))
    children = loads.reviews(
        landed,
        conversation_parents(t, "total_reviews"),
        replies(t, "pull_request_id"),
        login_of_roles(t),
    )
    columns = [
        "id", "pull_request_id", "repository_id", "author", "create_timestamp", "text", "state",
        "total_comments",
    ]
    return R.flat(children.documents.select(*columns))


@query(
    "load_review_comments",
    f"""
    SELECT id, parent_id AS pull_request_review_id, 'PR' || parent_id AS pull_request_id,
           'R' || parent_id AS repository_id, {_ROLE_AUTHOR_SQL}, created, text, minimized_status,
           turn > 0 AS inline_comment
    FROM ({_CHILDREN_SQL})
    """,
)
def load_review_comments(t: Tables) -> DataFrame:
    """Step 13: the pull request comes from the review."""
    landed = P.comment_pages(t, "review_comments", originalPosition=F.col("turn"))
    children = loads.review_comments(
        landed,
        conversation_parents(t, "total_comments"),
        replies(t, "pull_request_review_id"),
        login_of_roles(t),
    )
    columns = [
        "id", "pull_request_review_id", "pull_request_id", "repository_id", "author",
        "create_timestamp", "text", "minimized_status", "inline_comment",
    ]
    return R.flat(children.documents.select(*columns))


@query(
    "load_commit_comments",
    f"""
    SELECT id, parent_id AS commit_id, 'R' || parent_id AS repository_id, {_ROLE_AUTHOR_SQL},
           created, text, role AS path, CAST(turn AS INTEGER) AS position, minimized_status
    FROM ({_CHILDREN_SQL})
    """,
)
def load_commit_comments(t: Tables) -> DataFrame:
    """Step 22: the commit's list decides whether it is incomplete."""
    landed = P.comment_pages(t, "commit_comments", path=F.col("role"), position=F.col("turn"))
    stored = replies(t, "commit_id")
    children = loads.commit_comments(
        landed,
        conversation_parents(t, "total_comments"),
        reconcile.child_counts(stored, "commit_id"),
        stored,
        login_of_roles(t),
    )
    columns = [
        "id", "commit_id", "repository_id", "author", "create_timestamp", "text", "path",
        "position", "minimized_status",
    ]
    return R.flat(children.documents.select(*columns))


@query(
    "load_check_suites",
    """
    SELECT l_partkey || '-' || l_suppkey AS id, 'C' || l_partkey AS commit_id,
           'R' || l_suppkey AS repository_id, min(l_orderkey) AS first_page
    FROM lineitem
    WHERE l_partkey || '-' || l_suppkey NOT IN
          (SELECT l_partkey || '-' || l_suppkey FROM lineitem WHERE l_returnflag = 'R')
    GROUP BY l_partkey, l_suppkey
    """,
)
def load_check_suites(t: Tables) -> DataFrame:
    """Step 21: suites seen before with a returned item are stored. The branch
    shows which page a suite was taken from."""
    node = {
        "id": F.concat_ws("-", text("l_partkey"), text("l_suppkey")),
        "branch": {"id": text("l_orderkey")},
        "commit": {"id": tag("C", "l_partkey")},
        "repository": {"id": tag("R", "l_suppkey")},
    }
    landed = P.edge_pages(
        t.lineitem, "check_suites", node, tag("C", "l_partkey"), F.col("l_orderkey")
    )
    stored = t.lineitem.filter(F.col("l_returnflag") == "R").select(
        F.concat_ws("-", text("l_partkey"), text("l_suppkey")).alias("id")
    )
    parents = part_parents(t, "total_check_suites", "lines")
    children = loads.check_suites(landed, parents, empty_counts(t), stored)
    return children.documents.select(
        "id", "commit_id", "repository_id", F.col("branch_id").cast("bigint").alias("first_page")
    )


# -- referenced documents ---------------------------------------------------


@query(
    "load_commits",
    f"""
    WITH refs AS (
        SELECT first AS p_partkey, min(c_nationkey) AS nation
        FROM (SELECT l_orderkey, min(l_partkey) AS first FROM lineitem GROUP BY l_orderkey, l_linenumber)
        JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        GROUP BY first)
    SELECT 'C' || p_partkey AS id, 'R' || nation AS repository_id,
           CASE WHEN p_type <> 'ECONOMY' THEN p_brand ELSE '' END AS author_id,
           CASE WHEN p_type <> 'ECONOMY' THEN 'USER' ELSE 'UNKNOWN' END AS author_type,
           CASE WHEN p_size <= 40 THEN p_type ELSE '' END AS committer_id,
           'UNKNOWN' AS committer_type, p_name AS message_headline,
           CAST(len(string_split(p_name, ' ')) AS INTEGER) AS entries
    FROM part JOIN refs USING (p_partkey) WHERE p_size > 25
    """,
)
def load_commits(t: Tables) -> DataFrame:
    """Steps 16, 17, 18: unsaved commits of pull requests; a commit belongs to
    the first repository in the list that refers to it."""
    lists = P.with_repository(t.once(P.commit_lists), t.once(P.pull_requests))
    ids = actors.distinct_ids(lists.select("repository_id", F.explode("items").alias("id")))
    scope = t.nation.select(tag("R", "n_nationkey").alias("id"), F.col("n_nationkey").alias("place"))
    stored = t.part.filter(F.col("p_size") <= 25).select(tag("C", "p_partkey").alias("id"))
    brand = {"__typename": F.lit("User"), "id": F.col("p_brand")}
    types = actors.actor_types(P.pages(t.part, "node_type", {"node": brand}, F.col("p_brand")))
    new = loads.commits(P.commit_pages(t), loads.scoped_references(ids, scope), stored, types)
    shown = new.select(
        "id", "repository_id", "author", "committer", "message_headline",
        F.size("entries").alias("entries"),
    )
    return R.flat(shown, ("author", "committer"))


@query(
    "load_users",
    f"""
    SELECT u.id, c_name AS login, c_nationkey AS total_organizations
    FROM ({L._UNSAVED_USERS_SQL}) u JOIN customer ON u.id = 'U' || c_custkey
    """,
)
def load_users(t: Tables) -> DataFrame:
    """Steps 25 to 30: users that are referenced and not stored."""
    node = {
        "id": tag("U", "c_custkey"),
        "login": F.col("c_name"),
        "organizations": P.total(F.col("c_nationkey")),
    }
    landed = P.pages(t.customer, "user", {"node": node}, tag("U", "c_custkey"))
    references = actors.document_users(t.once(P.pull_requests), {})
    new = loads.users(landed, references, L.stored_users(t))
    return new.select("id", "login", "total_organizations")


@query(
    "load_organizations",
    """
    SELECT 'G' || n_nationkey AS id, n_name AS name, r_name AS description
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name NOT IN ('ASIA', 'EUROPE')
      AND n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal >= 0)
    """,
)
def load_organizations(t: Tables) -> DataFrame:
    """Step 32: nations as organizations of customers; parts name others that
    are not found."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    node = {
        "id": tag("G", "n_nationkey"), "name": F.col("n_name"), "description": F.col("r_name"),
    }
    landed = P.pages(nations, "organization", {"node": node}, tag("G", "n_nationkey"))
    commits = project.to_commit(
        project.node_pages(P.commit_pages(t)).withColumn("repository_id", F.lit("R0"))
    )
    references = discover.referenced_organizations(
        L.user_documents(t), L.user_organization_lists(t), commits
    )
    stored = nations.filter(F.col("r_name").isin(*P.EXACT_OWNERS))
    new = loads.organizations(
        landed, references, stored.select(tag("G", "n_nationkey").alias("id"))
    )
    return new.select("id", "name", "description")
