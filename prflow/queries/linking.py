"""Actors, discovery, keyed writes, counts and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.functions import scalars as S
from prflow import schemas
from prflow.operators import actors, discover, flatten, project, reconcile
from prflow.plans.steps import STEP_PARENTS
from prflow.queries import reading as R
from prflow.queries import tables as P
from prflow.queries.registry import query
from prflow.queries.tables import Tables, stamp, tag, text
from prflow.session import new_work_folder
from prflow.sinks import keyed
from prflow.sources import documents
from prflow.streaming.ingest import ingest_stream, ingested

# -- actors -----------------------------------------------------------------


def node_type_pages(t: Tables) -> DataFrame:
    """Type pages of the customers; those in debt have a NULL node."""
    typename = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "Bot")
        .when(F.col("c_mktsegment") == "BUILDING", "user")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "Organization")
        .when(F.col("c_mktsegment") == "FURNITURE", "EnterpriseUserAccount")
        .otherwise("Robot")
    )
    node = P.only_if(
        F.col("c_acctbal") >= 0,
        {"__typename": typename, "id": text("c_custkey")},
        "__typename string, id string",
    )
    return P.pages(t.customer, "node_type", {"node": node}, text("c_custkey"))


@query(
    "actor_by_id",
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS author_id,
           CASE WHEN c_acctbal < 0 THEN 'UNKNOWN'
                WHEN c_mktsegment = 'MACHINERY' THEN 'BOT' WHEN c_mktsegment = 'BUILDING' THEN 'USER'
                WHEN c_mktsegment = 'AUTOMOBILE' THEN 'ORGANIZATION'
                WHEN c_mktsegment = 'FURNITURE' THEN 'ENTERPRISE_USER_ACCOUNT'
                ELSE 'UNKNOWN' END AS author_type
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def actor_by_id(t: Tables) -> DataFrame:
    types = actors.actor_types(node_type_pages(t))
    found = actors.resolve_by_id(t.orders, text("o_custkey"), types, "author", ["o_orderkey"])
    return found.select(
        "o_orderkey",
        F.col("author.id").alias("author_id"),
        F.col("author.author_type").alias("author_type"),
    )


def search_pages(t: Tables) -> DataFrame:
    """A document is a page of a search for its source: a hit in the wrong
    case, one without a login, and the document itself when it is not German."""
    data = {
        "search": {
            "nodes": [
                {"id": tag("W", "doc_id"), "login": F.upper("source")},
                {"id": tag("N", "doc_id")},
                {
                    "id": tag("D", "doc_id"),
                    "login": F.when(F.col("lang") != "de", F.col("source")),
                },
            ]
        }
    }
    return P.pages(t.documents, "user_search", data, F.col("source"), F.col("doc_id"))


@query(
    "actor_by_login",
    """
    SELECT doc_id,
           CASE WHEN lang = 'es' THEN '' WHEN lang = 'fr' THEN upper(source)
                ELSE coalesce('D' || first, source) END AS author_id,
           CASE WHEN lang IN ('es', 'fr') OR first IS NULL THEN 'UNKNOWN' ELSE 'USER' END
             AS author_type
    FROM documents LEFT JOIN
         (SELECT source, min(doc_id) AS first FROM documents WHERE lang <> 'de' GROUP BY source) f
      USING (source)
    """,
)
def actor_by_login(t: Tables) -> DataFrame:
    """French documents ask in the wrong case, Spanish ones for nobody."""
    matches = actors.login_matches(search_pages(t))
    wanted = (
        F.when(F.col("lang") == "fr", F.upper("source"))
        .when(F.col("lang") != "es", F.col("source"))
    )
    rows = t.documents.select("doc_id", "lang", "source")
    found = actors.resolve_by_login(rows, wanted, matches, "author", ["doc_id"])
    return found.select(
        "doc_id",
        F.col("author.id").alias("author_id"),
        F.col("author.author_type").alias("author_type"),
    )


def _event_actor(prefix: str):
    """Errors are made by bots, sign-ups by nobody known, the rest by users."""
    kind = (
        F.when(F.col("event_type") == "error", "BOT")
        .when(F.col("event_type") == "signup", "UNKNOWN")
        .otherwise("USER")
    )
    return F.struct(tag(prefix, "user_id").alias("id"), kind.alias("author_type"))


def edit_lists(t: Tables) -> DataFrame:
    """Stored edit lists: one event per page, stitched per user and day."""
    return _event_lists(t, F.struct(_event_actor("E").alias("editor")))


def reaction_lists(t: Tables) -> DataFrame:
    return _event_lists(t, F.struct(_event_actor("A").alias("author")))


def _event_lists(t: Tables, item) -> DataFrame:
    edges = t.events.select(
        P.event_parent().alias("parent_id"),
        F.col("event_id").alias("page_no"),
        F.lit(0).alias("pos"),
        F.lit(None).cast("string").alias("cursor"),
        item.alias("item"),
    )
    return flatten.stitch_pages(edges, F.col("item"), ["parent_id"], pages_per_segment=1000)


def participant_lists(t: Tables) -> DataFrame:
    """Participants of pull requests: the suppliers of their line items."""
    kind = F.when(F.col("l_returnflag") == "N", "BOT").otherwise("USER")
    edges = t.lineitem.select(
        text("l_orderkey").alias("parent_id"),
        F.col("l_linenumber").cast("bigint").alias("page_no"),
        F.lit(0).alias("pos"),
        F.lit(None).cast("string").alias("cursor"),
        F.struct(tag("S", "l_suppkey").alias("id"), kind.alias("author_type")).alias("item"),
    )
    return flatten.stitch_pages(edges, F.col("item"), ["parent_id"], pages_per_segment=4)


_EVENT_USERS_SQL = """
    SELECT prefix || user_id AS id FROM events, (VALUES ('E'), ('A')) p(prefix)
    WHERE event_type NOT IN ('error', 'signup')
"""
# of the copies of a page the smallest actor is kept
_PARTICIPANTS_SQL = """
    SELECT l_orderkey, l_linenumber, actor.id AS id, actor.author_type AS author_type
    FROM (SELECT l_orderkey, l_linenumber,
                 min({'id': 'S' || l_suppkey,
                      'author_type': CASE WHEN l_returnflag = 'N' THEN 'BOT' ELSE 'USER' END}) AS actor
          FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""


@query(
    "distinct_actors",
    f"""
    SELECT author_id AS id FROM ({P.PULL_REQUESTS_SQL}) WHERE author_type = 'USER'
    UNION {_EVENT_USERS_SQL}
    """,
)
def distinct_actors(t: Tables) -> DataFrame:
    """Authors, editors and reaction authors of documents."""
    lists = {"edits": edit_lists(t), "reactions": reaction_lists(t)}
    return actors.document_users(t.once(P.pull_requests), lists)


@query(
    "actors_of_pull_requests",
    f"""
    SELECT author_id AS id FROM ({P.PULL_REQUESTS_SQL}) WHERE author_type = 'USER'
    UNION {_EVENT_USERS_SQL}
    UNION SELECT id FROM ({_PARTICIPANTS_SQL}) WHERE author_type = 'USER'
    """,
)
def actors_of_pull_requests(t: Tables) -> DataFrame:
    """The same plus participants."""
    lists = {
        "participants": participant_lists(t),
        "edits": edit_lists(t),
        "reactions": reaction_lists(t),
    }
    return actors.document_users(t.once(P.pull_requests), lists)


@query(
    "actors_of_commits",
    """
    SELECT 'B' || p_brand AS id FROM part WHERE p_type <> 'PROMO'
    UNION SELECT 'T' || p_size FROM part WHERE p_size <= 40
    UNION SELECT 'S' || l_suppkey FROM lineitem WHERE l_returnflag <> 'N'
    """,
)
def actors_of_commits(t: Tables) -> DataFrame:
    """Author, committer and co-authors of commits."""

    def actor(actor_id, is_user):
        kind = F.when(is_user, "USER").otherwise("BOT")
        return F.struct(actor_id.alias("id"), kind.alias("author_type"))

    commits = t.part.select(
        actor(tag("B", "p_brand"), F.col("p_type") != "PROMO").alias("author"),
        actor(tag("T", "p_size"), F.col("p_size") <= 40).alias("committer"),
    )
    authors = t.lineitem.select(
        tag("C", "l_partkey").alias("parent_id"),
        F.array(actor(tag("S", "l_suppkey"), F.col("l_returnflag") != "N")).alias("items"),
    )
    return actors.document_users(commits, {"authors": authors}, ["author", "committer"])


# -- discovery --------------------------------------------------------------


def stored_users(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_acctbal") > 0).select(tag("U", "c_custkey").alias("id"))


def stored_commits(t: Tables) -> DataFrame:
    """Stored commits: small parts, and the suppliers not in debt."""
    parts = t.part.filter(F.col("p_size") <= 25).select(tag("C", "p_partkey").alias("id"))
    suppliers = t.supplier.filter(F.col("s_acctbal") > 0).select(tag("V", "s_suppkey").alias("id"))
    return parts.unionAll(suppliers)


def _single_references(t: Tables) -> DataFrame:
    """Reviews name one commit each, here the supplier of an open line item."""
    reviews = t.lineitem.select(
        F.when(F.col("l_linestatus") == "O", tag("V", "l_suppkey")).alias("commit_id")
    )
    return discover.ids_in_column(reviews, "commit_id")


_UNSAVED_MULTI_SQL = """
    SELECT DISTINCT 'C' || first AS id
    FROM (SELECT min(l_partkey) AS first FROM lineitem GROUP BY l_orderkey, l_linenumber)
    WHERE first NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)
"""
_UNSAVED_SINGLE_SQL = """
    SELECT DISTINCT 'V' || l_suppkey AS id FROM lineitem
    WHERE l_linestatus = 'O' AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
"""
_UNSAVED_USERS_SQL = f"""
    SELECT DISTINCT author_id AS id FROM ({P.PULL_REQUESTS_SQL})
    WHERE author_type = 'USER'
      AND author_id NOT IN (SELECT 'U' || c_custkey FROM customer WHERE c_acctbal > 0)
"""


@query("unsaved_users", _UNSAVED_USERS_SQL)
def unsaved_users(t: Tables) -> DataFrame:
    users = actors.document_users(t.once(P.pull_requests), {})
    return discover.unsaved(users, stored_users(t))


@query("unsaved_commits_multi", _UNSAVED_MULTI_SQL)
def unsaved_commits_multi(t: Tables) -> DataFrame:
    """From the commit lists of pull requests."""
    return discover.unsaved(discover.ids_in_lists(t.once(P.commit_lists)), stored_commits(t))


@query("unsaved_commits_single", _UNSAVED_SINGLE_SQL)
def unsaved_commits_single(t: Tables) -> DataFrame:
    """From the one commit a review names."""
    return discover.unsaved(_single_references(t), stored_commits(t))


@query("unsaved_commits_all", f"{_UNSAVED_MULTI_SQL} UNION {_UNSAVED_SINGLE_SQL}")
def unsaved_commits_all(t: Tables) -> DataFrame:
    """From all referencing documents, in one job."""
    references = actors.distinct_ids(
        discover.ids_in_lists(t.once(P.commit_lists)), _single_references(t)
    )
    return discover.unsaved(references, stored_commits(t))


@query(
    "unsaved_counts",
    f"""
    SELECT 'COMMIT' AS kind, count(*) AS unsaved
    FROM ({_UNSAVED_MULTI_SQL} UNION {_UNSAVED_SINGLE_SQL})
    UNION ALL SELECT 'USER', count(*) FROM ({_UNSAVED_USERS_SQL})
    """,
)
def unsaved_counts(t: Tables) -> DataFrame:
    references = actors.distinct_ids(
        discover.ids_in_lists(t.once(P.commit_lists)), _single_references(t)
    )
    users = actors.document_users(t.once(P.pull_requests), {})
    commits = discover.unsaved_count(references, stored_commits(t))
    left = discover.unsaved_count(users, stored_users(t))
    return commits.select(F.lit("COMMIT").alias("kind"), "unsaved").unionAll(
        left.select(F.lit("USER").alias("kind"), "unsaved")
    )


def user_documents(t: Tables) -> DataFrame:
    """Customers as users; those in debt declare no organization."""
    return t.customer.select(
        tag("U", "c_custkey").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey") + 1).otherwise(0).alias(
            "total_organizations"
        ),
        "c_nationkey",
    )


def user_organization_lists(t: Tables) -> DataFrame:
    """One organization per user, also of those who declare none."""
    return user_documents(t).select(
        F.col("id").alias("parent_id"),
        F.lit(0).cast("bigint").alias("segment"),
        F.array(tag("G", "c_nationkey")).alias("items"),
    )


@query(
    "unsaved_organizations",
    """
    SELECT id FROM (
        SELECT 'G' || c_nationkey AS id FROM customer WHERE c_acctbal >= 0
        UNION SELECT 'O' || p_size FROM part WHERE p_type <> 'LARGE')
    WHERE id NOT IN (SELECT 'G' || n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                     WHERE r_name IN ('ASIA', 'EUROPE'))
    """,
)
def unsaved_organizations(t: Tables) -> DataFrame:
    """Of users who declare any and of commits; stored are those of two owners."""
    references = discover.referenced_organizations(
        user_documents(t), user_organization_lists(t), R.commits(t)
    )
    stored = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).filter(
        F.col("r_name").isin(*P.EXACT_OWNERS)
    )
    return discover.unsaved(references, stored.select(tag("G", "n_nationkey").alias("id")))


@query(
    "not_found_ids",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def not_found_ids(t: Tables) -> DataFrame:
    """Every document was asked for; the labelled ones were returned."""
    requested = t.documents.select(text("doc_id").alias("id"))
    node = {"id": text("doc_id"), "name": tag("quality ", "quality")}
    landed = P.pages(t.labels, "organization", {"node": node}, text("doc_id"))
    return discover.not_found(requested, project.node_pages(landed), "request_id")


# -- keyed writes -----------------------------------------------------------


@query(
    "insert_if_absent",
    f"""
    SELECT * EXCLUDE (place, first_run, l_orderkey) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY first_run DESC, l_orderkey,
               total_check_runs, total_matching_pull_requests, created, conclusion, branch_id) AS place
      FROM (SELECT s.*, state = 'F' AS first_run
            FROM ({R.CHECK_SUITES_SQL.replace("FROM lineitem", ", l_orderkey FROM lineitem")}) s))
    WHERE place = 1
    """,
)
def insert_if_absent(t: Tables) -> DataFrame:
    """Finished suites landed in a first run, all others in a second: the
    stored version stays, and of several new versions the first is taken."""
    suites = project.to_check_suite(R.check_suite_edges(t), keep=["page_no"])
    order = [
        "page_no", "total_check_runs", "total_matching_pull_requests", "create_timestamp",
        "conclusion", "branch_id",
    ]
    first = suites.filter(F.col("state") == "F")
    second = suites.filter(F.col("state") == "O")
    stored = keyed.first_versions(first, ["id"], order).drop("page_no")
    return R.flat(keyed.insert_if_absent(stored, second, order))


@query(
    "set_fields",
    f"""
    SELECT id, state, total_commits,
           CASE WHEN returned > 0 THEN CAST(returned AS INTEGER) ELSE total_participants END
             AS total_participants,
           CASE WHEN returned > 0 THEN CASE WHEN returned = total_commits THEN 'LOADED_SUCCESSFULLY'
                                            ELSE 'GIT_RETURNED_LESS' END END AS commit_id_load_status
    FROM ({P.PULL_REQUESTS_SQL}) p LEFT JOIN
         (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS returned
          FROM lineitem GROUP BY l_orderkey) l ON p.id = CAST(l_orderkey AS VARCHAR)
    """,
)
def set_fields(t: Tables) -> DataFrame:
    """Pull requests with returned items get a new count and a load status."""
    target = t.once(P.pull_requests).select(
        "id", "repository_id", "state", "total_commits", "total_participants"
    )
    returned = (
        t.lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy(text("l_orderkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("loaded"))
    )
    updates = (
        target.select("id", "total_commits")
        .join(returned, "id")
        .select(
            "id",
            F.col("loaded").cast("int").alias("total_participants"),
            S.load_status(F.col("total_commits"), F.col("loaded")).alias("commit_id_load_status"),
        )
    )
    changed = keyed.set_fields(target, updates, ["total_participants", "commit_id_load_status"])
    return changed.drop("repository_id")


@query(
    "repository_upsert",
    f"""
    SELECT id, name, owner,
           CASE WHEN owner IN ('AFRICA') THEN total_pull_requests ELSE total_pull_requests + 1 END
             AS total_pull_requests,
           CASE WHEN owner IN ('AFRICA', 'AMERICA', 'ASIA') THEN '2020-01-01 00:00:00'
                ELSE '2024-06-01 12:00:00' END AS inserted,
           CASE WHEN owner = 'AFRICA' THEN '2020-01-01 00:00:00'
                ELSE '2024-06-01 12:00:00' END AS updated,
           'REPOSITORY' AS object_type
    FROM ({P.REPOSITORIES_SQL})
    """,
)
def repository_upsert(t: Tables) -> DataFrame:
    """Three owners are stored; all but the first are seen again, with one
    pull request more."""
    repositories = t.once(P.repositories)
    before = F.lit("2020-01-01 00:00:00").cast("timestamp")
    stored = repositories.filter(F.col("owner").isin("AFRICA", "AMERICA", "ASIA")).select(
        "*", before.alias("insert_timestamp"), before.alias("update_timestamp")
    )
    incoming = repositories.filter(F.col("owner") != "AFRICA").withColumn(
        "total_pull_requests", F.col("total_pull_requests") + 1
    )
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    return keyed.upsert_repositories(stored, incoming, now).select(
        "id",
        "name",
        "owner",
        "total_pull_requests",
        stamp("insert_timestamp").alias("inserted"),
        stamp("update_timestamp").alias("updated"),
        "object_type",
    )


@query(
    "stream_ingest",
    f"""
    SELECT id, parent_id AS pull_request_id, parent_id AS repository_id, author_id, author_type,
           author_association, created, text, minimized_status,
           CASE WHEN role <> 'user' THEN 'I' || parent_id ELSE '' END AS issue_id,
           total_edits, total_reactions, 'PULL_REQUEST_COMMENT' AS object_type
    FROM ({P.COMMENT_SQL})
    """,
)
def stream_ingest(t: Tables) -> DataFrame:
    """Turns land as JSON pages, are ingested, land again and are ingested
    again: every comment is stored once."""
    work = new_work_folder(t.spark, "stream")
    landing, target = f"{work}/landing", f"{work}/documents"
    issue = P.only_if(F.col("role") != "user", {"id": tag("I", "conv_id")}, "id string")
    landed = P.comment_pages(t, "pr_comments", issue=issue)

    def to_documents(accepted: DataFrame) -> DataFrame:
        edges = flatten.flatten_connection(accepted, "node.comments")
        owned = edges.withColumn("pull_request_id", F.col("request_id")).withColumn(
            "repository_id", F.col("request_id")
        )
        return project.to_pr_comment(owned, keep=["page_no", "pos"])

    for _ in range(2):
        landed.write.mode("append").json(f"{landing}/pr_comments")
        ingest_stream(t.spark, landing, "pr_comments", to_documents, target, f"{work}/checkpoint")
    return R.flat(ingested(t.spark, target, "pr_comments", schemas.document_schema("PULL_REQUEST_COMMENT")))


# -- counts -----------------------------------------------------------------


@query(
    "count_by_repository_type",
    f"""
    SELECT repository_id, 'PULL_REQUEST' AS object_type, count(*) AS documents
    FROM ({P.PULL_REQUESTS_SQL}) GROUP BY repository_id
    UNION ALL SELECT 'R' || l_suppkey, 'CHECK_SUITE', count(*) FROM lineitem GROUP BY l_suppkey
    UNION ALL SELECT 'R0', 'COMMIT', count(*) FROM part
    """,
)
def count_by_repository_type(t: Tables) -> DataFrame:
    columns = ["repository_id", "object_type"]
    documents = (
        t.once(P.pull_requests)
        .select(*columns)
        .unionAll(project.to_check_suite(R.check_suite_edges(t)).select(*columns))
        .unionAll(R.commits(t).select(*columns))
    )
    return reconcile.documents_per_repository(documents)


@query(
    "count_children",
    "SELECT CAST(conv_id AS VARCHAR) AS id, count(*) AS loaded FROM conversations GROUP BY conv_id",
)
def count_children(t: Tables) -> DataFrame:
    return reconcile.child_counts(comments(t), "pull_request_id")


def comments(t: Tables) -> DataFrame:
    owned = R.pr_comment_edges(t).withColumn("pull_request_id", F.col("request_id"))
    return project.to_pr_comment(owned.withColumn("repository_id", F.lit("R0")))


@query(
    "incomplete_parents_child_table",
    f"""
    SELECT id, CAST(last_turn + 2 AS INTEGER) AS total_comments, turns AS loaded
    FROM ({P.LAST_TURNS_SQL}) WHERE last_role = 'user'
    """,
)
def incomplete_parents_child_table(t: Tables) -> DataFrame:
    """A conversation ending with the user declares one more turn."""
    owed = F.when(F.col("last_role") == "user", F.lit(1)).otherwise(F.lit(0))
    parents = P.last_turns(t).select(
        F.col("request_id").alias("id"),
        (F.col("last_turn") + 1 + owed).cast("int").alias("total_comments"),
    )
    counts = reconcile.child_counts(comments(t), "pull_request_id")
    return reconcile.incomplete_parents(parents, "total_comments", counts)


@query(
    "incomplete_parents_embedded",
    f"""
    SELECT id, repository_id, total_commits, numbers AS loaded FROM ({P.PULL_REQUESTS_SQL})
    WHERE total_commits > numbers
    """,
)
def incomplete_parents_embedded(t: Tables) -> DataFrame:
    """Pull requests that declare more commits than their list has."""
    counts = reconcile.list_counts(t.once(P.commit_lists))
    found = reconcile.incomplete_parents(t.once(P.pull_requests), "total_commits", counts)
    return found.select("id", "repository_id", "total_commits", "loaded")


def _status_sql() -> str:
    return f"""
        SELECT *, CASE WHEN total_commits = numbers THEN 'LOADED_SUCCESSFULLY'
                       ELSE 'GIT_RETURNED_LESS' END AS commit_id_load_status
        FROM ({P.PULL_REQUESTS_SQL})
    """


@query("commit_load_status", f"SELECT id, commit_id_load_status FROM ({_status_sql()})")
def commit_load_status(t: Tables) -> DataFrame:
    return reconcile.commit_load_status(t.once(P.pull_requests), reconcile.list_counts(t.once(P.commit_lists)))


@query(
    "expected_totals",
    f"""
    SELECT repository_id, CAST(sum(total_commits) AS BIGINT) AS total_commits,
           CAST(sum(total_participants) AS BIGINT) AS total_participants
    FROM ({P.PULL_REQUESTS_SQL}) GROUP BY repository_id
    """,
)
def expected_totals(t: Tables) -> DataFrame:
    return reconcile.expected_totals(t.once(P.pull_requests), "total_commits", "total_participants")


@query(
    "actual_totals",
    f"""
    SELECT repository_id, CAST(sum(numbers) AS BIGINT) AS actual FROM ({P.PULL_REQUESTS_SQL})
    WHERE numbers > 0 GROUP BY repository_id
    """,
)
def actual_totals(t: Tables) -> DataFrame:
    lists = P.with_repository(t.once(P.commit_lists), t.once(P.pull_requests))
    return reconcile.actual_list_totals(lists)


@query(
    "actual_totals_override",
    f"""
    SELECT repository_id,
           CAST(sum(CASE WHEN commit_id_load_status = 'GIT_RETURNED_LESS' THEN total_commits
                         ELSE numbers END) AS BIGINT) AS actual
    FROM ({_status_sql()}) GROUP BY repository_id
    """,
)
def actual_totals_override(t: Tables) -> DataFrame:
    documents = t.once(P.pull_requests)
    counts = reconcile.list_counts(t.once(P.commit_lists))
    status = reconcile.commit_load_status(documents, counts)
    evaluated = keyed.set_fields(documents, status, ["commit_id_load_status"])
    return reconcile.actual_commit_totals(evaluated, counts)


@query(
    "user_organization_totals",
    """
    SELECT CAST(sum(CASE WHEN c_acctbal >= 0 THEN c_nationkey + 1 ELSE 0 END) AS BIGINT) AS expected,
           count(*) AS actual
    FROM customer
    """,
)
def user_organization_totals(t: Tables) -> DataFrame:
    return reconcile.global_totals(
        user_documents(t), "total_organizations", user_organization_lists(t)
    )


# -- reconciliation ---------------------------------------------------------


def stored_pull_requests(t: Tables) -> DataFrame:
    """Loaded pull requests: all of most owners, of AMERICA only the merged."""
    return P.as_pull_requests(t.once(P.order_rows).filter(_is_stored()))


def _is_stored():
    return (F.col("r_name") != "AMERICA") | (F.col("o_orderstatus") == "F")


def report(t: Tables) -> DataFrame:
    """Repositories, pull requests, participants and commit ids, per repository."""
    rows = t.once(P.order_rows)
    every = P.as_pull_requests(rows, _is_stored().alias("is_stored"))
    counts = reconcile.list_counts(P.commit_lists(t))
    loaded = reconcile.with_loaded(every, counts).withColumn(
        "commit_id_load_status", S.load_status(F.col("total_commits"), F.col("loaded"))
    )

    def if_stored(value):
        return F.when(F.col("is_stored"), value)

    totals = reconcile.expected_totals(
        loaded,
        declared=F.lit(1),
        documents=if_stored(F.lit(1)),
        total_participants=if_stored(F.col("total_participants")),
        total_commits=if_stored(F.col("total_commits")),
        counted_commits=if_stored(reconcile.counted_commits()),
    )
    stored = stored_pull_requests(t)
    participants = P.with_repository(participant_lists(t), stored)
    known = t.once(P.repositories)
    one = known.select(F.col("id").alias("repository_id"), F.lit(1).alias("stored"))
    parts = [
        reconcile.sides(one, stored=[(1, "expected"), (1, "actual")]),
        reconcile.sides(
            totals,
            declared=[(2, "expected")],
            documents=[(2, "actual")],
            total_participants=[(3, "expected")],
            total_commits=[(4, "expected")],
            counted_commits=[(4, "actual")],
        ),
        reconcile.sides(reconcile.actual_list_totals(participants), actual=[(3, "actual")]),
    ]
    return reconcile.step_report(parts, known, [1, 2, 3, 4])


_STORED_SQL = f"""
    SELECT p.* FROM ({P.PULL_REQUESTS_SQL}) p JOIN nation ON 'R' || n_nationkey = repository_id
    JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AMERICA' OR state = 'MERGED'
"""
_REPORT_SQL = f"""
    SELECT CAST(step AS INTEGER) AS step, 'R' || n_nationkey AS repository_id,
           CAST(coalesce(expected, 0) AS BIGINT) AS expected,
           CAST(coalesce(actual, 0) AS BIGINT) AS actual,
           coalesce(expected, 0) = coalesce(actual, 0) AS ok
    FROM nation, (VALUES (1), (2), (3), (4)) s(step) LEFT JOIN (
        SELECT 1 AS step, 'R' || n_nationkey AS repository_id, 1 AS expected, 1 AS actual FROM nation
        UNION ALL
        SELECT 2, d.repository_id, any_value(d.n), count(s.id)
        FROM (SELECT repository_id, count(*) AS n FROM ({P.PULL_REQUESTS_SQL}) GROUP BY 1) d
        LEFT JOIN ({_STORED_SQL}) s ON s.repository_id = d.repository_id GROUP BY d.repository_id
        UNION ALL
        SELECT 3, repository_id, sum(total_participants), sum(numbers) FROM ({_STORED_SQL})
        GROUP BY repository_id
        UNION ALL
        SELECT 4, repository_id, sum(total_commits),
               sum(CASE WHEN total_commits <> numbers THEN total_commits ELSE numbers END)
        FROM ({_STORED_SQL}) GROUP BY repository_id
    ) c USING (step) WHERE repository_id = 'R' || n_nationkey
"""


@query("reconcile_step", _REPORT_SQL)
def reconcile_step(t: Tables) -> DataFrame:
    return report(t)


@query(
    "mismatched_parents",
    f"""
    SELECT repository_id, count(*) FILTER (total_commits <> numbers) AS mismatched
    FROM ({P.PULL_REQUESTS_SQL}) GROUP BY repository_id
    """,
)
def mismatched_parents(t: Tables) -> DataFrame:
    counts = reconcile.list_counts(t.once(P.commit_lists))
    return reconcile.mismatched_parents(t.once(P.pull_requests), "total_commits", counts)


@query(
    "reconcile_recursive",
    f"""
    WITH report AS ({_REPORT_SQL})
    SELECT r.*, r.ok AND NOT EXISTS (
             SELECT 1 FROM report u JOIN (VALUES (2, 1), (3, 1), (3, 2), (4, 1), (4, 2)) e(step, needs)
               ON u.step = e.needs
             WHERE e.step = r.step AND u.repository_id = r.repository_id AND NOT u.ok)
           AS ok_recursive
    FROM report r
    """,
)
def reconcile_recursive(t: Tables) -> DataFrame:
    """A step counts only when the steps it requires do."""
    return reconcile.recursive_report(t.spark, report(t), STEP_PARENTS)


@query(
    "reconcile_missing_repository",
    f"""
    WITH wanted AS (
        SELECT r_name AS owner, n_name AS name, 'R' || n_nationkey AS repository_id
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT r_name, 'none', NULL FROM region
    ), report AS ({_REPORT_SQL})
    SELECT step, w.repository_id, w.owner, w.name, expected, actual, ok,
           ok AND NOT EXISTS (
             SELECT 1 FROM report u JOIN (VALUES (2, 1), (3, 1), (3, 2), (4, 1), (4, 2)) e(step, needs)
               ON u.step = e.needs
             WHERE e.step = r.step AND u.repository_id = r.repository_id AND NOT u.ok) AS ok_recursive
    FROM report r JOIN wanted w ON w.repository_id = r.repository_id
    UNION ALL
    SELECT CAST(s.step AS INTEGER), NULL, owner, name, CAST(CASE WHEN s.step = 1 THEN 1 ELSE 0 END AS BIGINT),
           CAST(0 AS BIGINT), s.step <> 1, false
    FROM wanted, (VALUES (1), (2), (3), (4)) s(step) WHERE repository_id IS NULL
    """,
)
def reconcile_missing_repository(t: Tables) -> DataFrame:
    """Wanted repositories that are not stored: one more of each owner. Nothing
    of them is done, and each row tells whose it is."""
    known = t.once(P.repositories)
    wanted = known.select("owner", "name").unionByName(
        t.region.select(F.col("r_name").alias("owner"), F.lit("none").alias("name"))
    )
    missing = documents.repository_exists(known, wanted).filter(~F.col("is_stored"))
    named = report(t).join(known.select(F.col("id").alias("repository_id"), "owner", "name"), "repository_id")
    rows = named.unionByName(reconcile.missing_report(missing, [1, 2, 3, 4]))
    return reconcile.recursive_report(t.spark, rows, STEP_PARENTS)
