"""Queries that go through files: landed JSON, parsed pages, the versioned store,
and the referencing steps over what other documents name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prflow import schemas
from prflow.operators import actors, flatten, reconcile
from prflow.plans import loads
from prflow.plans.run import GLOBAL_STEPS
from prflow.plans.steps import STEP_PARENTS
from prflow.plans.store import Store
from prflow.queries import loading as LD
from prflow.queries import reading as R
from prflow.queries import tables as P
from prflow.queries.registry import query
from prflow.queries.tables import Tables, tag, text
from prflow.session import new_work_folder
from prflow.sinks import keyed
from prflow.sources import documents
from prflow.sources.pages import ACCEPTED


def new_store(t: Tables) -> Store:
    return Store(t.spark, new_work_folder(t.spark, "store"))


def land_json(t: Tables, pages: DataFrame, shape: str) -> str:
    """Pages as JSON lines in a landing folder."""
    landing = new_work_folder(t.spark, "landing")
    pages.write.json(f"{landing}/{shape}")
    return landing


def as_documents(rows: DataFrame, object_type: str) -> DataFrame:
    """Rows with all columns of the type; NULL where they have none."""
    return rows.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.document_schema(object_type)
        ]
    )


# -- landed JSON ------------------------------------------------------------


@query(
    "landed_json_pages",
    """
    SELECT CASE WHEN role <> 'system' THEN 'accepted' WHEN conv_id % 2 = 0 THEN 'errors' ELSE 'other' END AS outcome,
           count(*) AS pages, count(*) FILTER (role <> 'system') AS edges
    FROM conversations GROUP BY 1
    """,
)
def landed_json_pages(t: Tables) -> DataFrame:
    """Turns land as JSON lines; what the system says failed, every other time
    with a reason. Parsed once, failed pages too."""
    failed = F.col("role") == "system"
    whole = P.pages(
        t.conversations, "pr_comments", {"node": {"comments": {"edges": [{"node": P.comment_fields()}]}}},
        text("conv_id"), F.col("turn"), present=~failed,
    )
    lines = whole.join(
        t.conversations.filter(failed & (F.col("conv_id") % 2 == 0)).select(
            text("conv_id").alias("request_id"), F.col("turn").alias("page_no"), F.lit(True).alias("told")
        ).distinct(),
        ["request_id", "page_no"], "left",
    )
    errors = F.when(F.col("told"), F.array(F.struct(F.lit("limit").alias("message"))))
    body = F.struct(F.col("body.data").alias("data"), errors.alias("errors"))
    landing = land_json(t, lines.select(*[c for c in whole.columns if c != "body"], body.alias("body")), "pr_comments")
    store = new_store(t)
    store.convert_pages(landing, "pr_comments")
    store.convert_pages(landing, "pr_comments")  # finds nothing new
    edges = F.coalesce(F.size("body.data.node.comments.edges"), F.lit(0))
    return store.landed_pages("pr_comments").groupBy("outcome").agg(
        F.count("*").alias("pages"), F.sum(edges.cast("long")).alias("edges")
    )


@query(
    "stored_new_comments",
    f"""
    SELECT id, parent_id AS pull_request_id, 'R' || parent_id AS repository_id, {LD._ROLE_AUTHOR_SQL},
           created, text, minimized_status, '' AS issue_id
    FROM ({LD._CHILDREN_SQL})
    """,
)
def stored_new_comments(t: Tables) -> DataFrame:
    """Step 7 from parsed files, where every page landed twice and had changed:
    documents are chosen by id and place, their bodies come last."""
    now = P.comment_pages(t, "pr_comments").withColumn("landed_at", F.lit(2).cast("bigint"))
    before = P.comment_pages(t, "pr_comments", bodyText=F.lit("before")).withColumn("landed_at", F.lit(1).cast("bigint"))
    landing = land_json(t, before.unionByName(now).unionByName(now), "pr_comments")
    store = new_store(t)
    store.convert_pages(landing, "pr_comments")
    landed = store.landed_pages("pr_comments").filter(F.col("outcome") == ACCEPTED)
    children = loads.pr_comments(
        flatten.current_fetch(landed), LD.conversation_parents(t, "total_comments"), LD.replies(t, "pull_request_id"),
        LD.login_of_roles(t),
    )
    return R.flat(children.documents.drop("author_association", "total_edits", "total_reactions", "object_type"))


# -- the store --------------------------------------------------------------


def stored_pull_requests(t: Tables) -> Store:
    """Pull requests stored in two loads; what the second has again is left out."""
    store, every = new_store(t), as_documents(P.pull_requests(t), "PULL_REQUEST")
    for some in (every.filter(F.col("state") != "OPEN"), every):
        store.append("PULL_REQUEST", keyed.rows_to_insert(store.documents("PULL_REQUEST"), some, ["id"]))
    return store


@query("store_scan_by_repository", f"SELECT id, repository_id, state FROM ({P.PULL_REQUESTS_SQL}) WHERE repository_id = 'R7'")
def store_scan_by_repository(t: Tables) -> DataFrame:
    """Only the bucket of the repository is read."""
    store = stored_pull_requests(t)
    one = t.nation.filter(F.col("n_nationkey") == 7).select(tag("R", "n_nationkey").alias("id"))
    found = documents.documents_of(store.documents("PULL_REQUEST", store.buckets_of(one)), "R7")
    return found.select("id", "repository_id", "state")


@query(
    "store_scope",
    f"""
    SELECT id, repository_id, state FROM ({P.PULL_REQUESTS_SQL})
    WHERE repository_id IN (
      SELECT r.id FROM ({P.REPOSITORIES_SQL}) r JOIN ({R._WANTED_SQL}) w ON w.owner = r.owner AND w.name = r.name)
    """,
)
def store_scope(t: Tables) -> DataFrame:
    """One run over the listed repositories reads their buckets."""
    store = stored_pull_requests(t)
    scope = documents.lookup_repository(t.once(P.repositories), R._wanted(t))
    kept = documents.in_scope(store.documents("PULL_REQUEST", store.buckets_of(scope)), scope)
    return kept.select("id", "repository_id", "state")


@query(
    "store_lists_replaced",
    f"""
    WITH once AS (
        SELECT l_orderkey, l_linenumber, min(l_partkey) AS first FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT repository_id, id AS parent_id, CAST(l_linenumber // 4 AS BIGINT) AS segment,
           CASE WHEN state = 'MERGED' THEN string_agg('C' || first, ',' ORDER BY l_linenumber DESC)
                ELSE string_agg('C' || first, ',' ORDER BY l_linenumber) END AS items
    FROM once JOIN ({P.PULL_REQUESTS_SQL}) ON id = CAST(l_orderkey AS VARCHAR)
    GROUP BY repository_id, id, state, l_linenumber // 4
    """,
)
def store_lists_replaced(t: Tables) -> DataFrame:
    """Commit lists are put twice; those of merged pull requests have changed,
    the others leave nothing behind. Then the table is compacted."""
    store = new_store(t)
    merged = F.count_if(F.col("state") == "MERGED").over(Window.partitionBy("id"))
    parents = P.pull_request_states(t).withColumn("merged", merged)
    whole = P.with_repository(t.once(P.commit_lists), parents, "merged", counted=P.commit_id_edges(t))
    folder = new_work_folder(t.spark, "lists")
    whole.write.parquet(folder)  # read by all three loads
    whole = t.spark.read.schema(whole.schema).parquet(folder)
    store.put_lists("PULL_REQUEST", "commit_ids", whole.drop("merged"))
    # a list meets each merged pull request of its id
    times = F.array_repeat(F.lit(True), F.greatest(F.col("merged"), F.lit(1)).cast("int"))
    items = F.when(F.col("merged") > 0, F.reverse("items")).otherwise(F.col("items"))
    again = whole.withColumn("items", items).withColumn("merged", F.explode(times)).drop("merged")
    store.put_lists("PULL_REQUEST", "commit_ids", again, ready=True)
    store.put_lists("PULL_REQUEST", "commit_ids", again, ready=True)
    store.compact(from_loads=2)
    return LD.flat_lists(store.lists("PULL_REQUEST", "commit_ids"))


@query(
    "store_late_fields",
    f"""
    SELECT id, CASE WHEN state = 'CLOSED' THEN NULL WHEN state = 'MERGED' THEN 'GIT_RETURNED_LESS'
                    ELSE 'LOADED_SUCCESSFULLY' END AS commit_id_load_status
    FROM ({P.PULL_REQUESTS_SQL})
    """,
)
def store_late_fields(t: Tables) -> DataFrame:
    """A load status is set twice; the last value counts, others are untouched."""
    store = stored_pull_requests(t)
    every = t.once(P.pull_requests).filter(F.col("state") != "CLOSED")
    for value in (F.lit("LOADED_SUCCESSFULLY"), F.when(F.col("state") == "MERGED", "GIT_RETURNED_LESS").otherwise("LOADED_SUCCESSFULLY")):
        store.put_late("PULL_REQUEST", "commit_id_load_status", every.select("id", value.alias("commit_id_load_status")))
    late = store.late("PULL_REQUEST", "commit_id_load_status")
    return keyed.set_fields(store.documents("PULL_REQUEST").select("id"), late, ["commit_id_load_status"])


# -- commits that reviews and their comments name ---------------------------

_PARTS = "SELECT p_partkey, p_name FROM part WHERE p_size > 25"


def _commits_named(t: Tables, commit_id: Column) -> DataFrame:
    """Commits that line items name, as documents of a repository do."""
    named = t.lineitem.select(tag("R", "l_suppkey").alias("repository_id"), commit_id.alias("commit_id"))
    references = actors.distinct_ids(named.select("repository_id", F.col("commit_id").alias("id")))
    scope = t.supplier.select(tag("R", "s_suppkey").alias("id"), F.col("s_suppkey").alias("place"))
    stored = t.part.filter(F.col("p_size") <= 25).select(tag("C", "p_partkey").alias("id"))
    brand = {"__typename": F.lit("User"), "id": F.col("p_brand")}
    types = actors.actor_types(P.pages(t.part, "node_type", {"node": brand}, F.col("p_brand")))
    new = loads.commits(P.commit_pages(t), loads.scoped_references(references, scope), stored, types)
    return new.select("id", "repository_id", "message_headline")


def _named_sql(condition: str) -> str:
    return f"""
    SELECT 'C' || p_partkey AS id, 'R' || min(l_suppkey) AS repository_id, p_name AS message_headline
    FROM lineitem JOIN ({_PARTS}) ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey
    WHERE {condition} GROUP BY p_partkey, p_name
    """


@query("load_review_commits", _named_sql("l_linestatus = 'O'"))
def load_review_commits(t: Tables) -> DataFrame:
    """Step 17: a review names one commit or none."""
    return _commits_named(t, F.when(F.col("l_linestatus") == "O", tag("C", "l_partkey")))


@query("load_review_comment_commits", _named_sql("l_returnflag = 'A'"))
def load_review_comment_commits(t: Tables) -> DataFrame:
    """Step 18: a review comment names the commit it is about."""
    return _commits_named(t, F.when(F.col("l_returnflag") == "A", tag("C", "l_partkey")))


# -- users that documents and their lists name -------------------------------


def _users_named(t: Tables, references: DataFrame) -> DataFrame:
    node = {"id": tag("U", "c_custkey"), "login": F.col("c_name"), "organizations": P.total(F.col("c_nationkey"))}
    landed = P.pages(t.customer, "user", {"node": node}, tag("U", "c_custkey"))
    stored = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(tag("U", "c_custkey").alias("id"))
    return loads.users(landed, references, stored).select("id", "login")


def _users_sql(*keys: str) -> str:
    named = " UNION ".join(f"SELECT {key}" for key in keys)
    return f"""
    SELECT 'U' || c_custkey AS id, c_name AS login FROM customer
    WHERE c_mktsegment <> 'BUILDING' AND c_custkey IN ({named})
    """


def _actor(key: str | Column, is_user: Column | bool = True) -> Column:
    kind = F.when(F.lit(is_user) if isinstance(is_user, bool) else is_user, "USER").otherwise("BOT")
    return F.struct(tag("U", key).alias("id"), kind.alias("author_type"))


def _events(t: Tables, item: Column) -> DataFrame:
    """Event lists as stored: one segment a user's day."""
    return t.events.select(
        tag("R", "user_id").alias("repository_id"), P.event_parent().alias("parent_id"), F.array(item).alias("items")
    )


def _clicks(t: Tables, field: str) -> DataFrame:
    return _events(t, F.struct(_actor("user_id", F.col("event_type") == "click").alias(field)))


def _authored(t: Tables, parity: int) -> DataFrame:
    """Documents by customers: those of orders with an even or odd key."""
    return t.orders.filter(F.col("o_orderkey") % 2 == parity).select(_actor("o_custkey").alias("author"))


_CLICKS = "user_id FROM events WHERE event_type = 'click'"


@query("load_comment_users", _users_sql("o_custkey FROM orders WHERE o_orderkey % 2 = 0", _CLICKS))
def load_comment_users(t: Tables) -> DataFrame:
    """Step 26: authors, editors and reacting users of comments."""
    lists = {"edits": _clicks(t, "editor"), "reactions": _clicks(t, "author")}
    return _users_named(t, actors.document_users(_authored(t, 0), lists))


@query("load_review_users", _users_sql("o_custkey FROM orders WHERE o_orderkey % 2 = 1", _CLICKS))
def load_review_users(t: Tables) -> DataFrame:
    """Step 27: the same of reviews."""
    lists = {"edits": _clicks(t, "editor"), "reactions": _clicks(t, "author")}
    return _users_named(t, actors.document_users(_authored(t, 1), lists))


@query("load_review_comment_users", _users_sql("o_custkey FROM orders WHERE o_orderkey % 2 = 1", _CLICKS))
def load_review_comment_users(t: Tables) -> DataFrame:
    """Step 28: the same of review comments, where only reactions were loaded."""
    return _users_named(t, actors.document_users(_authored(t, 1), {"reactions": _clicks(t, "author")}))


@query("load_commit_users", _users_sql("o_custkey FROM orders WHERE o_orderkey % 2 = 0", "p_size FROM part", "l_suppkey FROM lineitem WHERE l_returnflag <> 'N'"))
def load_commit_users(t: Tables) -> DataFrame:
    """Step 29: author, committer and co-authors of commits."""
    commits = _authored(t, 0).select("author", F.lit(None).cast(schemas.ACTOR).alias("committer")).unionByName(
        t.part.select(F.lit(None).cast(schemas.ACTOR).alias("author"), _actor("p_size").alias("committer"))
    )
    authors = t.lineitem.select(F.array(_actor("l_suppkey", F.col("l_returnflag") != "N")).alias("items"))
    return _users_named(t, actors.document_users(commits, {"authors": authors}, ["author", "committer"]))


@query("load_commit_comment_users", _users_sql("o_custkey FROM orders WHERE o_orderkey % 2 = 1", _CLICKS))
def load_commit_comment_users(t: Tables) -> DataFrame:
    """Step 30: the same of commit comments, where only edits were loaded."""
    return _users_named(t, actors.document_users(_authored(t, 1), {"edits": _clicks(t, "editor")}))


# -- the whole graph of steps --------------------------------------------------

_EDGES_SQL = ", ".join(f"({step}, {needed})" for step, needs in STEP_PARENTS.items() for needed in needs)


@query(
    "reconcile_graph",
    f"""
    WITH RECURSIVE edges(step, needs) AS (VALUES {_EDGES_SQL}),
    closure AS (
        SELECT step, needs FROM edges
        UNION SELECT c.step, e.needs FROM closure c JOIN edges e ON c.needs = e.step),
    report AS (
        SELECT CAST(s.step AS INTEGER) AS step, 'R' || n_nationkey AS repository_id,
               count(c_custkey) AS expected, count(c_custkey) FILTER (c_acctbal > -900) AS actual
        FROM nation CROSS JOIN (SELECT unnest(range(1, 31)) AS step) s
        LEFT JOIN customer ON c_nationkey = n_nationkey AND c_custkey % 30 + 1 = s.step
        GROUP BY s.step, n_nationkey
        UNION ALL SELECT 31, NULL, count(*), count(*) FROM supplier
        UNION ALL SELECT 32, NULL, 0, count(*) FILTER (s_acctbal < -990) FROM supplier),
    judged AS (SELECT *, expected = actual AS ok FROM report)
    SELECT r.*, r.ok AND NOT EXISTS (
             SELECT 1 FROM judged u JOIN closure e ON u.step = e.needs
             WHERE e.step = r.step AND NOT u.ok AND (r.repository_id IS NULL OR u.repository_id = r.repository_id))
           AS ok_recursive
    FROM judged r
    """,
)
def reconcile_graph(t: Tables) -> DataFrame:
    """All 32 steps, the global ones included: customers stand for what a
    nation's steps declare, those far in debt were not loaded."""
    step = (F.col("c_custkey") % 30 + 1).cast("int")
    counted = t.customer.groupBy(tag("R", "c_nationkey").alias("repository_id"), step.alias("step")).agg(
        F.count("*").alias("expected"), F.count_if(F.col("c_acctbal") > -900).alias("actual")
    )
    scope = t.nation.select(tag("R", "n_nationkey").alias("id"))
    local = [s for s in STEP_PARENTS if s not in GLOBAL_STEPS]
    report = reconcile.step_report([counted], scope, local)
    whole = t.supplier.agg(F.count("*").alias("n"), F.count_if(F.col("s_acctbal") < -990).alias("open"))
    totals = {31: (F.col("n"), F.col("n")), 32: (F.lit(0).cast("long"), F.col("open"))}
    for number, (expected, actual) in totals.items():
        report = report.unionByName(
            whole.select(
                F.lit(number).alias("step"), F.lit(None).cast("string").alias("repository_id"), expected.alias("expected"),
                actual.alias("actual"), (expected == actual).alias("ok"),
            )
        )
    return reconcile.recursive_report(t.spark, report, STEP_PARENTS, GLOBAL_STEPS)
