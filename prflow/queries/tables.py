"""The given tables, and the landed pages and documents derived from them.

The tables stand in for collaboration data: nations are repositories, orders
pull requests, line items their commits and participants, conversations
comments, events edits and reactions, parts commits, customers users. Pages
are built with the exact schemas of ``prflow.schemas``, one edge per page
unless paging itself is the point, so building them needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from prflow import schemas
from prflow.operators.flatten import stitch_pages
from prflow.operators.joins import lookup_join

STAMP = "yyyy-MM-dd HH:mm:ss"


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        """The table; looked up once, as Spark reads a footer for its schema."""
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table

    def once(self, make) -> DataFrame:
        """``make(self)``, built once per query."""
        key = f"made_{make.__name__}"
        if key not in self.__dict__:
            setattr(self, key, make(self))
        return self.__dict__[key]


# --------------------------------------------------------------------------
# Building pages


def text(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def tag(prefix: str, value: str | Column) -> Column:
    return F.concat(F.lit(prefix), text(value))


def api_time(value: Column) -> Column:
    """A timestamp the way the API writes it."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def stamp(value: str | Column) -> Column:
    """A timestamp as text, for results that compare across engines."""
    return F.date_format(F.col(value) if isinstance(value, str) else value, STAMP)


def total(value: Column) -> dict:
    return {"totalCount": value}


def only_if(condition: Column, fields: Mapping, kind: str) -> Column:
    """A struct that is NULL unless the condition holds."""
    return F.when(condition, build(StructType.fromDDL(kind), fields))


def build(kind: DataType, value) -> Column:
    """A column of exactly this type; fields left out are NULL."""
    if isinstance(value, Column):
        return value.cast(kind.simpleString())
    if value is None:
        return F.expr(f"CAST(NULL AS {kind.simpleString()})")
    if isinstance(kind, StructType):
        unknown = set(value) - set(kind.names)
        if unknown:
            raise KeyError(f"no such fields: {sorted(unknown)}")
        return F.struct(*[build(f.dataType, value.get(f.name)).alias(f.name) for f in kind])
    if isinstance(kind, ArrayType):
        return F.array(*[build(kind.elementType, v) for v in value])
    return F.lit(value).cast(kind.simpleString())


def node_type(shape: str) -> StructType:
    """Type of one node of the shape's connection."""
    kind = schemas.page_schema(shape)["body"].dataType["data"].dataType
    for part in schemas.CONNECTION_PATHS[shape].split("."):
        kind = kind[part].dataType
    return kind["edges"].dataType.elementType["node"].dataType


def pages(
    rows: DataFrame,
    shape: str,
    data: Mapping | Column | None,
    request_id: Column,
    page_no: Column | None = None,
    owner: Column | None = None,
    name: Column | None = None,
    present: Column | None = None,
) -> DataFrame:
    """One page per row. Where ``present`` is false the data is NULL."""
    body = schemas.page_schema(shape)["body"].dataType
    column = build(body["data"].dataType, data)
    if present is not None:
        column = F.when(present, column)
    no_text = F.expr("CAST(NULL AS STRING)")
    return rows.select(
        F.lit(shape).alias("shape"),
        (no_text if owner is None else owner).alias("owner"),
        (no_text if name is None else name).alias("name"),
        request_id.alias("request_id"),
        (F.lit(0) if page_no is None else page_no).cast("bigint").alias("page_no"),
        F.struct(
            column.alias("data"), build(body["errors"].dataType, None).alias("errors")
        ).alias("body"),
    )


def edge_pages(
    rows: DataFrame,
    shape: str,
    node: Mapping,
    request_id: Column,
    page_no: Column,
    **envelope,
) -> DataFrame:
    """Connection pages with one edge each; its cursor is the page number."""
    edge: dict = {"node": node}
    has_cursor = shape != "pr_commit_ids"
    if has_cursor:
        edge["cursor"] = page_no.cast("string")
    data: dict = {"edges": [edge]}
    for part in reversed(schemas.CONNECTION_PATHS[shape].split(".")):
        data = {part: data}
    return pages(rows, shape, data, request_id, page_no, **envelope)


# --------------------------------------------------------------------------
# Repositories and users


def repositories(t: Tables) -> DataFrame:
    """Stored repository documents: nations, owned by their region, declaring
    their customers as pull requests."""
    declared = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("int").alias("declared"))
    return (
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(declared, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select(
            tag("R", "n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("owner"),
            F.coalesce("declared", F.lit(0)).alias("total_pull_requests"),
            F.lit("REPOSITORY").alias("object_type"),
        )
    )


REPOSITORIES_SQL = """
    SELECT 'R' || n_nationkey AS id, n_name AS name, r_name AS owner,
           CAST(coalesce(declared, 0) AS INTEGER) AS total_pull_requests
    FROM nation JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN (SELECT c_nationkey, count(*) AS declared FROM customer GROUP BY c_nationkey) c
      ON n_nationkey = c_nationkey
"""


# --------------------------------------------------------------------------
# Pull requests

# Repositories of these owners declare what the API returns; the others
# declare every line item, of which the API returns one per line number.
EXACT_OWNERS = ("ASIA", "EUROPE")


def owned_orders(t: Tables) -> DataFrame:
    """Orders with customer and repository. A customer may have a large share
    of the orders, hence the skew-safe join."""
    owners = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"
    )
    customers = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return lookup_join(
        lookup_join(t.orders, customers, ["o_custkey"], spread=["o_orderkey"], how="inner"),
        owners, ["c_nationkey"], spread=["o_orderkey"], how="inner",
    )


def order_rows(t: Tables) -> DataFrame:
    """Orders with customer, repository and line counts."""
    per_number = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("copies")
    )
    lines = per_number.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("copies").alias("lines"), F.count(F.lit(1)).alias("numbers")
    )
    return (
        owned_orders(t)
        .join(lines, "o_orderkey", "left")
        .withColumn("lines", F.coalesce("lines", F.lit(0)))
        .withColumn("numbers", F.coalesce("numbers", F.lit(0)))
    )


ORDER_ROWS_SQL = """
    SELECT o.*, c.*, n_name, r_name, coalesce(lines, 0) AS lines, coalesce(numbers, 0) AS numbers
    FROM orders o JOIN customer c ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN (SELECT l_orderkey, count(*) AS lines, count(DISTINCT l_linenumber) AS numbers
               FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
"""


def pr_state() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "MERGED")
        .when(F.col("o_orderstatus") == "O", "OPEN")
        .otherwise("CLOSED")
    )


def declared_commits() -> Column:
    return F.when(F.col("r_name").isin(*EXACT_OWNERS), F.col("numbers")).otherwise(F.col("lines"))


def pull_requests(t: Tables) -> DataFrame:
    """Pull request documents made of orders (the columns the operators use)."""
    return as_pull_requests(t.once(order_rows))


def pull_request_states(t: Tables) -> DataFrame:
    """``(id, repository_id, state)`` of the pull requests: no line is counted."""
    return owned_orders(t).select(
        text("o_orderkey").alias("id"), tag("R", "c_nationkey").alias("repository_id"), pr_state().alias("state")
    )


def as_pull_requests(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.select(
        *more,
        text("o_orderkey").alias("id"),
        tag("R", "c_nationkey").alias("repository_id"),
        F.struct(
            tag("U", "o_custkey").alias("id"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "BOT").otherwise("USER").alias(
                "author_type"
            ),
        ).alias("author"),
        declared_commits().cast("int").alias("total_commits"),
        F.col("lines").cast("int").alias("total_participants"),
        pr_state().alias("state"),
        F.lit("PULL_REQUEST").alias("object_type"),
    )


PULL_REQUESTS_SQL = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'R' || c_nationkey AS repository_id,
           'U' || o_custkey AS author_id,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'BOT' ELSE 'USER' END AS author_type,
           CAST(CASE WHEN r_name IN {EXACT_OWNERS} THEN numbers ELSE lines END AS INTEGER)
             AS total_commits,
           CAST(lines AS INTEGER) AS total_participants, numbers,
           CASE o_orderstatus WHEN 'F' THEN 'MERGED' WHEN 'O' THEN 'OPEN' ELSE 'CLOSED' END AS state
    FROM ({ORDER_ROWS_SQL}) r
"""


def commit_id_edges(t: Tables) -> DataFrame:
    """Commit edges of pull requests: a line item is a page with one edge, and
    items with the same line number are copies of one page."""
    return t.lineitem.select(
        text("l_orderkey").alias("parent_id"),
        F.col("l_linenumber").cast("bigint").alias("page_no"),
        F.lit(0).alias("pos"),
        F.lit(None).cast("string").alias("cursor"),
        "l_partkey",
    )


def commit_lists(t: Tables, pages_per_segment: int = 4) -> DataFrame:
    """Stored commit-id lists: the commit is the smallest part of the number."""
    return stitch_pages(
        commit_id_edges(t), F.col("l_partkey"), ["parent_id"], pages_per_segment=pages_per_segment
    ).select(
        "parent_id", "segment", F.transform("items", lambda i: tag("C", i)).alias("items")
    )


def with_repository(lists: DataFrame, parents: DataFrame, *more: str, counted: DataFrame | None = None) -> DataFrame:
    """List rows with their parent's repository, and ``more`` columns of it.
    ``counted`` may be a cheaper frame to find heavy parents in."""
    keys = parents.select(F.col("id").alias("parent_id"), "repository_id", *more)
    return lookup_join(lists, keys, ["parent_id"], spread=["segment"], how="inner", counted=counted)


# --------------------------------------------------------------------------
# Comments: turns of conversations


def comment_time() -> Column:
    """Conversations have no times; a turn is an hour."""
    return api_time(F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 3600))


COMMENT_TIME_SQL = "strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(turn AS INTEGER)), '%Y-%m-%d %H:%M:%S')"


def turn_id() -> Column:
    return F.concat_ws("-", text("conv_id"), text("turn"))


def comment_fields() -> dict:
    """The node fields all comment shapes share. The system has no author, its
    minimized flag is missing; replies are minimized, long ones with a reason."""
    return {
        "id": turn_id(),
        "createdAt": comment_time(),
        "author": only_if(F.col("role") != "system", {"login": F.col("role")}, "login string"),
        "authorAssociation": F.upper("role"),
        "bodyText": F.col("text"),
        "isMinimized": F.when(F.col("role") != "system", F.col("role") == "assistant"),
        "minimizedReason": F.when(F.length("text") > 200, F.lit("OUTDATED")),
        "userContentEdits": total(F.col("turn")),
        "reactions": total(F.length("text")),
    }


COMMENT_SQL = f"""
    SELECT conv_id || '-' || turn AS id, CAST(conv_id AS VARCHAR) AS parent_id, turn, role, text,
           CASE WHEN role = 'system' THEN '' ELSE role END AS author_id,
           'UNKNOWN' AS author_type, upper(role) AS author_association,
           {COMMENT_TIME_SQL} AS created,
           CASE WHEN role <> 'assistant' THEN 'NOT MINIMIZED'
                WHEN length(text) > 200 THEN 'OUTDATED' END AS minimized_status,
           CAST(turn AS INTEGER) AS total_edits, CAST(length(text) AS INTEGER) AS total_reactions
    FROM conversations
"""


def comment_pages(t: Tables, shape: str, **more) -> DataFrame:
    """Turns as comments of their conversation, one per page."""
    return edge_pages(
        t.conversations, shape, {**comment_fields(), **more}, text("conv_id"), F.col("turn")
    )


def turn_pages(t: Tables, shape: str, node: Mapping, per_page: int = 3, more=None) -> DataFrame:
    """Turns in pages of several edges. A page never has more than
    ``per_page``: turns repeated by copies are merged first."""
    kind = node_type(shape)
    once = (
        t.conversations.select(
            text("conv_id").alias("request_id"), "turn", build(kind, node).alias("node")
        )
        .groupBy("request_id", "turn")
        .agg(F.min("node").alias("node"))
    )
    has_cursor = shape != "pr_commit_ids"

    def edge(item: Column) -> Column:
        node = item["node"].alias("node")
        return F.struct(text(item["turn"]).alias("cursor"), node) if has_cursor else F.struct(node)

    paged = once.groupBy("request_id", F.floor(F.col("turn") / per_page).alias("page_no")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "node"))).alias("turns")
    )
    if more is not None:
        paged = more(paged)
    data: dict = {"edges": F.transform("turns", edge)}
    if more is not None:
        data["pageInfo"] = {
            "hasNextPage": F.col("has_next"),
            "endCursor": text(F.element_at("turns", -1)["turn"]),
        }
    for part in reversed(schemas.CONNECTION_PATHS[shape].split(".")):
        data = {part: data}
    return pages(paged, shape, data, F.col("request_id"), F.col("page_no"))


def last_turns(t: Tables) -> DataFrame:
    """Per conversation the last turn and its role."""
    return (
        t.conversations.groupBy(text("conv_id").alias("request_id"))
        .agg(F.max(F.struct("turn", "role")).alias("last"))
        .select("request_id", F.col("last.turn").alias("last_turn"), F.col("last.role").alias("last_role"))
    )


LAST_TURNS_SQL = """
    SELECT CAST(conv_id AS VARCHAR) AS id, max(turn) AS last_turn, arg_max(role, turn) AS last_role,
           count(*) AS turns
    FROM conversations GROUP BY conv_id
"""


# --------------------------------------------------------------------------
# Edits and reactions: events, with a user's day as the parent


def event_parent() -> Column:
    return F.concat_ws("/", text("user_id"), F.date_format("ts", "yyyy-MM-dd"))


EVENT_PARENT_SQL = "user_id || '/' || strftime(ts, '%Y-%m-%d')"


def edit_pages(t: Tables) -> DataFrame:
    """Errors are deletions, cheap ones by nobody; sign-ups have no editor and
    views no difference."""
    deleted = F.col("event_type") == "error"
    node = {
        "id": tag("E", "event_id"),
        "editedAt": api_time(F.col("ts")),
        "editor": only_if(
            F.col("event_type") != "signup", {"login": tag("L", "user_id")}, "login string"
        ),
        "deletedAt": F.when(deleted, api_time(F.col("ts") + F.expr("INTERVAL 1 HOUR"))),
        "deletedBy": only_if(
            deleted & (F.col("value") >= 20), {"login": tag("M", "user_id")}, "login string"
        ),
        "diff": F.when(F.col("event_type") != "view", F.col("props")),
    }
    return edge_pages(t.events, "pr_edits", node, event_parent(), F.col("event_id"))


EDITS_SQL = f"""
    SELECT {EVENT_PARENT_SQL} AS parent_id, 'E' || event_id AS id,
           CASE WHEN event_type = 'error' AND value >= 20 THEN 'M' || user_id
                WHEN event_type = 'signup' THEN '' ELSE 'L' || user_id END AS editor_id,
           strftime(CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 HOUR ELSE ts END,
                    '%Y-%m-%d %H:%M:%S') AS edited,
           CASE WHEN event_type = 'view' THEN '' ELSE props END AS difference,
           event_type = 'error' AS is_delete, user_id
    FROM events
"""


def reaction_pages(t: Tables) -> DataFrame:
    node = {
        "id": tag("X", "event_id"),
        "user": only_if(F.col("event_type") != "signup", {"id": tag("A", "user_id")}, "id string"),
        "content": F.upper("event_type"),
        "createdAt": api_time(F.col("ts")),
    }
    return edge_pages(t.events, "pr_reactions", node, event_parent(), F.col("event_id"))


# --------------------------------------------------------------------------
# Commits: parts


def commit_pages(t: Tables) -> DataFrame:
    """Parts as commits. The words of the name are the tree entries."""
    data = schemas.page_schema("commit")["body"].dataType["data"].dataType
    entry_type = data["node"].dataType["tree"].dataType["entries"].dataType.elementType
    entry = lambda word: build(
        entry_type,
        {
            "object": only_if(word != "ring", {"id": F.concat_ws(":", text("p_partkey"), word)}, "id string"),
            "name": word,
            "extension": F.col("p_type"),
            "path": F.concat_ws("/", F.col("p_brand"), word),
            "isGenerated": F.col("p_size") > 25,
            "mode": F.col("p_size"),
            "type": F.lit("blob"),
            "submodule": only_if(F.col("p_type") == "PROMO", {"name": F.col("p_brand")}, "name string"),
        },
    )
    node = {
        "id": tag("C", "p_partkey"),
        "author": {
            "user": only_if(F.col("p_type") != "ECONOMY", {"id": F.col("p_brand")}, "id string")
        },
        "authoredByCommitter": F.col("p_size") > 10,
        "authors": total(F.col("p_size")),
        "committer": only_if(
            F.col("p_size") <= 40,
            {"user": build(StructType.fromDDL("id string"), {"id": F.col("p_type")})},
            "user struct<id:string>",
        ),
        "onBehalfOf": only_if(F.col("p_type") != "LARGE", {"id": tag("O", "p_size")}, "id string"),
        "comments": total(F.lit(0)),
        "associatedPullRequests": total(F.lit(1)),
        "checkSuites": total(F.lit(2)),
        "committedDate": api_time(F.timestamp_seconds(F.lit(1704067200) + F.col("p_size") * 3600)),
        "messageHeadline": F.col("p_name"),
        "messageBody": F.concat_ws(" ", "p_brand", "p_type", "p_name"),
        "additions": F.col("p_size"),
        "deletions": F.col("p_size") + 1,
        "changedFiles": F.col("p_size") + 2,
        "tree": {"id": tag("T", "p_partkey"), "entries": F.transform(F.split("p_name", " "), entry)},
        "status": only_if(F.col("p_size") > 5, {"state": F.col("p_type")}, "state string"),
    }
    return pages(t.part, "commit", {"node": node}, tag("C", "p_partkey"))
