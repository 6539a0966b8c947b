"""Schemas: landed pages (one per request shape), documents and lists."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql.types import StructType, _parse_datatype_string

# --------------------------------------------------------------------------
# Shared pieces

ACTOR = "struct<id:string,author_type:string>"
EDIT = f"struct<id:string,editor:{ACTOR},edited_timestamp:timestamp,difference:string>"
REACTION = f"struct<id:string,author:{ACTOR},create_timestamp:timestamp,content:string>"
ENTRY = (
    "struct<id:string,name:string,extension:string,path:string,"
    "is_generated:boolean,mode:int,type:string,submodule_name:string>"
)

_ID = "struct<id:string>"
_LOGIN = "struct<login:string>"
_USER = f"struct<user:{_ID}>"
_TOTAL = "struct<totalCount:int>"
_PAGE_INFO = "struct<hasNextPage:boolean,endCursor:string>"


def _connection(node: str) -> str:
    return f"struct<edges:array<struct<cursor:string,node:{node}>>>"


def _totals(*names: str) -> str:
    return ",".join(f"{name}:{_TOTAL}" for name in names)


# --------------------------------------------------------------------------
# Landed pages: the body of each request shape

_EDIT_NODE = (
    f"struct<id:string,createdAt:string,editedAt:string,editor:{_LOGIN},"
    f"deletedAt:string,deletedBy:{_LOGIN},updatedAt:string,diff:string>"
)
_REACTION_NODE = f"struct<id:string,user:{_ID},content:string,createdAt:string>"
_PULL_REQUEST_NODE = (
    f"struct<id:string,createdAt:string,bodyText:string,author:{_LOGIN},authorAssociation:string,"
    + _totals("participants", "comments", "reviews", "userContentEdits", "reactions", "commits")
    + ",state:string>"
)
_PR_COMMENT_NODE = (
    f"struct<id:string,createdAt:string,author:{_LOGIN},authorAssociation:string,"
    f"userContentEdits:{_TOTAL},isMinimized:boolean,minimizedReason:string,issue:{_ID},"
    f"bodyText:string,reactions:{_TOTAL}>"
)
_REVIEW_NODE = (
    f"struct<id:string,author:{_LOGIN},authorAssociation:string,bodyText:string,createdAt:string,"
    f"commit:{_ID},"
    + _totals("comments", "reactions", "userContentEdits", "onBehalfOf")
    + ",state:string>"
)
_REVIEW_COMMENT_NODE = (
    f"struct<id:string,author:{_LOGIN},authorAssociation:string,bodyText:string,createdAt:string,"
    "diffHunk:string,path:string,originalPosition:int,position:int,isMinimized:boolean,"
    f"minimizedReason:string,originalCommit:{_ID},commit:{_ID},replyTo:{_ID},"
    + _totals("userContentEdits", "reactions")
    + ",state:string>"
)
_COMMIT_NODE = (
    f"struct<id:string,author:{_USER},authoredByCommitter:boolean,authors:{_TOTAL},"
    f"committer:{_USER},onBehalfOf:{_ID},"
    + _totals("comments", "associatedPullRequests", "checkSuites")
    + ",committedDate:string,pushedDate:string,messageHeadline:string,messageBody:string,"
    "additions:int,deletions:int,changedFiles:int,"
    f"tree:struct<id:string,entries:array<struct<object:{_ID},name:string,extension:string,"
    "path:string,isGenerated:boolean,mode:int,type:string,submodule:struct<name:string>>>>,"
    "status:struct<state:string>>"
)
_CHECK_SUITE_NODE = (
    f"struct<id:string,app:{_ID},branch:{_ID},commit:{_ID},checkRuns:{_TOTAL},conclusion:string,"
    f"createdAt:string,matchingPullRequests:{_TOTAL},repository:{_ID},status:string>"
)
_COMMIT_COMMENT_NODE = (
    f"struct<id:string,author:{_LOGIN},authorAssociation:string,bodyText:string,createdAt:string,"
    "isMinimized:boolean,minimizedReason:string,path:string,position:int,"
    + _totals("reactions", "userContentEdits")
    + ">"
)
_USER_NODE = (
    "struct<id:string,name:string,login:string,location:string,company:string,bio:string,"
    "url:string,email:string,twitterUsername:string,websiteUrl:string,avatarUrl:string,"
    f"organizations:{_TOTAL}>"
)

_EDITS_DATA = f"struct<node:struct<id:string,userContentEdits:{_connection(_EDIT_NODE)}>>"
_REACTIONS_DATA = f"struct<node:struct<id:string,reactions:{_connection(_REACTION_NODE)}>>"

_PAGE_DATA = {
    "repository": f"struct<repository:struct<id:string,pullRequests:{_TOTAL}>>",
    "pull_requests": (
        "struct<repository:struct<id:string,pullRequests:struct<totalCount:int,"
        f"edges:array<struct<cursor:string,node:{_PULL_REQUEST_NODE}>>>>>"
    ),
    "pr_participants": f"struct<node:struct<participants:{_connection(_ID)}>>",
    "pr_commit_ids": (
        f"struct<node:struct<commits:struct<pageInfo:{_PAGE_INFO},"
        f"edges:array<struct<node:struct<commit:{_ID}>>>>>>"
    ),
    "pr_edits": _EDITS_DATA,
    "pr_reactions": _REACTIONS_DATA,
    "pr_comments": f"struct<node:struct<comments:{_connection(_PR_COMMENT_NODE)}>>",
    "pr_comment_edits": _EDITS_DATA,
    "pr_comment_reactions": _REACTIONS_DATA,
    "reviews": f"struct<node:struct<reviews:{_connection(_REVIEW_NODE)}>>",
    "review_edits": _EDITS_DATA,
    "review_reactions": _REACTIONS_DATA,
    "review_comments": f"struct<node:struct<comments:{_connection(_REVIEW_COMMENT_NODE)}>>",
    "review_comment_edits": _EDITS_DATA,
    "review_comment_reactions": _REACTIONS_DATA,
    "commit": f"struct<node:{_COMMIT_NODE}>",
    "commit_pull_request_ids": f"struct<node:struct<associatedPullRequests:{_connection(_ID)}>>",
    "commit_authors": f"struct<node:struct<authors:{_connection(_USER)}>>",
    "check_suites": f"struct<node:struct<checkSuites:{_connection(_CHECK_SUITE_NODE)}>>",
    "commit_comments": f"struct<node:struct<comments:{_connection(_COMMIT_COMMENT_NODE)}>>",
    "commit_comment_edits": _EDITS_DATA,
    "commit_comment_reactions": _REACTIONS_DATA,
    "user": f"struct<node:{_USER_NODE}>",
    "user_organization_ids": f"struct<node:struct<organizations:{_connection(_ID)}>>",
    "organization": "struct<node:struct<id:string,name:string,description:string>>",
    "node_type": "struct<node:struct<__typename:string,id:string>>",
    "user_search": (
        f"struct<search:struct<pageInfo:{_PAGE_INFO},nodes:array<struct<id:string,login:string>>>>"
    ),
}

PAGE_SHAPES = tuple(_PAGE_DATA)

# Where the paged connection of a shape sits inside ``body.data``.
CONNECTION_PATHS = {
    "pull_requests": "repository.pullRequests",
    "pr_participants": "node.participants",
    "pr_commit_ids": "node.commits",
    "pr_edits": "node.userContentEdits",
    "pr_reactions": "node.reactions",
    "pr_comments": "node.comments",
    "pr_comment_edits": "node.userContentEdits",
    "pr_comment_reactions": "node.reactions",
    "reviews": "node.reviews",
    "review_edits": "node.userContentEdits",
    "review_reactions": "node.reactions",
    "review_comments": "node.comments",
    "review_comment_edits": "node.userContentEdits",
    "review_comment_reactions": "node.reactions",
    "commit_pull_request_ids": "node.associatedPullRequests",
    "commit_authors": "node.authors",
    "check_suites": "node.checkSuites",
    "commit_comments": "node.comments",
    "commit_comment_edits": "node.userContentEdits",
    "commit_comment_reactions": "node.reactions",
    "user_organization_ids": "node.organizations",
}

ENVELOPE_KEYS = ("shape", "owner", "name", "request_id", "page_no")


@lru_cache(maxsize=None)
def body_type(shape: str) -> str:
    """DDL of the body of one landed page."""
    return f"struct<data:{_PAGE_DATA[shape]},errors:array<struct<message:string>>>"


@lru_cache(maxsize=None)
def page_schema(shape: str, corrupt_column: str | None = None) -> StructType:
    """Schema of one landed line: the envelope and the body."""
    ddl = (
        "shape:string,owner:string,name:string,request_id:string,page_no:bigint,landed_at:bigint,"
        f"body:{body_type(shape)}"
    )
    if corrupt_column:
        ddl += f",{corrupt_column}:string"
    return _parse_datatype_string(f"struct<{ddl}>")


# --------------------------------------------------------------------------
# Documents. Each type has scalar columns (stored in its document table),
# list fields (stored as bounded segments in list tables) and late fields
# (written after the document, stored in narrow side tables).

_COMMENT_TAIL = "total_edits int, total_reactions int"

DOCUMENT_COLUMNS = {
    "REPOSITORY": (
        "id string, name string, owner string, total_pull_requests int, "
        "insert_timestamp timestamp, update_timestamp timestamp, object_type string"
    ),
    "PULL_REQUEST": (
        f"id string, repository_id string, author {ACTOR}, author_association string, "
        "create_timestamp timestamp, text string, total_participants int, total_comments int, "
        "total_reviews int, total_commits int, total_edits int, total_reactions int, "
        "state string, object_type string"
    ),
    "PULL_REQUEST_COMMENT": (
        f"id string, pull_request_id string, repository_id string, author {ACTOR}, "
        "author_association string, create_timestamp timestamp, text string, "
        f"minimized_status string, issue_id string, {_COMMENT_TAIL}, object_type string"
    ),
    "PULL_REQUEST_REVIEW": (
        f"id string, pull_request_id string, repository_id string, author {ACTOR}, "
        "author_association string, create_timestamp timestamp, commit_id string, text string, "
        f"total_comments int, total_for_teams int, {_COMMENT_TAIL}, state string, "
        "object_type string"
    ),
    "PULL_REQUEST_REVIEW_COMMENT": (
        "id string, pull_request_id string, pull_request_review_id string, "
        f"repository_id string, author {ACTOR}, author_association string, "
        "original_commit_id string, commit_id string, reply_to_comment_id string, "
        "create_timestamp timestamp, text string, inline_comment boolean, diff_hunk string, "
        "path string, original_position int, position int, minimized_status string, "
        f"{_COMMENT_TAIL}, state string, object_type string"
    ),
    "COMMIT": (
        f"id string, repository_id string, author {ACTOR}, authored_by_committer boolean, "
        f"committer {ACTOR}, total_authors int, for_organization_id string, "
        "create_timestamp timestamp, push_timestamp timestamp, message_headline string, "
        "message_text string, total_comments int, total_check_suites int, tree_id string, "
        f"entries array<{ENTRY}>, additions int, deletions int, changed_files int, "
        "total_associated_pull_requests int, state string, object_type string"
    ),
    "COMMIT_COMMENT": (
        f"id string, commit_id string, repository_id string, author {ACTOR}, "
        "author_association string, create_timestamp timestamp, text string, path string, "
        f"position int, minimized_status string, {_COMMENT_TAIL}, object_type string"
    ),
    "CHECK_SUITE": (
        "id string, commit_id string, repository_id string, application_id string, "
        "branch_id string, create_timestamp timestamp, total_check_runs int, conclusion string, "
        "total_matching_pull_requests int, state string, object_type string"
    ),
    "USER": (
        "id string, name string, login string, location string, company string, bio string, "
        "url string, email string, twitter_user_name string, avatar_url string, "
        "website_url string, total_organizations int, object_type string"
    ),
    "ORGANIZATION": "id string, name string, description string, object_type string",
}

OBJECT_TYPES = tuple(DOCUMENT_COLUMNS)

# List field -> item type. A list is stored as rows (repository_id, parent_id,
# segment, items); see operators/flatten.py.
LIST_FIELDS = {
    "PULL_REQUEST": {
        "participants": ACTOR, "comment_ids": "string", "review_ids": "string",
        "commit_ids": "string", "edits": EDIT, "reactions": REACTION,
    },
    "PULL_REQUEST_COMMENT": {"edits": EDIT, "reactions": REACTION},
    "PULL_REQUEST_REVIEW": {
        "comment_ids": "string", "for_team_ids": "string", "edits": EDIT, "reactions": REACTION,
    },
    "PULL_REQUEST_REVIEW_COMMENT": {"edits": EDIT, "reactions": REACTION},
    "COMMIT": {
        "authors": ACTOR, "comment_ids": "string", "check_suite_ids": "string",
        "associated_pull_request_ids": "string",
    },
    "COMMIT_COMMENT": {"edits": EDIT, "reactions": REACTION},
    "CHECK_SUITE": {"check_runs": "string", "matching_pull_request_ids": "string"},
    "USER": {"organizations": "string"},
}

# Fields that exist only once a later step has evaluated the document. The
# load status has a side table; is_deleted follows from the edit lists.
LATE_FIELDS = {
    "PULL_REQUEST": {"commit_id_load_status": "string", "is_deleted": "boolean"},
    "PULL_REQUEST_COMMENT": {"is_deleted": "boolean"},
    "PULL_REQUEST_REVIEW": {"is_deleted": "boolean"},
    "PULL_REQUEST_REVIEW_COMMENT": {"is_deleted": "boolean"},
    "COMMIT_COMMENT": {"is_deleted": "boolean"},
}

# Types whose documents say "not deleted" before their edits were evaluated.
NOT_DELETED_BY_DEFAULT = (
    "PULL_REQUEST_COMMENT", "PULL_REQUEST_REVIEW_COMMENT", "COMMIT_COMMENT",
)


@lru_cache(maxsize=None)
def document_schema(object_type: str) -> StructType:
    return StructType.fromDDL(DOCUMENT_COLUMNS[object_type])


@lru_cache(maxsize=None)
def list_schema(object_type: str, field: str) -> StructType:
    item = LIST_FIELDS[object_type][field]
    ddl = f"repository_id string, parent_id string, segment bigint, items array<{item}>"
    if field == "edits":
        # whether one of the segment's edits is a deletion; the items do not say
        ddl += ", has_deletion boolean"
    return StructType.fromDDL(ddl)


@lru_cache(maxsize=None)
def late_schema(object_type: str, field: str) -> StructType:
    return StructType.fromDDL(f"id string, {field} {LATE_FIELDS[object_type][field]}")
