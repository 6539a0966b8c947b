"""The 32 loading steps as data: what each loads and which steps it requires.

Fixed values; the numbers are only names used in reports.
"""

from __future__ import annotations

from typing import NamedTuple


class Step(NamedTuple):
    number: int
    name: str
    object_type: str
    field: str | None
    shape: str | None
    requires: tuple[int, ...]


STEPS = (
    Step(1, "repositories", "REPOSITORY", None, "repository", ()),
    Step(2, "pull_requests", "PULL_REQUEST", None, "pull_requests", (1,)),
    Step(3, "pr_participants", "PULL_REQUEST", "participants", "pr_participants", (2,)),
    Step(4, "pr_commit_ids", "PULL_REQUEST", "commit_ids", "pr_commit_ids", (2,)),
    Step(5, "pr_edits", "PULL_REQUEST", "edits", "pr_edits", (2,)),
    Step(6, "pr_reactions", "PULL_REQUEST", "reactions", "pr_reactions", (2,)),
    Step(7, "pr_comments", "PULL_REQUEST_COMMENT", None, "pr_comments", (2,)),
    Step(8, "pr_comment_edits", "PULL_REQUEST_COMMENT", "edits", "pr_comment_edits", (7,)),
    Step(
        9, "pr_comment_reactions", "PULL_REQUEST_COMMENT", "reactions", "pr_comment_reactions", (7,)
    ),
    Step(10, "reviews", "PULL_REQUEST_REVIEW", None, "reviews", (2,)),
    Step(11, "review_edits", "PULL_REQUEST_REVIEW", "edits", "review_edits", (10,)),
    Step(12, "review_reactions", "PULL_REQUEST_REVIEW", "reactions", "review_reactions", (10,)),
    Step(13, "review_comments", "PULL_REQUEST_REVIEW_COMMENT", None, "review_comments", (10,)),
    Step(
        14, "review_comment_edits", "PULL_REQUEST_REVIEW_COMMENT", "edits",
        "review_comment_edits", (13,),
    ),
    Step(
        15, "review_comment_reactions", "PULL_REQUEST_REVIEW_COMMENT", "reactions",
        "review_comment_reactions", (13,),
    ),
    Step(16, "pr_commits", "COMMIT", None, "commit", (4,)),
    Step(17, "review_commits", "COMMIT", None, "commit", (10,)),
    Step(18, "review_comment_commits", "COMMIT", None, "commit", (13,)),
    Step(
        19, "commit_pull_request_ids", "COMMIT", "associated_pull_request_ids",
        "commit_pull_request_ids", (16, 17, 18),
    ),
    Step(20, "commit_authors", "COMMIT", "authors", "commit_authors", (16, 17, 18)),
    Step(21, "check_suites", "CHECK_SUITE", None, "check_suites", (16, 17, 18)),
    Step(22, "commit_comments", "COMMIT_COMMENT", None, "commit_comments", (16, 17, 18)),
    Step(23, "commit_comment_edits", "COMMIT_COMMENT", "edits", "commit_comment_edits", (22,)),
    Step(
        24, "commit_comment_reactions", "COMMIT_COMMENT", "reactions",
        "commit_comment_reactions", (22,),
    ),
    Step(25, "pr_users", "USER", None, "user", (2, 3, 5, 6)),
    Step(26, "pr_comment_users", "USER", None, "user", (7, 8, 9)),
    Step(27, "review_users", "USER", None, "user", (10, 11, 12)),
    Step(28, "review_comment_users", "USER", None, "user", (13, 14, 15)),
    Step(29, "commit_users", "USER", None, "user", (20,)),
    Step(30, "commit_comment_users", "USER", None, "user", (22, 23, 24)),
    Step(
        31, "user_organization_ids", "USER", "organizations", "user_organization_ids",
        (25, 26, 27, 28, 29, 30),
    ),
    Step(32, "organizations", "ORGANIZATION", None, "organization", (31, 16)),
)

STEP_PARENTS = {step.number: step.requires for step in STEPS}
STEP_BY_NAME = {step.name: step for step in STEPS}
