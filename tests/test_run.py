"""A whole run over hand-written landed pages of two repositories."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import connection, edge, page, write_lines
from prflow.plans.run import Run
from prflow.plans.steps import STEPS
from prflow.sources.pages import read_pages

T = "2021-05-06T07:08:09Z"
NOW = datetime.datetime(2024, 1, 1)
REPOSITORIES = [{"owner": "own", "name": "one"}, {"owner": "own", "name": "two"}, {"owner": "own", "name": "none"}]


def total(n):
    return {"totalCount": n}


def pr(i, repo, author, state="MERGED", **totals):
    names = ("participants", "comments", "reviews", "userContentEdits", "reactions", "commits")
    return {
        "id": i, "createdAt": T, "bodyText": f"body {i}", "author": author and {"login": author},
        "authorAssociation": "MEMBER", "state": state,
        **{n: total(totals.get(n, 0)) for n in names},
    }


def note(i, author, edits=0, reactions=0, **more):
    return {
        "id": i, "createdAt": T, "author": author and {"login": author}, "authorAssociation": "NONE",
        "userContentEdits": total(edits), "reactions": total(reactions), "bodyText": f"text {i}",
        "isMinimized": False, "minimizedReason": None, **more,
    }


def an_edit(i, login, **more):
    return {
        "id": i, "editedAt": T, "editor": {"login": login}, "deletedAt": None, "deletedBy": None,
        "diff": "d", **more,
    }


def a_reaction(i, user):
    return {"id": i, "user": user and {"id": user}, "content": "HEART", "createdAt": T}


def commit(i, user, prs, authors, suites=0, comments=0, org=None):
    return {
        "id": i, "author": {"user": user and {"id": user}}, "authoredByCommitter": True,
        "authors": total(authors), "committer": {"user": {"id": "B1"}},
        "onBehalfOf": org and {"id": org}, "comments": total(comments),
        "associatedPullRequests": total(prs), "checkSuites": total(suites), "committedDate": T,
        "pushedDate": None, "messageHeadline": "h", "messageBody": "b", "additions": 1,
        "deletions": 2, "changedFiles": 3,
        "tree": {"id": "t", "entries": [{"object": {"id": "o"}, "name": "f", "mode": 1, "submodule": None}]},
        "status": None,
    }


def user(i, login, organizations=0):
    return page(i, {"node": {"id": i, "login": login, "avatarUrl": f"a/{i}", "organizations": total(organizations)}})


def land(root):
    folder = str(root)
    edges = lambda *nodes: [edge(n["id"], n) for n in nodes]

    def put(shape, *lines):
        write_lines(folder, shape, lines)

    def listed(shape, path, parent, *nodes, page_no=0, **more):
        put(shape, page(parent, connection(path, edges(*nodes), **more), page_no))

    for name, count in (("one", 2), ("two", 1)):
        put("repository", page(name, {"repository": {"id": name.upper(), "pullRequests": total(count)}}, name=name))
    put("repository", page("none", {"repository": None}, name="none"))
    first = pr(
        "P1", "one", "ann", participants=2, comments=2, reviews=1, userContentEdits=2, reactions=1, commits=3
    )
    pulls = lambda *nodes: {"repository": {"pullRequests": {"edges": edges(*nodes)}}}
    put("pull_requests", page("one", pulls(first, pr("PX", "one", "ann", state="OPEN")), 0, name="one"))
    put("pull_requests", page("one", pulls({**first, "bodyText": "later"}, pr("P2", "one", None)), 1, name="one"))
    put("pull_requests", page("two", pulls(pr("P3", "two", "Ann", commits=1)), 0, name="two"))
    listed("pr_participants", "node.participants", "P1", {"id": "U1"}, {"id": "B1"})
    info = lambda more: {"hasNextPage": more, "endCursor": "x"}
    put("pr_commit_ids", page("P1", connection("node.commits", [{"node": {"commit": {"id": "K2"}}}], pageInfo=info(False)), 1))
    put("pr_commit_ids", page("P1", connection("node.commits", [{"node": {"commit": {"id": "K1"}}}], pageInfo=info(True)), 0))
    put("pr_commit_ids", page("P3", connection("node.commits", [{"node": {"commit": {"id": "K1"}}}], pageInfo=info(False)), 0))
    listed(
        "pr_edits", "node.userContentEdits", "P1", an_edit("E1", "ann"),
        an_edit("E2", "ann", deletedAt="2021-06-06T00:00:00Z", deletedBy={"login": "bob"}),
    )
    listed("pr_reactions", "node.reactions", "P1", a_reaction("X1", "U2"))
    listed("pr_comments", "node.comments", "P1", note("C1", "ann", edits=1, issue={"id": "I1"}), page_no=0)
    listed("pr_comments", "node.comments", "P1", note("C2", None, reactions=1, isMinimized=True), page_no=1)
    listed("pr_comment_edits", "node.userContentEdits", "C1", an_edit("E3", "bob"))
    listed("pr_comment_reactions", "node.reactions", "C2", a_reaction("X2", None))
    review = {**note("V1", "bob", edits=1, reactions=1, comments=total(1), onBehalfOf=total(0), commit={"id": "K2"}), "state": "APPROVED"}
    review = {k: v for k, v in review.items() if k not in ("isMinimized", "minimizedReason")}
    listed("reviews", "node.reviews", "P1", review)
    listed("review_edits", "node.userContentEdits", "V1", an_edit("E4", "ann"))
    listed("review_reactions", "node.reactions", "V1", a_reaction("X3", "U1"))
    listed(
        "review_comments", "node.comments", "V1",
        note("W1", "bob", edits=1, reactions=1, originalPosition=4, position=None, commit={"id": "K3"}, replyTo=None),
    )
    listed("review_comment_edits", "node.userContentEdits", "W1", an_edit("E5", "ann"))
    listed("review_comment_reactions", "node.reactions", "W1", a_reaction("X4", "U1"))
    put("commit", page("K1", {"node": commit("K1", "U3", prs=2, authors=2, suites=1, comments=1, org="G9")}))
    put("commit", page("K2", {"node": commit("K2", None, prs=0, authors=0)}), page("K3", {"node": None}))
    listed("commit_pull_request_ids", "node.associatedPullRequests", "K1", {"id": "P1"}, {"id": "P3"})
    authors = [edge("a", {"user": {"id": "U3"}}), edge("b", {"user": None})]
    for n in (0, 1):
        put("commit_authors", page("K1", connection("node.authors", authors), n))
    listed(
        "check_suites", "node.checkSuites", "K1",
        {"id": "S1", "commit": {"id": "K1"}, "repository": {"id": "ONE"}, "app": None, "createdAt": T,
         "checkRuns": total(3), "matchingPullRequests": total(1), "conclusion": "OK", "status": "DONE"},
    )
    listed("commit_comments", "node.comments", "K1", note("Y1", "ann", edits=1, reactions=1, path="f", position=7))
    listed("commit_comment_edits", "node.userContentEdits", "Y1", an_edit("E6", "ann"))
    listed("commit_comment_reactions", "node.reactions", "Y1", a_reaction("X5", "U3"))
    put("user", user("U1", "ann", 1), user("U2", "two"), user("U3", "three"), page("U4", {"node": None}))
    listed("user_organization_ids", "node.organizations", "U1", {"id": "G1"})
    put("organization", page("G1", {"node": {"id": "G1", "name": "org", "description": None}}), page("G9", {"node": None}))
    for i, kind in (("U1", "User"), ("U2", "User"), ("U3", "User"), ("B1", "Bot")):
        put("node_type", page(i, {"node": {"__typename": kind, "id": i}}))
    put("user_search", page("ann", {"search": {"nodes": [{"id": "U0", "login": "Ann"}, {"id": "U1", "login": "ann"}]}}))
    put("user_search", page("bob", {"search": {"nodes": [{"id": "U4", "login": "bob"}]}}))
    put("user_search", {"request_id": "x", "body": {"errors": [{"message": "limit"}]}}, "{torn")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    land(root / "landing")
    done = Run(spark, str(root / "landing"), str(root / "store"), REPOSITORIES, NOW)
    done.run()
    return done


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_failed_pages_are_told_apart(spark, run):
    accepted, failed = read_pages(spark, run.landing, "user_search")
    assert accepted.count() == 2
    assert sorted(r.outcome for r in failed.select("outcome", "body").collect()) == ["errors", "other"]


def test_pull_requests(run):
    prs = by_id(run.store.whole("PULL_REQUEST"))
    assert set(prs) == {"P1", "P2", "P3"}
    p = prs["P1"]
    assert (p.text, p.repository_id, p.is_deleted, p.segment) == ("body P1", "ONE", True, 0)
    assert tuple(p.author) == ("U1", "USER")
    assert tuple(prs["P2"].author) == ("", "UNKNOWN")
    assert tuple(prs["P3"].author) == ("Ann", "UNKNOWN")
    assert [tuple(x) for x in p.participants] == [("U1", "USER"), ("B1", "BOT")]
    assert (p.commit_ids, p.commit_id_load_status) == (["K1", "K2"], "GIT_RETURNED_LESS")
    assert prs["P3"].commit_id_load_status == "LOADED_SUCCESSFULLY"
    assert [(e.id, e.editor.id, e.edited_timestamp.month) for e in p.edits] == [("E1", "U1", 5), ("E2", "U4", 6)]
    assert [(x.id, x.author.author_type, x.content) for x in p.reactions] == [("X1", "USER", "HEART")]
    assert (p.comment_ids, p.review_ids) == (["C1", "C2"], ["V1"])
    assert (prs["P2"].commit_ids, prs["P2"].commit_id_load_status, prs["P2"].is_deleted) == ([], None, None)


def test_children(run):
    comments = by_id(run.store.whole("PULL_REQUEST_COMMENT"))
    assert (comments["C1"].issue_id, comments["C1"].minimized_status) == ("I1", "NOT MINIMIZED")
    assert (comments["C2"].issue_id, comments["C2"].minimized_status) == ("", None)
    assert {c.is_deleted for c in comments.values()} == {False}
    assert [e.editor.id for e in comments["C1"].edits] == ["U4"]
    assert [tuple(x.author) for x in comments["C2"].reactions] == [("", "UNKNOWN")]
    w = by_id(run.store.whole("PULL_REQUEST_REVIEW_COMMENT"))["W1"]
    assert (w.pull_request_id, w.pull_request_review_id, w.inline_comment, w.position) == ("P1", "V1", True, 0)
    v = by_id(run.store.whole("PULL_REQUEST_REVIEW"))["V1"]
    assert (v.commit_id, v.comment_ids, v.for_team_ids, v.is_deleted) == ("K2", ["W1"], [], False)


def test_commits(run):
    commits = by_id(run.store.whole("COMMIT"))
    assert set(commits) == {"K1", "K2"}
    k = commits["K1"]
    assert (k.repository_id, k.associated_pull_request_ids, k.check_suite_ids) == ("ONE", ["P1", "P3"], ["S1"])
    assert [tuple(a) for a in k.authors] == [("U3", "USER"), ("", "UNKNOWN")]
    assert (tuple(k.committer), k.comment_ids) == (("B1", "BOT"), ["Y1"])
    suite = by_id(run.store.whole("CHECK_SUITE"))["S1"]
    assert (suite.application_id, suite.check_runs, suite.total_check_runs) == (None, [], 3)
    assert by_id(run.store.whole("COMMIT_COMMENT"))["Y1"].position == 7


def test_users_and_organizations(run):
    users = by_id(run.store.whole("USER"))
    assert set(users) == {"U1", "U2", "U3"}
    assert (users["U1"].organizations, users["U1"].avatar_url) == (["G1"], "a/U1")
    assert set(by_id(run.store.documents("ORGANIZATION"))) == {"G1"}
    missing = {tuple(r) for r in run.not_found().collect()}
    assert missing == {("COMMIT", "K3"), ("USER", "U4"), ("ORGANIZATION", "G9")}
    assert [tuple(r)[:2] for r in run.missing_repositories().collect()] == [("own", "none")]


def test_report(run):
    report = run.report().collect()
    local = [s.number for s in STEPS if s.number < 31]
    assert {(r.step, r.repository_id, r.name) for r in report} == {
        (s, *r) for s in local for r in (("ONE", "one"), ("TWO", "two"), (None, "none"))
    } | {(31, None, None), (32, None, None)}
    stored = [r for r in report if r.repository_id is not None]
    assert all(r.ok and r.ok_recursive for r in stored)
    # own/none is wanted and not there: nothing of it is done, nor what needs all
    missing = {r.step: r for r in report if r.name == "none"}
    assert (missing[1].expected, missing[1].actual, missing[1].ok) == (1, 0, False)
    assert set(missing) == set(local) and not any(r.ok_recursive for r in missing.values())
    whole = {r.step: r for r in report if r.step > 30}
    assert {s: (r.ok, r.ok_recursive) for s, r in whole.items()} == {31: (True, False), 32: (True, False)}
    counts = {(r.step, r.repository_id): (r.expected, r.actual) for r in report}
    assert counts[2, "ONE"] == (2, 2)
    assert counts[4, "ONE"] == (3, 3)
    assert counts[20, "ONE"] == (2, 2)
    assert counts[31, None] == (1, 1)


def test_report_without_a_missing_repository(spark, run):
    there = [r for r in REPOSITORIES if r["name"] != "none"]
    report = Run(spark, run.landing, run.store.root, there, NOW)
    report._load_repositories()
    assert all(r.ok and r.ok_recursive for r in report.report().collect())


def test_failed_pages_are_counted(run):
    failed = {(r.shape, r.outcome): r.pages for r in run.failed_pages().collect()}
    assert failed == {("user_search", "errors"): 1, ("user_search", "other"): 1}


def contents(run):
    return {name: run.store.version(name) for name, *_ in run.store._tables()}


def test_a_second_run_has_nothing_to_do_and_adds_nothing(spark, run):
    before = contents(run)
    again = Run(spark, run.landing, run.store.root, REPOSITORIES, NOW)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("second", "second")
    again.run()
    spark.sparkContext.setJobGroup("", "")
    assert again.skipped == [s.name for s in STEPS] and jobs.getJobIdsForGroup("second") == []
    assert contents(run) == before


def test_a_run_about_other_repositories_does_its_own_steps(spark, run):
    other = Run(spark, run.landing, run.store.root, REPOSITORIES[:1], NOW)
    assert other.is_due("pull_requests") and not run.is_due("pull_requests")


def test_counting_reads_no_items(run):
    counts = run.loaded("PULL_REQUEST", "edits")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<parent_id:string,n_items:int>" in counts
    sides = [x for side in run._list_sides() for x in side._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1:]]
    assert sides and not any("items:array" in x.splitlines()[0] for x in sides)


def test_scans_of_a_run_are_pruned_to_its_buckets(run):
    for frame in (run.documents("PULL_REQUEST"), run.lists("PULL_REQUEST", "commit_ids")):
        scan = frame._jdf.queryExecution().executedPlan().toString().split("FileScan")[1]
        assert "bucket#" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_running_again_changes_nothing_and_late_pages_fill_gaps(spark, run):
    types = ("PULL_REQUEST", "PULL_REQUEST_COMMENT", "COMMIT", "USER", "CHECK_SUITE")
    before = {t: sorted(map(repr, run.store.whole(t).collect())) for t in types}
    again = Run(spark, run.landing, run.store.root, REPOSITORIES, NOW)
    again.prepare()
    kept = contents(run)
    for step in STEPS:
        if step.number in (2, 4, 5, 7, 16, 20, 21, 25, 31):
            assert again.load(step, force=True)
    assert contents(run) == kept  # no load added a row
    assert {t: sorted(map(repr, again.store.whole(t).collect())) for t in types} == before
    late = connection("node.commits", [{"node": {"commit": {"id": "K4"}}}], pageInfo={"hasNextPage": False})
    write_lines(run.landing, "pr_commit_ids", [page("P1", late, 2)])
    assert again.load("pr_commit_ids") and not again.is_due("pr_participants")
    p = by_id(again.store.whole("PULL_REQUEST"))["P1"]
    assert (p.commit_ids, p.commit_id_load_status) == (["K1", "K2", "K4"], "LOADED_SUCCESSFULLY")
    # the new commit is referenced and has not landed: its step is open again,
    # and so is every step that requires it
    report = {(r.step, r.repository_id): r for r in again.report().collect()}
    assert (report[16, "ONE"].actual, report[16, "ONE"].ok) == (1, False)
    assert report[20, "ONE"].ok and not report[20, "ONE"].ok_recursive
    assert report[20, "TWO"].ok_recursive
    assert not report[31, None].ok_recursive and not report[32, None].ok_recursive
    assert again.store.documents("COMMIT").filter(F.col("id") == "K4").count() == 0
