import random

from pyspark.sql import functions as F

from conftest import connection, edge, page
from prflow.operators import flatten, project

PATH = "node.comments"


def comment(i, **more):
    return {"id": f"c{i}", "author": {"login": "ann"}, "bodyText": f"text {i}", **more}


def test_one_row_per_edge_and_nulls_survive(page_frame):
    pages = page_frame(
        "pr_comments",
        page("p1", connection(PATH, [edge("a", comment(1)), edge("b", comment(2, author=None))])),
        page("p2", connection(PATH, [])),
        page("p3", {"node": None}),
    )
    rows = flatten.flatten_connection(pages, PATH).orderBy("pos").collect()
    assert [(r.request_id, r.pos, r.cursor, r.node.id) for r in rows] == [
        ("p1", 0, "a", "c1"), ("p1", 1, "b", "c2"),
    ]
    assert rows[1].node.author is None


def stitched(edges, **options):
    lists = flatten.stitch_pages(edges, F.col("node.id"), **options)
    return {(r.request_id, r.segment): r["items"] for r in lists.collect()}


def paged(parent, count, size=3):
    for start in range(0, count, size):
        edges = [edge(str(i), comment(i)) for i in range(start, min(count, start + size))]
        yield page(parent, connection(PATH, edges), start // size)


def test_lists_do_not_depend_on_the_order_or_number_of_arrivals(page_frame):
    lines = [*paged("p1", 11), *paged("p2", 4)]
    expected = {("p1", 0): [f"c{i}" for i in range(11)], ("p2", 0): [f"c{i}" for i in range(4)]}
    for seed in range(3):
        arrived = lines + lines[::2]
        random.Random(seed).shuffle(arrived)
        edges = flatten.flatten_connection(page_frame("pr_comments", *arrived), PATH)
        assert stitched(edges) == expected


def test_a_long_list_continues_in_further_segments(page_frame):
    edges = flatten.flatten_connection(page_frame("pr_comments", *paged("p", 20, 2)), PATH)
    lists = stitched(edges, pages_per_segment=3)
    assert {k: len(v) for k, v in lists.items()} == {
        ("p", 0): 6, ("p", 1): 6, ("p", 2): 6, ("p", 3): 2,
    }
    assert sum((lists["p", s] for s in range(4)), []) == [f"c{i}" for i in range(20)]


def test_a_repeated_cursor_is_one_item(page_frame):
    first = connection(PATH, [edge("a", comment(1)), edge("b", comment(2))])
    pages = page_frame("pr_comments", page("p", first, 0), page("p", first, 1))
    edges = flatten.flatten_connection(pages, PATH)
    assert stitched(edges, identity="cursor") == {("p", 0): ["c1", "c2"]}
    assert stitched(edges) == {("p", 0): ["c1", "c2", "c1", "c2"]}


def landed(at, line):
    return {**line, "landed_at": at}


def test_a_page_that_landed_again_replaces_the_old_one_whole(page_frame):
    def some(*ids):
        return connection(PATH, [edge(i, {"id": i}) for i in ids])

    lines = [
        landed(1, page("p", some("a", "b"), 0)), landed(1, page("p", some("x"), 1)), landed(1, page("p", some("y"), 2)),
        landed(2, page("p", some("c", "a", "b"), 0)), landed(3, page("p", some("d"), 1)),
        page("q", some("k"), 0), page("q", some("k"), 0), page("q", some("l"), 1),
        landed(5, page("r", some("m"), 1)),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(lines)
        current = flatten.current_pages(page_frame("pr_comments", *lines))
        edges = flatten.flatten_connection(current, PATH)
        assert stitched(edges) == {("p", 0): ["c", "a", "b", "d"], ("q", 0): ["k", "l"], ("r", 0): ["m"]}
        progress = {r.request_id: r for r in flatten.page_progress(current, PATH).collect()}
        assert (progress["p"].pages, progress["p"]["items"], progress["p"].next_cursor) == (2, 4, "d")


def test_versions_that_landed_together_are_not_mixed(page_frame):
    one = page("p", connection(PATH, [edge("1", {"id": "a"}), edge("2", {"id": "z"})]))
    two = page("p", connection(PATH, [edge("1", {"id": "b"}), edge("2", {"id": "y"})]))
    lists = [
        stitched(flatten.flatten_connection(flatten.current_pages(page_frame("pr_comments", *lines)), PATH))
        for lines in ([one, two], [two, one, one])
    ]
    assert lists[0] == lists[1] and lists[0]["p", 0] in (["a", "z"], ["b", "y"])


def commit_page(parent, page_no, ids, more, end):
    edges = [{"node": {"commit": {"id": i}}} for i in ids]
    info = {"hasNextPage": more, "endCursor": end}
    return page(parent, connection("node.commits", edges, pageInfo=info), page_no)


def test_page_progress(page_frame):
    pages = page_frame(
        "pr_commit_ids",
        commit_page("done", 0, ["a", "b"], True, "x"),
        commit_page("done", 1, ["c"], False, "y"),
        commit_page("done", 1, ["c"], False, "y"),
        commit_page("more", 0, ["a"], True, "z"),
        commit_page("gap", 0, ["a"], True, "u"),
        commit_page("gap", 2, ["c"], False, "w"),
    )
    rows = {r.request_id: r for r in flatten.page_progress(pages, "node.commits").collect()}
    assert (rows["done"].pages, rows["done"]["items"], rows["done"].next_cursor) == (2, 3, "y")
    assert {k: r.complete for k, r in rows.items()} == {"done": True, "more": False, "gap": False}


def test_progress_without_page_info_continues_from_the_last_cursor(page_frame):
    pages = page_frame("pr_comments", *paged("p", 5))
    row = flatten.page_progress(pages, PATH).first()
    assert (row.next_cursor, row["items"], row.complete) == ("4", 5, None)


def edit_page(*nodes):
    path = "node.userContentEdits"
    return page("p", connection(path, [edge(str(i), n) for i, n in enumerate(nodes)]))


def edit(i, **more):
    return {
        "id": f"e{i}", "editedAt": "2021-01-01T00:00:00Z", "editor": {"login": "ann"},
        "deletedAt": None, "deletedBy": None, "diff": f"d{i}", **more,
    }


def test_deletion_overlay(page_frame):
    late = "2021-02-02T00:00:00Z"
    pages = page_frame(
        "pr_edits",
        edit_page(
            edit(0),
            edit(1, deletedAt=late, deletedBy={"login": "bob"}),
            edit(2, deletedAt=late),
            edit(3, editor=None, diff=None),
            edit(4, deletedBy={"login": "bob"}),
        ),
    )
    edges = flatten.flatten_connection(pages, "node.userContentEdits")
    rows = edges.select(project.to_edit().alias("e")).select("e.*").orderBy("id").collect()
    assert [(r.editor.id, r.edited_timestamp.month, r.difference) for r in rows] == [
        ("ann", 1, "d0"), ("bob", 2, "d1"), ("ann", 2, "d2"), ("", 1, ""), ("ann", 1, "d4"),
    ]
    assert [tuple(r) for r in project.any_delete_flag(edges).collect()] == [("p", True)]


def test_commit_with_missing_objects(page_frame):
    node = {
        "id": "k", "author": {"user": None}, "committer": None, "onBehalfOf": None, "status": None,
        "committedDate": "2021-01-01T00:00:00Z", "pushedDate": None,
        "tree": {"id": "t", "entries": [{"object": None, "name": "f", "mode": 33188, "submodule": None}]},
    }
    pages = page_frame("commit", page("k", {"node": node}), page("gone", {"node": None}))
    nodes = project.node_pages(pages).withColumn("repository_id", F.lit("r"))
    row = project.to_commit(nodes).first()
    assert (row.author.id, row.author.author_type) == ("", "UNKNOWN")
    assert (row.committer.id, row.for_organization_id, row.state) == ("", None, None)
    assert (row.entries[0].id, row.entries[0].name, row.entries[0].submodule_name) == (None, "f", None)
    assert nodes.count() == 1


def listed(pages, **options):
    items = F.col(f"body.data.{PATH}.edges")["node"]["id"]
    return {(r.request_id, r.segment): r["items"] for r in flatten.page_lists(pages, items, **options).collect()}


def test_page_lists_do_not_depend_on_the_order_or_number_of_arrivals(page_frame):
    lines = [*paged("p", 50, 2), *paged("q", 5, 3), page("r", connection(PATH, [])), page("s", {"node": None})]
    for seed in range(3):
        arrived = lines + lines[::2]
        random.Random(seed).shuffle(arrived)
        lists = listed(page_frame("pr_comments", *arrived))
        assert {k: len(v) for k, v in lists.items()} == {("p", 0): 20, ("p", 1): 20, ("p", 2): 10, ("q", 0): 5}
        assert sum((lists["p", s] for s in range(3)), []) == [f"c{i}" for i in range(50)]


def test_page_lists_take_the_last_landed_copy_whole(page_frame):
    def some(*ids):
        return connection(PATH, [edge(i, {"id": i}) for i in ids])

    lines = [
        landed(1, page("p", some("a", "b", "c"), 0)), landed(3, page("p", some("z", "a"), 0)), page("p", some("b"), 0),
        page("q", some("y", "b"), 1), page("q", some("x", "z"), 1), page("q", some("x"), 11),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(lines)
        pages = page_frame("pr_comments", *lines)
        assert listed(pages) == {("p", 0): ["z", "a"], ("q", 0): ["x", "z"], ("q", 1): ["x"]}
        assert listed(pages, pages_per_segment=1)["q", 11] == ["x"]
