from pyspark.sql import functions as F

from conftest import page
from prflow.operators import actors


def search(login, nodes, page_no=0):
    return page(login, {"search": {"nodes": nodes}}, page_no)


def test_login_matches_exactly_and_first(page_frame):
    pages = page_frame(
        "user_search",
        search("ann", [{"id": "9", "login": "ann"}], 1),
        search("ann", [{"id": "1", "login": "Ann"}, {"id": "2"}, {"id": "3", "login": "ann"}], 0),
        search("bob", [{"id": "4", "login": "bobby"}]),
        search("eve", []),
    )
    assert [tuple(r) for r in actors.login_matches(pages).collect()] == [("ann", "3")]


def test_resolve_by_login(spark, page_frame):
    matches = actors.login_matches(page_frame("user_search", search("ann", [{"id": "1", "login": "ann"}])))
    rows = spark.createDataFrame([(1, "ann"), (2, "ANN"), (3, None)], "i int, login string")
    got = actors.resolve_by_login(rows, F.col("login"), matches, "a", ["i"]).orderBy("i").collect()
    assert [tuple(r.a) for r in got] == [("1", "USER"), ("ANN", "UNKNOWN"), ("", "UNKNOWN")]


def test_resolve_by_id(spark, page_frame):
    pages = page_frame(
        "node_type",
        page("b", {"node": {"__typename": "Bot", "id": "b"}}),
        page("f", {"node": {"__typename": "Foo", "id": "f"}}),
        page("n", {"node": None}),
    )
    rows = spark.createDataFrame([("b",), ("f",), ("n",), ("x",), (None,)], "u string")
    found = actors.resolve_by_id(rows, F.col("u"), actors.actor_types(pages), "a", ["u"])
    assert {r.u: tuple(r.a) for r in found.collect()} == {
        "b": ("b", "BOT"), "f": ("f", "UNKNOWN"), "n": ("n", "UNKNOWN"), "x": ("x", "UNKNOWN"),
        None: ("", "UNKNOWN"),
    }


def test_document_users_reads_every_actor_column(spark):
    actor = "struct<id:string,author_type:string>"
    docs = spark.createDataFrame(
        [(("a", "USER"), ("c", "USER")), (("b", "BOT"), ("a", "USER"))],
        f"author {actor}, committer {actor}",
    )
    edits = spark.createDataFrame(
        [([(("e", "USER"),), (("f", "UNKNOWN"),)],), ([],), (None,)],
        f"items array<struct<editor:{actor}>>",
    )
    people = spark.createDataFrame([([("p", "USER"), ("a", "USER")],)], f"items array<{actor}>")
    users = actors.document_users(
        docs, {"edits": edits, "participants": people}, ["author", "committer"]
    )
    assert sorted(r.id for r in users.collect()) == ["a", "c", "e", "p"]
