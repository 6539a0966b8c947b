"""The plans the design relies on."""

import re

from pyspark.sql import functions as F

from conftest import connection, edge, page, write_lines
from prflow import schemas
from prflow.operators import flatten, joins, reconcile
from prflow.plans import loads
from prflow.sinks import keyed
from prflow.sources import documents, pages


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, path, object_type="PULL_REQUEST"):
    spark.createDataFrame([], schemas.document_schema(object_type)).coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.schema(schemas.document_schema(object_type)).parquet(path)


def test_equalities_reach_the_scan(spark, tmp_path):
    docs = stored(spark, str(tmp_path / "docs"))
    plan = plan_of(documents.documents_of(docs, "r1", object_type="PULL_REQUEST").select("id"))
    assert "EqualTo(repository_id,r1)" in plan and "EqualTo(object_type,PULL_REQUEST)" in plan


def test_totals_read_two_columns(spark, tmp_path):
    docs = stored(spark, str(tmp_path / "docs"))
    plan = plan_of(reconcile.expected_totals(docs, "total_edits"))
    assert "ReadSchema: struct<repository_id:string,total_edits:int>" in plan


def test_flattening_parquet_pages_reads_only_the_fields_used(spark, tmp_path):
    node = {"id": "c1", "bodyText": "long", "author": {"login": "ann"}}
    lines = [page("p1", connection("node.comments", [edge("a", node)]))]
    write_lines(str(tmp_path / "json"), "pr_comments", lines)
    pages.land_as_parquet(spark, str(tmp_path / "json"), "pr_comments", str(tmp_path / "parquet"))
    landed = pages.read_parquet_pages(spark, str(tmp_path / "parquet"), "pr_comments")
    edges = flatten.flatten_connection(landed, "node.comments", fields=["id"])
    ids = edges.select("request_id", "node.id")
    assert [tuple(r) for r in ids.collect()] == [("p1", "c1")]
    plan = plan_of(ids)
    assert "bodyText" not in plan.split("ReadSchema")[1]


def test_a_small_increment_does_not_shuffle_the_stored_table(spark, tmp_path):
    folder = str(tmp_path / "stored")
    spark.range(200_000).select(F.col("id").cast("string").alias("id")).write.parquet(folder)
    table = spark.read.parquet(folder)
    increment = spark.range(3).select((F.col("id") * 100_000).cast("string").alias("id"))
    new = keyed.rows_to_insert(table, increment, ["id"], small_increment=True)
    assert [r.id for r in new.collect()] == ["200000"]
    # the scan of the stored ids feeds a broadcast join, not an exchange
    lines = new._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    above = [line for line in lines[:scan] if "BroadcastHashJoin" in line or "Exchange" in line]
    assert "LeftSemi" in above[-1] or "BroadcastHashJoin" in above[-1] or "LeftSemi" in above[-2]


def exchanges(df, column):
    """Columns of the shuffles in the plan that carry the column (a prefix)."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    return [x for x in inputs if re.search(rf"(^|, ){column}\w*#", x)]


def list_pages(spark, folder, parents, per_parent):
    lines = [
        page(f"p{i}", connection("node.commits", [{"node": {"commit": {"id": f"k{i}-{n}"}}}]), n)
        for i in range(parents) for n in range(per_parent)
    ]
    write_lines(folder, "pr_commit_ids", lines)
    pages.land_as_parquet(spark, folder, "pr_commit_ids", folder + "-parquet")
    return pages.read_parquet_pages(spark, folder + "-parquet", "pr_commit_ids")


def test_pages_of_a_list_step_are_exchanged_once(spark, tmp_path):
    landed = list_pages(spark, str(tmp_path / "landing"), 4, 25)
    documents = [(f"p{i}", "r", 25) for i in range(4)]
    parents = spark.createDataFrame(documents, "id string, repository_id string, total_commits int")
    parents.write.parquet(str(tmp_path / "parents"))
    parents = spark.read.parquet(str(tmp_path / "parents"))
    none = parents.select("id", F.lit(0).cast("long").alias("loaded")).filter("id is null")
    results = []
    for limit in (10 << 20, -1):  # parents broadcast, and not
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            lists = loads.commit_ids(landed, parents, none)
            assert len(exchanges(lists, "_items") + exchanges(lists, "buf")) == 1
            assert "posexplode" not in plan_of(lists)  # items are never rows
            results.append(sorted((r.parent_id, r.segment, r["items"]) for r in lists.collect()))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert results[0] == results[1] and len(results[0]) == 12
    assert results[0][0] == ("p0", 0, [f"k0-{n}" for n in range(10)])


def test_segments_of_a_hot_parent_are_spread_and_whole(spark):
    rows = spark.range(4_000).select(
        F.when(F.col("id") < 3_900, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("request_id"),
        F.col("id").alias("page_no"), F.array(F.col("id").cast("string")).alias("_items"),
    )
    parents = rows.select(F.col("request_id").alias("id"), F.lit("r").alias("repository_id")).distinct()
    segment = F.floor(F.col("page_no") / 10)
    owned = joins.inherit_parent_keys(
        rows, parents, {"repository_id": "repository_id"}, spread=[segment], together=True, force=True, heavy_rows=50
    )
    lists = flatten.page_lists(owned, F.col("_items"), ["repository_id", "request_id"], also=["_salt"])
    assert len(exchanges(lists, "_items") + exchanges(lists, "buf")) == 1
    got = {(r.request_id, r.segment): r["items"] for r in lists.collect()}
    assert len(got) == 490 and got["hot", 7] == [str(i) for i in range(70, 80)]
    spread = owned.filter("request_id = 'hot'").groupBy("_salt").count().collect()
    assert len(spread) > 40 and max(r["count"] for r in spread) < 400


def test_a_salted_semi_join_keeps_each_row_once(spark):
    rows = spark.range(2_000).select(F.when(F.col("id") < 1_500, "hot").otherwise("cold").alias("k"), "id")
    lookup = spark.createDataFrame([("hot",), ("other",)], "k string")
    kept = joins.lookup_join(rows, lookup, ["k"], ["id"], "left_semi", heavy_rows=100, force=True)
    assert sorted(r.id for r in kept.collect()) == list(range(1_500)) and kept.columns == ["k", "id"]


def test_bodies_of_new_documents_come_last_and_cross_one_exchange(spark, tmp_path):
    def comment(i, text):
        return edge(i, {"id": i, "bodyText": text, "author": {"login": f"a{i[-1]}"}})

    lines = []
    for p in range(6):
        for n in range(4):
            data = connection("node.comments", [comment(f"c{p}-{n}-{k}", f"text {p} {n} {k}") for k in range(3)])
            lines.append(page(f"p{p}", data, n))
    again = connection("node.comments", [comment("c0-0-1", "late"), comment("c5-1-1", "elsewhere")])
    lines.append({**page("p0", again, 0), "landed_at": 7})
    lines += lines[:3]
    write_lines(str(tmp_path / "json"), "pr_comments", lines)
    pages.land_as_parquet(spark, str(tmp_path / "json"), "pr_comments", str(tmp_path / "parquet"))
    landed = pages.read_parquet_pages(spark, str(tmp_path / "parquet"), "pr_comments")
    parents = spark.createDataFrame([(f"p{p}", "r", 50) for p in range(5)], "id string, repository_id string, total_comments int")
    stored = spark.createDataFrame([("c1-0-0", "p1"), ("c2-3-2", "p2")], "id string, pull_request_id string")
    matches = spark.createDataFrame([("a1", "U1")], "login string, actor_id string")
    results, crossed = [], []
    for limit in (10 << 20, -1):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            for given in (flatten.current_pages(landed), pages.with_place(landed)):
                located = "page_row" in given.columns
                given = flatten.current_fetch(given) if located else given
                children = loads.pr_comments(given, parents, stored, matches).documents
                results.append(sorted((r.id, r.text, r.pull_request_id, r.author.id) for r in children.collect()))
            fetched = loads.pr_comments(pages.with_place(landed), parents, stored, matches).documents
            crossed.append(len(exchanges(fetched, "_edges") + exchanges(fetched, "body") + exchanges(fetched, "node")))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all(r == results[0] for r in results) and len(results[0]) == 2 + 4 * 12 - 2 - 0
    assert ("c0-0-1", "late", "p0", "U1") in results[0]
    assert max(crossed) <= 1
