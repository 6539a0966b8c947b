from pyspark.sql import functions as F

from conftest import connection, edge, page, write_lines
from prflow.operators import flatten, project
from prflow.sinks import keyed
from prflow.sources.pages import read_pages
from prflow import schemas
from prflow.plans.store import Store
from prflow.streaming.ingest import ingest_stream, ingested
from test_plans import plan_of


def documents(pages):
    edges = flatten.flatten_connection(pages, "node.comments")
    owned = edges.withColumn("pull_request_id", F.col("request_id")).withColumn(
        "repository_id", F.lit("r")
    )
    return project.to_pr_comment(owned, keep=["page_no", "pos"])


def comments(*ids, text="first"):
    return [edge(i, {"id": i, "bodyText": f"{text} {i}"}) for i in ids]


def stored(spark, target):
    return ingested(spark, target, "pr_comments", schemas.document_schema("PULL_REQUEST_COMMENT"))


def test_files_in_any_portions_give_the_batch_result(spark, tmp_path):
    landing = str(tmp_path / "landing")

    def land(at, page_no, text, *ids):
        line = page("p", connection("node.comments", comments(*ids, text=text)), page_no)
        write_lines(landing, "pr_comments", [{**line, "landed_at": at}])

    # later versions come in earlier files
    land(5, 0, "five", "a", "b")
    land(3, 2, "three", "b", "c", "a")
    land(3, 1, "first", "a")
    land(9, 0, "nine", "c", "d", "b")

    def dated(pages):
        edges = flatten.flatten_connection(pages, "node.comments", [*flatten.ENVELOPE, "landed_at"])
        owned = edges.withColumn("pull_request_id", F.col("request_id")).withColumn("repository_id", F.lit("r"))
        return project.to_pr_comment(owned, keep=["landed_at", "page_no", "pos"])

    accepted, _ = read_pages(spark, landing, "pr_comments")
    batch = keyed.first_versions(dated(accepted), ["id"], ["landed_at", "page_no", "pos"])
    expected = {r.id: r.text for r in batch.collect()}
    assert expected == {"a": "first a", "b": "three b", "c": "three c", "d": "nine d"}
    for files in (1, 2, 100):
        target = str(tmp_path / f"target{files}")
        ingest_stream(spark, landing, "pr_comments", dated, target, str(tmp_path / f"point{files}"), max_files=files)
        rows = stored(spark, target).collect()
        assert {r.id: r.text for r in rows} == expected and len(rows) == 4
    # what a micro-batch compares with is read from its buckets
    store = Store(spark, str(tmp_path / "target1"))
    newest = store.version("ingested/pr_comments")
    schema = schemas.document_schema("PULL_REQUEST_COMMENT")
    older = store._same_buckets("ingested/pr_comments", schema, "id", newest, newest.loads[-1])
    assert "bucket" in plan_of(older).split("PartitionFilters: [")[1].split("]")[0]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))

    def land(*lines):
        write_lines(landing, "pr_comments", lines)

    def ingest():
        ingest_stream(spark, landing, "pr_comments", documents, target, checkpoint)
        return {r.id: r.text for r in stored(spark, target).collect()}

    land(page("p", connection("node.comments", comments("a", "b"))))
    land(page("p", connection("node.comments", comments("c")), 1), {"request_id": "p", "body": {}})
    assert set(ingest()) == {"a", "b", "c"}
    assert set(ingest()) == {"a", "b", "c"}
    land(page("p", connection("node.comments", comments("b", "d", text="second")), 2))
    got = ingest()
    assert got == {"a": "first a", "b": "first b", "c": "first c", "d": "second d"}
    assert stored(spark, target).count() == 4
    accepted, _ = read_pages(spark, landing, "pr_comments")
    batch = keyed.first_versions(documents(accepted), ["id"], ["page_no", "pos"])
    assert {r.id: r.text for r in batch.collect()} == got
    # a lost checkpoint replays everything and still adds nothing
    ingest_stream(spark, landing, "pr_comments", documents, target, checkpoint + "-new")
    assert stored(spark, target).count() == 4
