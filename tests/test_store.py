"""The versioned store: whole loads, two writers, reruns, pruning, upkeep."""

import os

from pyspark.sql import functions as F

from prflow import schemas
from prflow.plans.store import Store, bucket_of
from test_plans import plan_of

LISTS = "repository_id string, parent_id string, segment bigint, items array<string>"
NAME = "lists/COMMIT.comment_ids"


def put(store, *rows):
    store.put_lists("COMMIT", "comment_ids", store.spark.createDataFrame(list(rows), LISTS))


def stored(store):
    rows = store.lists("COMMIT", "comment_ids").collect()
    return sorted((r.parent_id, r.segment, r["items"]) for r in rows)


def pull_requests(spark, *rows):
    ids = spark.createDataFrame(list(rows), "id string, repository_id string, text string")
    return ids.select(
        *[F.col(f.name) if f.name in ids.columns else F.lit(None).cast(f.dataType).alias(f.name)
          for f in schemas.document_schema("PULL_REQUEST")]
    )


def files_of(root):
    return sum(len(names) for _, _, names in os.walk(root))


def test_a_load_replaces_whole_parents_and_counts_only_when_noted(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert stored(store) == []
    put(store, ("r", "p", 0, ["a"]), ("r", "p", 1, ["b"]), ("r", "q", 0, ["c"]))
    put(store, ("r", "p", 0, ["y"]), ("r", "n", 0, ["d"]))
    put(store, ("r", "p", 0, ["z"]))
    expected = [("n", 0, ["d"]), ("p", 0, ["z"]), ("q", 0, ["c"])]
    assert stored(store) == expected
    # rows without a note, and a note that was never finished, are not seen
    lost = spark.createDataFrame([("r", "q", 0, ["lost"])], LISTS).withColumn("bucket", F.lit(1))
    lost.write.partitionBy("bucket").parquet(f"{tmp_path}/{NAME}/rows/load=lost")
    assert stored(store) == expected
    open(f"{tmp_path}/{NAME}/versions/00000004.json", "w").close()
    import prflow.plans.store as module

    module.VOID_SECONDS, before = 0.2, module.VOID_SECONDS
    try:
        assert stored(store) == expected
        put(store, ("r", "q", 0, ["won"]))
        assert stored(store) == [*expected[:2], ("q", 0, ["won"])]
    finally:
        module.VOID_SECONDS = before


def test_the_same_lists_again_add_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = [("r", "p", 0, ["a"]), ("r", "p", 1, ["b"]), (None, "q", 0, ["c"])]
    put(store, *rows)
    before, version = files_of(tmp_path), store.version(NAME)
    put(store, *reversed(rows))
    assert (files_of(tmp_path), store.version(NAME)) == (before, version)
    # of a load with one change, only that parent is written
    put(store, *rows[1:], ("r", "p", 0, ["a2"]))
    newest = store.version(NAME)
    new = spark.read.parquet(f"{tmp_path}/{NAME}/rows/load={newest.loads[-1]}")
    assert {r.parent_id for r in new.collect()} == {"p"}
    # a list that became shorter is a change
    put(store, ("r", "p", 0, ["a2"]))
    assert stored(store) == [("p", 0, ["a2"]), ("q", 0, ["c"])]


def written_by(monkeypatch, work):
    """Numbers of rows of the frames that ``work`` deals by bucket."""
    dealt, write = [], Store._write

    def counting(self, name, rows, key, *more):
        dealt.append(rows.count())
        return write(self, name, rows, key, *more)

    monkeypatch.setattr(Store, "_write", counting)
    work()
    monkeypatch.undo()
    return dealt


def test_only_lists_that_differ_are_dealt_by_bucket(spark, tmp_path, monkeypatch):
    """A load is compared where it lies; before, all of it was dealt and written first."""
    store = Store(spark, str(tmp_path))
    rows = [("r", f"p{i}", s, [f"a{i}"]) for i in range(50) for s in range(2)] + [(None, "q", 0, ["c"]), ("r", "d", 0, ["x"])]
    put(store, *rows)
    assert written_by(monkeypatch, lambda: put(store, *reversed(rows))) == []
    some = [("r", "p7", 0, ["new"]), *rows[:3], ("r", "d", 0, ["x"]), ("r", "d", 0, ["x"]), (None, "n", 0, ["m"])]
    expected = {("p0", 0, "a0"), ("p0", 1, "a0"), ("p1", 0, "a1"), ("p7", 0, "new"), ("n", 0, "m"), ("q", 0, "c"), ("d", 0, "x")}
    expected |= {(f"p{i}", s, f"a{i}") for i in range(2, 50) if i != 7 for s in range(2)}
    # p7 changed, p1 lost a segment, n is new, d came twice: five rows
    lists = spark.createDataFrame(some, LISTS)
    lists.write.parquet(f"{tmp_path}/ready")
    files = spark.read.schema(lists.schema).parquet(f"{tmp_path}/ready")
    dealt = written_by(monkeypatch, lambda: store.put_lists("COMMIT", "comment_ids", files, ready=True))
    assert dealt == [5]
    got = stored(store)
    assert len(got) == len(expected) + 1 and {(p, s, i[0]) for p, s, i in got} == expected
    # only the loads that count are left
    loads = {n for n in os.listdir(f"{tmp_path}/{NAME}/rows")}
    assert loads == {f"load={load}" for load in store.version(NAME).loads}
    sizes = store.list_sizes("COMMIT", "comment_ids").agg(F.sum("n_items")).first()[0]
    assert store.compact(from_loads=2) == [NAME] and stored(store) == got
    assert store.list_sizes("COMMIT", "comment_ids").agg(F.sum("n_items")).first()[0] == sizes
    assert written_by(monkeypatch, lambda: store.put_lists("COMMIT", "comment_ids", store.lists("COMMIT", "comment_ids"))) == []


def test_two_writers_lose_nothing_and_store_nothing_twice(spark, tmp_path):
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    assert one.documents("PULL_REQUEST").count() == two.documents("PULL_REQUEST").count() == 0
    one.append("PULL_REQUEST", pull_requests(spark, ("a", "r", "one"), ("b", "r", "one")))
    two.append("PULL_REQUEST", pull_requests(spark, ("b", "r", "two"), ("c", "s", "two")))
    got = sorted((r.id, r.text) for r in one.documents("PULL_REQUEST").collect())
    assert got == [("a", "one"), ("b", "one"), ("c", "two")]
    one.append("PULL_REQUEST", pull_requests(spark, ("d", "r", "one")))
    two.append("PULL_REQUEST", pull_requests(spark, ("d", "r", "two")))  # nothing of it is left
    assert two.version("documents/PULL_REQUEST").number == 3 and two.documents("PULL_REQUEST").count() == 4
    # two replacements of one parent: the later one counts, whole
    put(one, ("r", "p", 0, ["a"]), ("r", "p", 1, ["b"]))
    taken = one._take
    raced = []

    def slow(*args):
        if not raced:
            raced.append(put(two, ("r", "p", 0, ["two"]), ("r", "q", 0, ["two"])))
        return taken(*args)

    one._take = slow
    put(one, ("r", "p", 0, ["one"]))
    assert stored(two) == [("p", 0, ["one"]), ("q", 0, ["two"])]


def test_scans_of_some_repositories_read_only_their_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = [(f"p{i}", f"r{i % 40}", "x") for i in range(200)]
    store.append("PULL_REQUEST", pull_requests(spark, *rows))
    put(store, *[(f"r{i % 40}", f"p{i}", 0, ["x"]) for i in range(200)])
    bucket = spark.range(1).select(bucket_of(F.lit("r7")).alias("b")).first().b
    for frame in (store.documents("PULL_REQUEST", [bucket]), store.lists("COMMIT", "comment_ids", [bucket])):
        own = frame.filter("repository_id = 'r7'")
        assert own.count() == 5
        scan = plan_of(own).split("FileScan")[1]
        assert "PartitionFilters: [" in scan and f"= {bucket})" in scan.split("PartitionFilters: [")[1].split("]")[0]
        read = own._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert read.relation().location().listFiles is not None
    assert store.documents("PULL_REQUEST", []).count() == 0


def test_compaction_and_vacuum_keep_what_counts(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for i in range(4):
        put(store, ("r", "p", 0, [f"v{i}"]), ("r", f"q{i}", 0, ["c"]))
    store.append("PULL_REQUEST", pull_requests(spark, ("a", "r", "x")))
    before, content = stored(store), store.version(NAME).content
    assert store.compact(from_loads=3) == [NAME]
    assert stored(store) == before and len(store.version(NAME).loads) == 1
    assert store.version(NAME).content == content and store.version(NAME).replacing == ()
    assert store.vacuum() == 4 and stored(store) == before
    assert [len(store.files.names(f"{tmp_path}/{NAME}/{part}")) for part in ("rows", "versions", "replaced")] == [1, 1, 0]
    rows = spark.read.parquet(f"{tmp_path}/{NAME}/rows")
    assert rows.count() == len(before)  # replaced rows are gone
    put(store, ("r", "p", 0, ["last"]))
    assert ("p", 0, ["last"]) in stored(store) and store.documents("PULL_REQUEST").count() == 1


def test_whole_documents_have_one_grain(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append("PULL_REQUEST", pull_requests(spark, ("a", "r", "x"), ("b", "r", "y")))
    kind = schemas.LIST_FIELDS["PULL_REQUEST"]
    edit = spark.range(25).select(
        F.lit("r").alias("repository_id"), F.lit("a").alias("parent_id"), F.col("id").alias("segment"),
        F.array(F.struct(F.concat(F.lit("E"), "id").alias("id"))).alias("items"), F.lit(False).alias("has_deletion"),
    )
    full = F.transform("items", lambda e: F.struct(e["id"].alias("id"), F.lit(None).alias("editor"), F.lit(None).alias("edited_timestamp"), F.lit(None).alias("difference")))
    store.put_lists("PULL_REQUEST", "edits", edit.withColumn("items", full.cast(f"array<{kind['edits']}>")))
    store.put_lists(
        "PULL_REQUEST", "commit_ids",
        spark.createDataFrame([("r", "a", s, [f"k{s}"]) for s in range(3)], LISTS),
    )
    whole = {(r.id, r.segment): r for r in store.whole("PULL_REQUEST").collect()}
    assert sorted(whole) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    assert [e.id for e in whole["a", 1].edits] == [f"E{i}" for i in range(10, 20)]
    assert whole["a", 2].commit_ids == ["k2"] and len(whole["a", 2].edits) == 5 and whole["b", 0].edits == []
