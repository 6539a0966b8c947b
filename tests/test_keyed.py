from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prflow.sinks import keyed

DDL = "id string, place int, v string"
row = st.tuples(st.sampled_from("abcdef"), st.integers(0, 5), st.sampled_from("xyz"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_insert_twice_is_insert_once_and_the_first_version_wins(spark, first, second):
    stored = keyed.first_versions(spark.createDataFrame(first, DDL), ["id"], ["place", "v"])
    incoming = spark.createDataFrame(second, DDL)
    once = keyed.insert_if_absent(stored, incoming, ["place", "v"])
    twice = keyed.insert_if_absent(once, incoming, ["place", "v"])
    expected = {}
    for batch in (first, second):
        new = {}
        for r in sorted(batch, key=lambda r: (r[1], r[2])):
            new.setdefault(r[0], r)
        expected = {**new, **expected}
    got = sorted(tuple(r) for r in once.collect())
    assert got == sorted(expected.values())
    assert got == sorted(tuple(r) for r in twice.collect())
    small = keyed.rows_to_insert(stored, incoming, ["place", "v"], small_increment=True)
    assert {r.id for r in small.collect()} == set(expected) - {r[0] for r in first}


def test_copies_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("id"), F.col("id").alias("place"))
    plan = keyed.first_versions(df, ["id"], ["place"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_set_fields(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, s string")
    updates = spark.createDataFrame([("a", None, True), ("z", 9, True)], "id string, n int, late boolean")
    got = keyed.set_fields(target, updates, ["n", "late"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a", None, "x", True), ("b", 2, "y", None)]


def test_upsert_repositories(spark):
    ddl = (
        "id string, name string, owner string, total_pull_requests int, "
        "insert_timestamp timestamp, update_timestamp timestamp, object_type string"
    )
    stored = spark.createDataFrame([], ddl)
    incoming = spark.createDataFrame(
        [("R1", "o", "n", 5)], "id string, owner string, name string, total_pull_requests int"
    )
    one, two = (F.lit(f"2021-01-0{d} 00:00:00").cast("timestamp") for d in (1, 2))
    first = keyed.upsert_repositories(stored, incoming, one)
    again = incoming.withColumn("total_pull_requests", F.lit(7))
    row = keyed.upsert_repositories(first, again, two).first()
    assert (row.id, row.total_pull_requests) == ("R1", 7)
    assert (row.insert_timestamp.day, row.update_timestamp.day) == (1, 2)
    untouched = keyed.upsert_repositories(first, incoming.limit(0), two).first()
    assert (untouched.total_pull_requests, untouched.update_timestamp.day) == (5, 1)
