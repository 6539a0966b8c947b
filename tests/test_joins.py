import pytest
from pyspark.sql import functions as F

from prflow.operators import joins


@pytest.fixture
def rows(spark):
    hot = [("hot", i) for i in range(300)]
    cold = [(f"k{i % 20}", i) for i in range(100)]
    return spark.createDataFrame(hot + cold + [(None, 1), (None, 2), ("absent", 1)], "k string, i int")


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(25)], "k string, v double")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_plain_join(rows, lookup, how):
    salted = joins.lookup_join(rows, lookup, ["k"], ["i"], how, heavy_rows=40, force=True)
    plain = rows.join(lookup, ["k"], how)
    key = lambda r: (str(r.k), r.i, str(r.v))
    assert sorted(salted.collect(), key=key) == sorted(plain.collect(), key=key)


def test_only_heavy_keys_are_salted_by_their_rows(rows):
    found = [tuple(r) for r in joins.heavy_keys(rows, ["k"], heavy_rows=50).collect()]
    assert found == [("hot", 6)]
    assert joins.heavy_keys(rows, ["k"], heavy_rows=1).count() == 21


def test_every_heavy_key_is_spread_however_many_there_are(spark):
    """Also those behind the 1,000th: each of 1,500 keys has 40 rows, a task may get 10 of one."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = spark.range(60_000).select((F.col("id") % 1_500).cast("string").alias("k"), F.col("id").alias("i"))
        lookup = spark.range(1_500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
        salted = joins.lookup_join(many, lookup, ["k"], ["i"], heavy_rows=10, together=True, force=True)
        per_key = salted.groupBy("k").agg(F.count_distinct("_salt").alias("salts"), F.count("*").alias("n"), F.max("v").alias("v"))
        got = per_key.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 1_500 and all(r.n == 40 and r.salts > 2 and r.v == 2 * int(r.k) for r in got)


def test_broadcast_is_left_to_the_optimizer_below_its_limit(spark):
    lookup = spark.range(10)
    assert joins.fits_broadcast(lookup)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not joins.fits_broadcast(lookup)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_task_gets_the_heavy_key_alone(spark, rows, lookup):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = joins.lookup_join(rows, lookup, ["k"], ["i"], heavy_rows=10)
        plain = rows.join(lookup, ["k"], "left")
        largest = [
            df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            for df in (salted, plain)
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert largest[0] < 200 and largest[1] >= 300


def test_heavy_keys_may_be_counted_elsewhere(spark, rows, lookup):
    narrow = spark.createDataFrame([("hot",)] * 60 + [("other",)] * 60, "k string")
    salted = joins.lookup_join(rows, lookup, ["k"], ["i"], heavy_rows=50, force=True, counted=narrow)
    assert salted.count() == rows.count()
    assert salted.filter("k = 'hot' and v = 1.0").count() == 300
