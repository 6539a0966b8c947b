import datetime

import pytest
from pyspark.sql import functions as F

from prflow.functions import scalars as S


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2021-03-04T05:06:07Z", "2021-03-04 05:06:07"),
        ("2021-03-04T05:06:07+02:00", "2021-03-04 03:06:07"),
        ("2021-03-04T05:06:07-0500", "2021-03-04 10:06:07"),
        ("2021-03-04T05:06:07.123Z", None),
        ("2021-03-04T05:06:07", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(S.parse_timestamp(F.col("t")).alias("t")).first().t
    wanted = datetime.datetime.fromisoformat(expected) if expected else None
    assert got == wanted


def test_strict_timestamp_fails_the_job(spark):
    df = spark.createDataFrame([("2021-03-04T05:06:07.5Z",)], "t string")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(S.parse_timestamp(F.col("t"), strict=True)).collect()


def test_minimized_status(spark):
    df = spark.createDataFrame(
        [(1, True, "SPAM"), (2, True, None), (3, False, "SPAM"), (4, None, None)],
        "i int, m boolean, r string",
    )
    got = {
        r.i: r.s for r in df.select("i", S.minimized_status(F.col("m"), F.col("r")).alias("s")).collect()
    }
    assert got == {1: "SPAM", 2: None, 3: "NOT MINIMIZED", 4: "NOT MINIMIZED"}


def test_inline_comment(spark):
    df = spark.createDataFrame([(None,), (0,), (5,)], "p int")
    assert [r[0] for r in df.select(S.inline_comment(F.col("p"))).collect()] == [False, False, True]


def test_actor_type(spark):
    names = ["Bot", "User", "mannequin", "Organization", "EnterpriseUserAccount", "Foo", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(S.actor_type(F.col("n"))).collect()] == [
        "BOT", "USER", "MANNEQUIN", "ORGANIZATION", "ENTERPRISE_USER_ACCOUNT", "UNKNOWN", "UNKNOWN",
    ]


def test_load_status_labels_an_excess_like_a_shortage(spark):
    df = spark.createDataFrame([(2, 2), (2, 1), (2, 3)], "e int, a int")
    assert [r[0] for r in df.select(S.load_status(F.col("e"), F.col("a"))).collect()] == [
        "LOADED_SUCCESSFULLY", "GIT_RETURNED_LESS", "GIT_RETURNED_LESS",
    ]


def test_unloaded_list_counts_as_empty(spark):
    df = spark.createDataFrame([(None,), ([],), ([1, 2],)], "a array<int>")
    assert [r[0] for r in df.select(S.list_size(F.col("a"))).collect()] == [0, 0, 2]
