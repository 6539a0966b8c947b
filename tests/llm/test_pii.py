"""Format-preserving pseudonyms: formats, links, and a permutation of the format."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import functions as F

from prflow.llm import pii


def luhn(number):
    digits = [int(c) for c in number[::-1] if c.isdigit()]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def run(spark, texts, key="k"):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.pseudonymize(frame, key).collect()}


def test_values_keep_their_format_and_their_links(spark):
    text = (
        "Call +1 (017) 555-7713 or mail Jo.Doe7@mail3.example.com. Card 4111 1111 1111 1111, at 10.20.30.40 on "
        "2021-02-28, born 29.02.2000; SSN 123-45-6789."
    )
    got = run(spark, [text, "again: 4111 1111 1111 1111 and jo.doe7@mail3.example.com!", text])
    new = got[0]["text"]
    assert list(got[0]["replaced"]) == ["phone", "email", "card", "ip", "date", "date", "ssn"]
    for old in ("555-7713", "Jo.Doe7", "4111 1111", "10.20.30.40", "2021-02-28", "29.02.2000", "123-45-6789"):
        assert old not in new
    card = re.search(r"Card (\d{4} \d{4} \d{4} \d{4})", new)[1]
    assert luhn(card) and card in got[1]["text"]
    name = re.search(r"mail (\S+)@mail3", new)[1]
    assert re.fullmatch(r"[A-Z][a-z]\.[A-Z][a-z]{2}\d", name) and name.lower() in got[1]["text"]
    date.fromisoformat(re.search(r"on (\d{4}-\d\d-\d\d),", new)[1])
    day, month, year = map(int, re.search(r"born (\d\d)\.(\d\d)\.(\d{4})", new).groups())
    date(year, month, day)
    assert all(int(x) < 256 for x in re.search(r"at (\S+) on", new)[1].split("."))
    assert got[2]["text"] == new
    assert run(spark, [text], key="other")[0]["text"] != new


def test_what_fails_its_check_stays(spark):
    texts = [
        "4111 1111 1111 1112 is no card", "999.1.1.1 no address", "2021-02-30 no day", "666-12-3456 no number",
        None, "", "nothing here", "v1.2.3.4.5", "12345", "a@b", "Version 4.0.", "\n\n", "token = \"04dbebab91ab85687d33\"",
    ]
    got = run(spark, texts)
    assert [got[i]["text"] for i in range(len(texts))] == texts
    assert all(len(r["replaced"]) == 0 for r in got.values())


def test_digits_are_permuted_one_to_one(spark):
    frame = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = [r[0] for r in frame.select(pii.permute_digits(F.col("d"), "k", "t")).collect()]
    assert sorted(out) == [f"{i:03d}" for i in range(1000)] and out != sorted(out)


def test_unequal_sides_are_permuted_one_to_one(spark):
    pairs = spark.range(189 * 7).select((F.col("id") / 7).cast("long").alias("l"), (F.col("id") % 7).alias("r"))
    out = pairs.select(pii.feistel(F.col("l"), F.col("r"), 189, 7, "k", "t").alias("s")).select("s.l", "s.r")
    assert out.distinct().count() == 189 * 7
    assert out.filter("l < 0 or l >= 189 or r < 0 or r >= 7").count() == 0


def test_names_are_permuted_one_to_one(spark):
    names = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    got = run(spark, [f"{n}@x.org" for n in names] + ["ümlaut.1@x.org", "x" * 40 + "1" * 20 + "@x.org"])
    out = [got[i]["text"] for i in range(len(names))]
    assert len(set(out)) == len(names) and all(re.fullmatch(r"[a-z]{2}@x\.org", t) for t in out)
    assert re.fullmatch(r"[a-z]{6}\.\d@x\.org", got[len(names)]["text"])
    assert re.fullmatch(r"[a-z]{40}\d{20}@x\.org", got[len(names) + 1]["text"])


def test_clashing_columns_empty_tables_and_no_python(spark):
    schema = "doc_id long, text string, kind int, p int, _pii string, row int, done int, replaced int"
    frame = spark.createDataFrame([(1, "1.2.3.4", 5, 6, "own", 7, 8, 9)], schema)
    out = pii.pseudonymize(frame, "k")
    assert out.columns == ["doc_id", "text", "kind", "p", "_pii", "row", "done", "replaced"]
    got = out.first()
    assert (got["kind"], got["_pii"], got["row"], got["done"], got["replaced"]) == (5, "own", 7, 8, ["ip"])
    assert pii.pseudonymize(frame.limit(0), "k").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_very_long_texts_are_read_whole(spark):
    text = "some words here " * 60_000 + "10.20.30.40 " + "more words " * 60_000 + "a.b@example.org"
    got = run(spark, [text, "10.20.30.40 a.b@example.org"])
    assert len(got[0]["replaced"]) == 2
    new_ip, new_mail = got[1]["text"].split(" ")
    assert got[0]["text"] == text.replace("10.20.30.40", new_ip).replace("a.b@example.org", new_mail)
