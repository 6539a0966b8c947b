import itertools

import pytest

from prflow.operators import reconcile
from prflow.plans.steps import STEP_PARENTS, STEPS


def test_an_excess_can_hide_a_shortage_but_not_from_the_parents(spark):
    parents = spark.createDataFrame(
        [("a", "r", 2), ("b", "r", 2), ("c", "s", 1)], "id string, repository_id string, total_edits int"
    )
    lists = spark.createDataFrame(
        [("r", "a", 0, [1, 2]), ("r", "a", 1, [3]), ("r", "b", 0, [1]), ("s", "c", 0, [1])],
        "repository_id string, parent_id string, segment bigint, items array<int>",
    )
    expected = reconcile.sides(reconcile.expected_totals(parents, "total_edits"), total_edits=[(5, "expected")])
    actual = reconcile.sides(reconcile.actual_list_totals(lists), actual=[(5, "actual")])
    scope = spark.createDataFrame([("r",), ("s",), ("empty",)], "id string")
    rows = {r.repository_id: r for r in reconcile.step_report([expected, actual], scope, [5]).collect()}
    assert (rows["r"].expected, rows["r"].actual, rows["r"].ok) == (4, 4, True)
    assert rows["empty"].ok
    counts = reconcile.list_counts(lists)
    wrong = reconcile.mismatched_parents(parents, "total_edits", counts)
    assert {r.repository_id: r.mismatched for r in wrong.collect()} == {"r": 2, "s": 0}
    todo = reconcile.incomplete_parents(parents, "total_edits", counts)
    assert [r.id for r in todo.collect()] == ["b"]


def test_commits_the_api_does_not_return_count_as_declared(spark):
    parents = spark.createDataFrame(
        [("a", "r", 5, "GIT_RETURNED_LESS"), ("b", "r", 5, "LOADED_SUCCESSFULLY"), ("c", "r", 5, None)],
        "id string, repository_id string, total_commits int, commit_id_load_status string",
    )
    counts = spark.createDataFrame([("a", 3), ("b", 5)], "id string, loaded long")
    assert reconcile.actual_commit_totals(parents, counts).first().actual == 10


def closure():
    known = {}
    for step in STEPS:
        known[step.number] = {step.number}.union(*[known[p] for p in step.requires])
    return known


def test_upstream_is_the_closure():
    got = {}
    for step, needs in reconcile.upstream(STEP_PARENTS):
        got.setdefault(step, set()).add(needs)
    assert got == closure()
    assert [s for s in STEP_PARENTS if not any(s in p for p in STEP_PARENTS.values())] == [19, 21, 32]


@pytest.mark.parametrize("broken", [1, 10, 16, 30])
def test_a_step_is_not_done_when_a_step_it_requires_is_not(spark, broken):
    numbers = list(STEP_PARENTS)
    rows = [
        (n, r, not (n == broken and r == "bad"))
        for n, r in itertools.product(numbers, ["good", "bad"])
        if n < 31
    ] + [(n, None, True) for n in (31, 32)]
    report = spark.createDataFrame(rows, "step int, repository_id string, ok boolean")
    got = reconcile.recursive_report(spark, report, STEP_PARENTS, (31, 32)).collect()
    reached = closure()
    for r in got:
        wanted = broken not in reached[r.step] or r.repository_id == "good"
        assert r.ok_recursive == wanted, r


def test_a_step_without_a_report_is_not_done(spark):
    report = spark.createDataFrame([(2, "r", True)], "step int, repository_id string, ok boolean")
    assert not reconcile.recursive_report(spark, report, STEP_PARENTS).first().ok_recursive
