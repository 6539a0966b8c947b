"""Connected components by alternating large-star and small-star rounds.

Each round is aggregates and joins over edges only. No group is gathered in a
task: a hot node is a hot join key, which the skew join splits, and its minimum
is a partial aggregate. The edges are written after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import written

MOST_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; the root is the smallest
    node of the component. Loops, repeated edges and edges with a null end are
    allowed and ignored; without edges the result is empty. Nodes can be of
    any orderable type."""
    now = edges.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    now = written(now.distinct(), "edges")
    state = _state(now)
    if state[0]:
        for _ in range(MOST_ROUNDS):
            now = written(_small_star(_large_star(now)), "edges")
            before, state = state, _state(now)
            if state == before:
                break
        else:
            raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
