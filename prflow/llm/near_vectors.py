"""Embedding near-duplicates: cross-polytope hashing with multiprobe buckets.

A table rotates a vector by three rounds of random signs and a fast Hadamard
transform and takes the coordinate with the largest value and its sign: the
nearest corner of the cross-polytope; a bucket is ``parts`` such corners. A
vector lies in one bucket of each table and looks into this one and the
``probes`` next best. How many parts and tables there are follows from the
number of vectors and from the hit rate of made pairs at the very threshold, so
the least similar pairs are found as often in a large corpus as in a small one.

Equal vectors are one vector with a number of copies. The others of a bucket
are compared by matrix products inside a task; no pair becomes a row. A pair
that several buckets see counts in the first of them only, which each task
tells by hashing the pair's two vectors again. A bucket gives partial link
counts and a spanning forest, so its output is in proportion to its rows. A
large bucket is cut into blocks that are compared two by two in tasks of their
own.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import product
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import boxed, written
from prflow.llm.components import components
from prflow.llm.vectors import matrix, usable

SIMILAR = 0.98
RECALL = 0.999  # aimed at for pairs exactly at the threshold
PROBES = 8
LOAD = 4  # vectors of a bucket if they were spread evenly
BLOCK = 1024
SEED = 42


class Hashing(NamedTuple):
    parts: int
    tables: int
    probes: int


# -- hashing --------------------------------------------------------------------


@lru_cache(maxsize=256)
def _signs(table: int, part: int, turn: int, width: int):
    import numpy as np

    return np.random.default_rng([SEED, table, part, turn, width]).choice([-1.0, 1.0], width)


def _rotated(rows, table: int, part: int):
    import numpy as np

    width = 1 << max(1, (rows.shape[1] - 1).bit_length())
    y = np.zeros((len(rows), width))
    y[:, : rows.shape[1]] = rows
    for turn in range(3):
        y = y * _signs(table, part, turn, width)
        step = 1
        while step < width:  # fast Hadamard transform
            pairs = y.reshape(len(y), -1, 2, step)
            y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(y), width)
            step *= 2
        y = y / math.sqrt(width)
    return y


@lru_cache(maxsize=64)
def _choices(parts: int, probes: int) -> list[tuple[int, ...]]:
    """Places (one for each part, from 0) that can be among the best probes:
    whoever is better in every part comes first."""
    return [c for c in product(range(probes + 1), repeat=parts) if math.prod(p + 1 for p in c) <= probes + 1]


def codes(rows, table: int, hashing: Hashing):
    """Bucket numbers of unit vectors: one row each, its own bucket first, then
    the probes by what they lose."""
    import numpy as np

    count = hashing.probes + 1
    corners, losses = [], []
    for part in range(hashing.parts):
        y = _rotated(rows, table, part)
        size = np.abs(y)
        order = np.argsort(-size, axis=1, kind="stable")[:, :count]
        best = np.take_along_axis(size, order, 1)
        corners.append(2 * order + (np.take_along_axis(y, order, 1) < 0))
        losses.append((best[:, :1] - best) ** 2)
    at_most = corners[0].shape[1]
    picks = np.array([c for c in _choices(hashing.parts, hashing.probes) if max(c) < at_most])
    loss = sum(part[:, picks[:, i]] for i, part in enumerate(losses))
    first = np.argsort(loss, axis=1, kind="stable")[:, :count]
    code = np.zeros((len(rows), first.shape[1]), np.uint64)
    for i, part in enumerate(corners):
        chosen = np.take_along_axis(part[:, picks[:, i]], first, 1)
        code = code * np.uint64(0x9E3779B97F4A7C15) + chosen.astype(np.uint64) + np.uint64(1)
    return code.view(np.int64)


def plan_hashing(largest: int, dimension: int, similar: float, probes: int = PROBES, recall: float = RECALL) -> Hashing:
    """Parts so that ``largest`` vectors spread over enough buckets, and tables
    so that made pairs at the threshold meet as often as asked for."""
    import numpy as np

    width = 1 << max(1, (dimension - 1).bit_length())
    parts = max(1, math.ceil(math.log(max(1, largest / LOAD), 2 * width) - 1e-9))
    rng = np.random.default_rng(SEED)
    a = rng.standard_normal((2000, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, dimension))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    b = similar * a + math.sqrt(max(0.0, 1 - similar**2)) * b
    hashing, missed, tables = Hashing(parts, 1, probes), np.ones(len(a)), 0
    shares = []
    while tables < 4:
        x, y = codes(a, tables, hashing), codes(b, tables, hashing)
        shares.append(((x[:, :1] == y).any(1) | (y[:, :1] == x).any(1)).mean())
        tables += 1
    hit = min(max(float(np.mean(shares)), 1e-3), 1 - 1e-6)
    return hashing._replace(tables=max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit))))


def _unit(rows):
    """Rows over their length; powers of two first, so that nothing overflows."""
    import numpy as np

    _, exponent = np.frexp(np.abs(rows).max(1))
    scaled = np.ldexp(rows, -exponent[:, None])
    return scaled / np.sqrt((scaled * scaled).sum(1))[:, None]


# -- comparing blocks -------------------------------------------------------------


def _first_meeting(unit, before, left, right, table: int, hashing: Hashing):
    """Which pairs (left lies in a bucket of ``table`` that right looks into)
    do not meet elsewhere first: in an earlier table or, in this one, in the
    other's bucket if that comes ``before`` (its key is the smaller one)."""
    import numpy as np

    alive = np.ones(len(left), bool)
    used, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = place[: len(left)], place[len(left) :]
    for earlier in range(table + 1):
        code = codes(unit[used], earlier, hashing)
        for at in range(0, len(left), 65_536):
            some = np.flatnonzero(alive[at : at + 65_536]) + at
            x, y = a[some], b[some]
            met = (code[y, :1] == code[x]).any(1)  # right's own bucket, seen by left
            if earlier < table:
                met |= (code[x, :1] == code[y]).any(1)
            else:
                met &= before[some]
            alive[some[met]] = False
    return alive


def _forest(n: int, a, b):
    """The smallest member of each of n nodes' group under the links (a, b)."""
    import numpy as np

    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block_links(key, copies, role, vectors, table: int, similar: float, hashing: Hashing):
    """Of one block: keys (two numbers each), links and root keys of the
    vectors with links. ``role`` 0 lies in the bucket, 1 looks into it, 2 both."""
    import numpy as np

    lies, looks = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
    unit = _unit(vectors)
    left, right = np.nonzero(unit[lies] @ unit[looks].T >= similar)
    left, right = lies[left], looks[right]
    other = (key[left] != key[right]).any(1)
    left, right = left[other], right[other]
    if not len(left):
        return None
    x, y = key[left], key[right]
    before = (y[:, 0] < x[:, 0]) | ((y[:, 0] == x[:, 0]) & (y[:, 1] < x[:, 1]))
    first = _first_meeting(unit, before, left, right, table, hashing)
    left, right = left[first], right[first]
    if not len(left):
        return None
    rows, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    used, same = np.unique(key[rows], axis=0, return_inverse=True)  # who lies and looks is one
    place = same.reshape(-1)[place]
    a, b = place[: len(left)], place[len(left) :]
    links = np.zeros(len(used), np.int64)
    np.add.at(links, a, copies[right])
    np.add.at(links, b, copies[left])
    return used, links, used[_forest(len(used), a, b)]


KEY = "label int, size int, place int, code long, lies int, looks int"


def _compared(rows: DataFrame, similar: float, hashing: Hashing) -> DataFrame:
    """``(h1, h2, links, r1, r2)`` of each block's linked vectors. Rows are
    sorted by block; a block is closed when the next one begins."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kept: list = []

        def linked(part: pa.RecordBatch):
            """All blocks of a batch that ends with a block."""
            block = [part.column(i).to_numpy() for i in range(6)]
            new = np.any([c[1:] != c[:-1] for c in block], axis=0)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            ends = np.append(starts[1:], part.num_rows)
            key = np.column_stack([part.column(6).to_numpy(), part.column(7).to_numpy()])
            copies, role = part.column(8).to_numpy(), part.column(9).to_numpy()
            lie = np.add.reduceat((role != 1).astype(np.int64), starts)
            found = []
            several = (ends - starts > 1) & (lie > 0)
            for start, end in zip(starts[several].tolist(), ends[several].tolist()):
                vectors = matrix(part.column(10).slice(start, end - start))
                got = _block_links(
                    key[start:end], copies[start:end], role[start:end], vectors, int(block[2][start]), similar, hashing
                )
                if got is not None:
                    found.append(got)
            if found:
                used, links, roots = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in (used[:, 0], used[:, 1], links, roots[:, 0], roots[:, 1])],
                    ["h1", "h2", "links", "r1", "r2"],
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            if kept and [kept[0].column(i)[0] for i in range(6)] != [batch.column(i)[0] for i in range(6)]:
                yield from linked(_joined(kept))
                kept = []
            last = [batch.column(i).to_numpy() for i in range(6)]
            same = np.all([c == c[-1] for c in last], axis=0)
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield from linked(_joined([*kept, batch.slice(0, cut)]))
                kept = []
            kept.append(batch.slice(cut))
        if kept:
            yield from linked(_joined(kept))

    return rows.mapInArrow(run, "h1 long, h2 long, links long, r1 long, r2 long")


def _joined(batches):
    import pyarrow as pa

    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _hashed(vectors: DataFrame, hashing: Hashing, payload: bool) -> DataFrame:
    """A row for every bucket a vector lies in or looks into: role 2 for its
    own, 1 for the probes. With the payload, the vectors come along."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                sizes = batch.column(1).to_numpy()
                for size in np.unique(sizes):
                    same = batch.take(pa.array(np.flatnonzero(sizes == size)))
                    unit = _unit(matrix(same.column(5)))
                    for table in range(hashing.tables):
                        code = codes(unit, table, hashing)
                        n, width = code.shape
                        each = pa.array(np.repeat(np.arange(n), width))
                        role = np.ones((n, width), np.int32)
                        role[:, 0] = 2
                        columns = [
                            same.column(0).take(each), same.column(1).take(each),
                            pa.array(np.full(n * width, table, np.int32)), pa.array(code.ravel()), pa.array(role.ravel()),
                        ]
                        if payload:
                            columns += [same.column(i).take(each) for i in (2, 3, 4, 5)]
                        yield pa.RecordBatch.from_arrays(columns, names)

    head = "label int, size int, place int, code long, role int"
    kind = vectors.schema["vector"].dataType.simpleString()
    schema = f"{head}, h1 long, h2 long, copies long, vector {kind}" if payload else head
    names = [part.split()[0] for part in schema.split(", ")]
    return vectors.select("label", "size", "h1", "h2", "copies", "vector").mapInArrow(run, schema)


def _blocks(vectors: DataFrame, hashing: Hashing, block: int) -> DataFrame:
    """Hashed rows with the numbers of the two blocks they meet in. A bucket of
    at most ``block`` rows is one block. In a larger one, who lies in it is
    dealt into blocks, and so is who looks; each meets all blocks of the
    other side."""
    bucket = ["label", "size", "place", "code"]
    large = _hashed(vectors, hashing, False).groupBy(*bucket).agg(
        F.count_if(F.col("role") == 2).alias("inside"), F.count("*").alias("all")
    ).filter(F.col("all") > block)
    large = written(large, "buckets")
    rows = _hashed(vectors, hashing, True).join(large, bucket, "left").filter("inside is null or inside > 0")
    inside, outside = F.ceil(F.col("inside") / block).cast("int"), F.ceil(F.col("all") / block).cast("int")
    dealt = F.xxhash64("h2", "h1")

    def meets(role: int, own, others):
        mine = F.pmod(dealt, own).cast("int")
        return F.transform(
            F.sequence(F.lit(0), others - 1),
            lambda x: F.struct(*[c.alias(n) for c, n in zip((mine, x) if role == 0 else (x, mine), ("lies", "looks"))], F.lit(role).alias("as")),
        )

    one = F.array(F.struct(F.lit(0).alias("lies"), F.lit(0).alias("looks"), F.col("role").alias("as")))
    looking = meets(1, outside, inside)
    places = F.when(F.col("all").isNull(), one).when(
        F.col("role") == 2, F.concat(meets(0, inside, outside), looking)
    ).otherwise(looking)
    # in a bucket of one block only those that look and lie, and those that look, differ
    return rows.withColumn("meet", F.explode(places)).select(
        *bucket, "meet.lies", "meet.looks", "h1", "h2", "copies", F.col("meet.as").alias("role"), "vector"
    )


# -- the operator -----------------------------------------------------------------


def near_vectors(
    vectors: DataFrame, similar: float = SIMILAR, probes: int = PROBES, recall: float = RECALL, block: int = BLOCK,
    vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
) -> DataFrame:
    """``(vec_id, label, n_links, component_id, kept)`` of every row.

    Vectors of one label and length are linked if their cosine in double
    precision is ``similar`` or more; links are looked for in buckets that find
    a pair at the threshold with a chance of ``recall`` and closer pairs more
    often. ``n_links`` counts the other rows a row is linked with, copies
    included, ``component_id`` is the smallest id reachable by links and
    ``kept`` tells whether that is the row's own.

    A null label links with nothing, nor does a vector that is null, empty or
    zero or has null or non-finite entries. Rows with the same vector, also
    those with the same id, are linked rows like others. Null ids are passed
    over in ``component_id``, which is null where nothing else is linked; such
    a row is kept if it is alone. An empty table gives an empty result; other
    columns are not looked at.
    """
    import numpy as np  # noqa: F401  (needed where tasks run; missing here it fails early)

    own = boxed(vectors.select(F.col(vec_id).alias("id"), F.col(label).cast("int").alias("label"), F.col(vector).alias("vector")))
    body = F.col("row.vector")
    good = F.col("row.label").isNotNull() & usable(body)
    good = good & F.coalesce(F.exists(body, lambda c: c != 0), F.lit(False))
    plain = F.transform(body, lambda c: F.when(c == 0, F.lit(0)).otherwise(c).cast(vectors.schema[vector].dataType.elementType))
    keyed = own.withColumn("h1", F.when(good, F.xxhash64(plain, "row.label"))).withColumn(
        "h2", F.when(good, F.xxhash64(F.lit(1), plain, "row.label"))
    )
    copies = keyed.filter("h1 is not null").groupBy("h1", "h2").agg(
        F.min("row.id").alias("least"), F.count("*").alias("copies"),
        F.any_value("row.label").alias("label"), F.any_value("row.vector").alias("vector"),
    ).withColumn("size", F.size("vector"))
    copies = written(copies, "vectors")
    shape = copies.groupBy("label", "size").count().agg(F.max("count").alias("largest"), F.max("size").alias("size")).first()
    if shape.largest is None:
        linked = copies.select("h1", "h2", F.lit(0).cast("long").alias("links"), "h1", "h2").toDF("h1", "h2", "links", "r1", "r2")
    else:
        hashing = plan_hashing(shape.largest, shape.size, similar, probes, recall)
        blocks = _blocks(copies, hashing, block)
        bucket = [part.split()[0] for part in KEY.split(", ")]
        linked = _compared(blocks.repartition(*bucket).sortWithinPartitions(*bucket), similar, hashing)
    linked = written(linked, "links")
    roots = components(
        linked.select(F.struct("h1", "h2").alias("a"), F.struct(F.col("r1").alias("h1"), F.col("r2").alias("h2")).alias("b"))
    )
    links = linked.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    found = copies.join(links, ["h1", "h2"], "left").join(
        roots.select("node.h1", "node.h2", "root"), ["h1", "h2"], "left"
    ).withColumn("root", F.coalesce("root", F.struct("h1", "h2")))
    least = found.filter("links is not null").groupBy("root").agg(F.min("least").alias("first"))
    linking = found.filter("links is not null or copies > 1").join(least, "root", "left").select(
        F.col("h1").alias("a"), F.col("h2").alias("b"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("first", "least").alias("first"),
    )
    # many rows may share one vector: a hot key, which the skew join splits
    done = keyed.join(linking, (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left")
    component = F.when(F.col("a").isNull(), F.col("row.id")).otherwise(F.col("first"))
    return done.select(
        F.col("row.id").alias("vec_id"), F.col("row.label").alias("label"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("row.id").eqNullSafe(component).alias("kept"),
    )
