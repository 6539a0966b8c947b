"""Embedding whitening by spectrum slicing.

Entries become whole numbers of a grid, so counts, sums and the centred
products are exact integers and no result depends on how rows are dealt out.
What leaves the tasks is one matrix of the embedding's dimension (which does
not grow with the rows): the covariance. Its leading eigenvalues are isolated
by inertia counts: the LDLᵀ factors of V - sI have as many positive pivots as V
has eigenvalues above s. Rayleigh quotient iteration converges inside an
isolated interval, and two more counts beside the result certify its number.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.llm.vectors import matrix, usable

SCALE = 1024
SHIFT = 100_000
LARGEST = 2**40  # grid values beyond have no room for exact products of a batch


class Fit(NamedTuple):
    """n vectors, per-dimension sums and covariance of the grid values."""

    n: int
    sums: list[int]
    covariance: object  # numpy, float64: each entry rounded once


class Basis(NamedTuple):
    values: object  # eigenvalues, falling
    vectors: object  # one unit column for each


# -- exact sums in tasks ------------------------------------------------------


def _grid(vectors):
    import numpy as np

    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def _exact_product(left, right):
    """leftᵀ right of integer matrices, exactly: in float64 while every sum is
    below 2**53, in whole numbers of any size otherwise."""
    import numpy as np

    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * len(left)
    if most < 2**53:
        return (left.T.astype(np.float64) @ right.astype(np.float64)).astype(np.int64).astype(object)
    return left.T.astype(object) @ right.astype(object)


def _entries(vectors: DataFrame, centre: list[int] | None) -> DataFrame:
    """``(i, j, v)``: sums over all rows. Without a centre the sums of grid
    values (i is -1); with one the sums of y and of y yᵀ, y being the
    grid value less the centre. Each task gives one matrix."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from decimal import Decimal

        total, products = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _grid(matrix(batch.column(0)))
            if centre is not None:
                x = x - np.array(centre, np.int64)
                products = products + _exact_product(x, x)
            total = total + _exact_product(np.ones((len(x), 1), np.int64), x)[0]
        if isinstance(total, int):
            return
        rows = [(-1, total)] + ([] if centre is None else list(enumerate(products)))
        kind = pa.list_(pa.decimal128(38, 0))
        for i, row in rows:
            values = pa.array([[Decimal(int(v)) for v in row]], kind)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), values], ["i", "sums"])

    parts = vectors.select("vector").mapInArrow(run, "i int, sums array<decimal(38,0)>")
    return parts.select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))


def _shaped(vectors: DataFrame, vector: str) -> tuple[DataFrame, int, int]:
    """The rows that count, their number and dimension."""
    on_grid = F.forall(F.col(vector), lambda c: F.abs(SCALE * c.cast("double")) < LARGEST)
    good = vectors.filter(usable(F.col(vector)) & F.coalesce(on_grid, F.lit(False)))
    lengths = good.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    most = lengths.first()
    if most is None:
        return good, 0, 0
    return good.filter(F.size(vector) == most["size"]), most["count"], most["size"]


def _fit(rows: DataFrame, n: int, dimension: int) -> Fit:
    import numpy as np

    sums = [0] * dimension
    for row in _entries(rows, None).collect():
        sums[row.j] = int(row.v)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest, products = [0] * dimension, np.zeros((dimension, dimension), object)
    for row in _entries(rows, centre).collect():  # dimension x dimension
        if row.i < 0:
            rest[row.j] = int(row.v)
        else:
            products[row.i, row.j] = int(row.v)
    covariance = np.array(
        [[(n * int(products[i, j]) - rest[i] * rest[j]) / n**2 for j in range(dimension)] for i in range(dimension)], float
    )
    return Fit(n, sums, covariance)


# -- eigenvalues by slicing -----------------------------------------------------


def eigenvalues_above(matrix, shift: float) -> int:
    """Positive pivots of LDLᵀ of ``matrix`` - shift I, symmetrically pivoted
    with blocks of one and two; a block of two has one of each sign."""
    import numpy as np

    a = matrix - shift * np.eye(len(matrix))
    n, at, positive = len(a), 0, 0
    bound = (1 + math.sqrt(17)) / 8
    while at < n:
        size, pivot = 1, at
        own = abs(a[at, at])
        column = np.abs(a[at + 1 :, at])
        most = column.max(initial=0.0)
        if max(own, most) == 0:
            at += 1
            continue
        if own < bound * most:
            other = at + 1 + int(column.argmax())
            row = np.abs(a[other, at:])
            row[other - at] = 0
            if own * row.max() < bound * most**2:
                pivot = other
                size = 1 if abs(a[other, other]) >= bound * row.max() else 2
        moved = at + size - 1
        if pivot != moved:
            a[[moved, pivot]] = a[[pivot, moved]]
            a[:, [moved, pivot]] = a[:, [pivot, moved]]
        below = a[at + size :, at : at + size].copy()
        block = a[at : at + size, at : at + size].copy()
        positive += int(block[0, 0] > 0) if size == 1 else 1
        a[at + size :, at + size :] -= below @ np.linalg.solve(block, below.T)
        at += size
    return positive


def leading(matrix, most: int) -> Basis:
    """The ``most`` largest eigenvalues that are above rounding, with unit
    vectors. Equal eigenvalues get orthogonal vectors of their space."""
    import numpy as np

    n = len(matrix)
    size = float(np.abs(matrix).sum(1).max(initial=0.0))
    rounding = 8 * n * np.finfo(float).eps * size
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = eigenvalues_above(matrix, shift)
        return counts[shift]

    values, vectors = [], np.zeros((n, 0))
    for number in range(1, min(most, above(rounding) if size else 0) + 1):
        low = max((s for s, c in counts.items() if c >= number), default=rounding)
        high = min((s for s, c in counts.items() if c < number and s > low), default=size * (1 + 1e-9) + rounding)

        def halved(low: float, high: float) -> tuple[float, float]:
            middle = (low + high) / 2
            return (middle, high) if above(middle) >= number else (low, middle)

        while high - low > rounding and not (above(low) == number and above(high) == number - 1):
            low, high = halved(low, high)
        while True:
            value, vector = _rayleigh(matrix, (low + high) / 2, vectors, number)
            if low < value < high or high - low <= rounding:
                break
            low, high = halved(low, high)  # it left the interval: a narrower one is nearer
        if not above(value + rounding) < number <= above(value - rounding):
            raise ArithmeticError(f"eigenvalue {number} is not certified by its inertia counts")
        values.append(value)
        vectors = np.column_stack([vectors, vector * np.sign(vector[np.abs(vector).argmax()])])
    return Basis(np.array(values), vectors)


def _rayleigh(matrix, start: float, known, seed: int) -> tuple[float, object]:
    """Eigenvalue and vector near ``start``, orthogonal to the known ones:
    inverse iteration to begin with, then with the Rayleigh quotient as shift."""
    import numpy as np

    n = len(matrix)
    eye = np.eye(n)
    vector = np.random.default_rng(seed).standard_normal(n)
    shift, least, best = start, math.inf, (start, vector)
    for step in range(30):
        try:
            vector = np.linalg.solve(matrix - shift * eye, vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last digit
            vector = np.linalg.solve(matrix - (shift + np.spacing(shift) * 4) * eye, vector)
        vector /= np.abs(vector).max()
        for _ in range(2):
            vector = vector - known @ (known.T @ vector)
        vector /= np.linalg.norm(vector)
        image = matrix @ vector
        value = float(vector @ image)
        residual = float(np.linalg.norm(image - value * vector))
        if residual < least:
            least, best = residual, (value, vector)
        elif step > 3:
            break
        shift = value if step >= 2 else start
    return best


# -- the operator ---------------------------------------------------------------


def whiten(
    vectors: DataFrame, components: int = 8, vector: str = "embedding", vec_id: str = "vec_id"
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)``, one row for each vector that counts and each component.

    An entry c counts as floor(1024 c) + 100000. ``whitened`` is the centred
    vector on the component over the root of its eigenvalue, ``explained`` the
    eigenvalue's share of the trace, ``deviation`` the sum of (n x - S)² over
    the dimensions as decimal(38,0), exact, null where it has more digits;
    ``identity_error`` is measured on the whitened rows in a pass of its own.

    Rows with a null or empty vector, null or non-finite entries, entries whose
    grid value is 2**40 or more, or another length than the most common one
    (ties: the longest) are dropped; repeated rows and null ids count as rows.
    A component without variance has no whitened value: there are at most as
    many as the covariance has eigenvalues above rounding, none for equal
    vectors. An empty table gives an empty result; other columns are not
    looked at. The driver holds matrices of dimension x dimension only.
    """
    import numpy as np

    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    id_type = source.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    rows, n, dimension = _shaped(source, "vector")
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    fit = _fit(rows, n, dimension)
    basis = leading(fit.covariance, components)
    k = len(basis.values)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    weights = basis.vectors / np.sqrt(basis.values)
    whole = np.array([s // n for s in fit.sums], np.int64)
    rest = np.array([(s % n) / n for s in fit.sums])
    explained = basis.values / np.trace(fit.covariance)

    def whitened(x):
        return ((x - whole).astype(np.float64) - rest) @ weights  # x - S/n, centred in whole numbers first

    def moments(batches):
        import pyarrow as pa

        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                z = whitened(_grid(matrix(batch.column(0))))
                first, second = first + z.sum(0), second + z.T @ z
        i, j = np.meshgrid(range(-1, k), range(k), indexing="ij")
        values = np.vstack([first, second])
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(values.ravel())], ["i", "j", "v"]
        )

    measured = rows.select("vector").mapInArrow(moments, "i int, j int, v double")
    means, second = np.zeros(k), np.zeros((k, k))
    for row in measured.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if row.i < 0:
            means[row.j] = row.v / n
        else:
            second[row.i, row.j] = row.v / n
    error = float(np.abs(second - np.outer(means, means) - np.eye(k)).max())
    sums = fit.sums
    largest = 10**38

    def deviations(x):
        part = [n * int(w) - s for w, s in zip(whole, sums)]  # n x - S = n (x - whole) + part
        far = int(np.abs(x - whole).max()) + 1
        if (n * far) ** 2 * dimension < 2**62:
            deviation = n * (x - whole) + np.array(part, np.int64)
            return [int(v) for v in (deviation * deviation).sum(1)]
        deviation = n * (x - whole).astype(object) + np.array(part, object)
        return [int(v) for v in (deviation * deviation).sum(1)]

    def rows_of(batches):
        import pyarrow as pa
        from decimal import Decimal

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _grid(matrix(batch.column(1)))
            size = len(x) * k
            far = pa.array([Decimal(d) if d < largest else None for d in deviations(x)], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, n, np.int64)), far.take(each), pa.array(whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", "vector").mapInArrow(rows_of, schema)
