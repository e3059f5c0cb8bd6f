"""Whitening of embeddings; the components come from contour integration.

The covariance of all vectors is summed by Spark, batch by batch, centred before it is
multiplied; it has one number for each pair of dimensions, so it fits the driver whatever
the number of rows.  Its leading eigenvectors are found there:

1. Inertia counts say how many eigenvalues lie above a shift: the signs of the pivots of
   the symmetric factorization of the shifted covariance.  Bisection on them finds the
   interval that holds the wanted ones, and a shift on either side of it.
2. A quadrature of (z - V)^-1 Y along the ellipse around the interval projects a block of
   vectors onto the eigenvectors inside it: one solve with a complex shift for each node.
3. Rayleigh-Ritz on the projected block gives eigenpairs.  The block is projected again
   until those inside the interval have no residual but rounding.
4. There must be as many of them as the inertia counts say; a missed one widens the block.

Vectors are then projected and scaled, exact integers being centred before rounding.
"""

from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, column, free_name, ship

#: Nodes of the quadrature on the upper half of the ellipse; the lower half is its mirror image.
NODES = 16
#: The ellipse's height against its width.
FLAT = 0.5
#: Largest dimension: the driver holds some arrays of its square, complex ones for each node.
MOST_DIM = 1024
#: Integers up to here are exact in arithmetic on longs with room for a sum of products.
EXACT = 1 << 62


def inertia(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive, by factorization.

    Pivots are the largest entry of the diagonal, or a block of two rows where an entry
    beside the diagonal is much larger; such a block has one eigenvalue of each sign.
    """
    a, positive = matrix.astype(np.float64).copy(), 0
    while len(a):
        n = len(a)
        single = int(np.abs(np.diag(a)).argmax())
        beside = np.abs(a - np.diag(np.diag(a)))
        p, q = divmod(int(beside.argmax()), n)
        # fixed value: (1 + sqrt 17) / 8 bounds the growth of entries equally for both kinds
        if abs(a[single, single]) >= (1 + 17**0.5) / 8 * beside[p, q]:
            pivot = a[single, single]
            if pivot == 0:  # nothing but zeros is left
                return positive
            positive += int(pivot > 0)
            rest = np.arange(n) != single
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, single], a[rest, single]) / pivot
        else:
            positive += 1
            rest = ~np.isin(np.arange(n), (p, q))
            side = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_([p, q], [p, q])], side.T)
    return positive


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``."""
    return inertia(matrix - shift * np.eye(len(matrix)))


def interval(matrix: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """An interval that holds at least the ``wanted`` largest eigenvalues, and how many it holds.

    It holds more only where eigenvalues are too close to tell apart.  Its lower end lies
    near the middle of the gap below.
    """
    high = np.abs(matrix).sum(axis=1).max() * (1 + 1e-12) + 1e-300  # no eigenvalue is larger (Gershgorin)
    below, beyond = -high, high  # too many, and too few, lie above these
    grain = 4 * np.finfo(float).eps * len(matrix) * high
    while beyond - below > grain:
        shift = (below + beyond) / 2
        count = above(matrix, shift)
        if count == wanted:
            break
        below, beyond = (shift, beyond) if count > wanted else (below, shift)
    else:
        return below, high, above(matrix, below)
    ends = []
    for bad in (below, beyond):
        good = shift
        for _ in range(6):
            middle = (good + bad) / 2
            good, bad = (middle, bad) if above(matrix, middle) == wanted else (good, middle)
        ends.append(good)
    return sum(ends) / 2, high, wanted


def feast(matrix: np.ndarray, low: float, high: float, count: int, rounds: int = 200):
    """The ``count`` eigenpairs in the interval, by falling eigenvalue; vectors are columns."""
    dim = len(matrix)
    centre, half = (low + high) / 2, (high - low) / 2
    angles = (np.arange(NODES) + 0.5) * np.pi / NODES
    at = centre + half * (np.cos(angles) + 1j * FLAT * np.sin(angles))
    weights = half * (FLAT * np.cos(angles) + 1j * np.sin(angles)) / NODES
    shifted = at[:, None, None] * np.eye(dim) - matrix
    scale = np.abs(matrix).sum(axis=1).max()
    width, r = min(dim, 2 * count + 8), np.random.default_rng(dim)
    block = np.linalg.qr(r.standard_normal((dim, width)))[0]
    best = None
    for step in range(rounds):
        solved = np.linalg.solve(shifted, np.broadcast_to(block.astype(complex), (NODES, dim, width)))
        block = np.linalg.qr((weights[:, None, None] * solved).sum(axis=0).real)[0]
        values, turn = np.linalg.eigh(block.T @ matrix @ block)
        block = block @ turn
        inside = np.flatnonzero((values > low) & (values <= high))[::-1]
        residual = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0)
        if len(inside) == count:
            if best is None or residual < best[0]:
                best = residual, values[inside], block[:, inside], step
            # one more round than the residual needs, and no more once it stops falling
            if residual <= 1e-14 * scale or (residual <= 1e-11 * scale and step > best[3] + 1):
                return best[1], best[2]
        elif step % 20 == 19 and width < dim:  # some are missed: a wider block
            width = min(dim, 2 * width)
            block = np.linalg.qr(np.concatenate((block, r.standard_normal((dim, width - block.shape[1]))), axis=1))[0]
    if best is None or best[0] > 1e-10 * scale:
        raise ArithmeticError(f"{count} eigenvalues in ({low}, {high}] were not found in {rounds} rounds")
    return best[1], best[2]


def components(matrix: np.ndarray, wanted: int):
    """The largest eigenvalues that are positive beyond rounding, at most ``wanted``, and their vectors."""
    dim = len(matrix)
    trace = float(np.trace(matrix))
    if not trace > 0:
        return np.zeros(0), np.zeros((dim, 0))
    unit = matrix / trace
    least = dim * np.finfo(float).eps
    wanted = min(wanted, above(unit, least))
    values, vectors = feast(unit, *interval(unit, wanted))
    return values[:wanted] * trace, vectors[:, :wanted]


def _read(array, dim: int) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _totals(dim: int):
    """Of each partition the number of rows and the exact sums of their components."""

    def run(batches):
        import pyarrow as pa

        n, sums = 0, np.zeros(dim, dtype=object)
        for batch in batches:
            x = _read(batch.column(0), dim)
            n += len(x)
            # halves of 26 bits: their sums stay within a long
            sums += ((x >> 26).sum(axis=0).astype(object) << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)
        if n:
            at, count = pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n))
            yield pa.RecordBatch.from_arrays([at, count, pa.array(list(map(Decimal, sums)), pa.decimal128(38, 0))], names=["at", "n", "s"])

    return run


def _apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S as whole numbers: longs where they fit, else Python's."""
    most = max(int(np.abs(x).max(initial=0)), max(map(abs, sums), default=0) // max(n, 1) + 1)
    if 2 * n * most < EXACT:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _products(n: int, sums: list[int]):
    """For each batch the sums of the products of its centred components."""
    dim = len(sums)

    def run(batches):
        import pyarrow as pa

        total = np.zeros((dim, dim))
        for batch in batches:
            centred = _apart(_read(batch.column(0), dim), n, sums).astype(np.float64) / n
            total += centred.T @ centred
        some = np.triu_indices(dim)
        at = (some[0] * dim + some[1]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[some])], names=["at", "s"])

    return run


def _whitened(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
    @F.arrow_udf("struct<deviation: long, whitened: array<double>>")
    def run(x):
        import pyarrow as pa

        apart = _apart(_read(x, len(sums)), n, sums)
        most = int(np.abs(apart).max(initial=0))
        wide = apart if most * most * len(sums) < EXACT else apart.astype(object)
        square = (wide * wide).sum(axis=1)
        square = pa.array([s if s < 1 << 63 else None for s in square.tolist()], pa.int64())
        scores = (apart.astype(np.float64) / n) @ vectors / np.sqrt(values)
        ends = pa.array(np.arange(len(scores) + 1) * len(values), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(scores.ravel()))
        return pa.StructArray.from_arrays([square, lists], names=["deviation", "whitened"])

    return run


def whitened(vectors: DataFrame, k: int = 8, scale: int = 1024, offset: int = 100_000, vector: str = "embedding"):
    """``(table, components)``: the rows kept with what whitening gives, and a row for each component.

    The table has all columns and ``deviation`` (the sum over dimensions of (n * x - S)^2, null
    beyond a long) and ``whitened`` (an array, a number for each component); ``components`` has
    ``component`` from 1, ``n``, ``eigenvalue``, ``explained``, ``identity_error`` and ``axis``.
    An entry c becomes x = floor(scale * c) + offset; S are the sums of x over the n rows kept.

    Left out are vectors that are null or empty, hold null, NaN or infinite entries, have an
    entry whose x is not below 2^52 in size (beyond it a double has no unit digit), or whose
    dimension is not the most frequent one (the smaller of two as frequent).  Rows that repeat
    count each.  Only directions with a variance above rounding are components, so there are
    fewer than ``k`` in few dimensions and none if all rows are equal; without rows both are
    empty.  Eigenvectors of equal eigenvalues are any basis of theirs.  Names that are taken
    get a leading underscore.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    x = free_name(vectors, "integers")
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float((1 << 52) - offset) / scale)
    kept = vectors.where(F.coalesce((F.size(column(vector)) > 0) & F.forall(column(vector), fits), F.lit(False)))
    sizes = kept.groupBy(F.size(column(vector)).alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = sizes["dim"] if sizes else 1
    if dim > MOST_DIM:
        raise ValueError(f"{dim} dimensions; their covariance is held on the driver for {MOST_DIM} at most")
    whole = F.transform(column(vector), lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(offset).cast("long"))
    kept = scratch.table(kept.where(F.size(column(vector)) == dim).withColumn(x, whole))

    # one row for each dimension, and for each pair of them: bounded by MOST_DIM
    parts = kept.select(F.col(x)).mapInArrow(_totals(dim), "at int, n long, s decimal(38,0)")
    sums = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    n = sums[0]["n"] if sums else 0
    sums = [int(r["s"]) for r in sorted(sums, key=lambda r: r["at"])]
    matrix = np.zeros((dim, dim))
    if n:
        parts = kept.select(F.col(x)).mapInArrow(_products(n, sums), "at int, s double")
        for row in parts.groupBy("at").agg(F.sum("s").alias("s")).collect():
            i, j = divmod(row["at"], dim)
            matrix[i, j] = matrix[j, i] = row["s"] / n
    values, axes = components(matrix, k)

    names = [free_name(vectors, c) for c in ("deviation", "whitened")]
    own = [column(c) for c in vectors.columns]
    made = kept.select(*own, _whitened(n, sums or [0], values, axes)(F.col(x)).alias(x))
    made = scratch.table(made.select(*own, *[F.col(x)[c].alias(name) for c, name in zip(("deviation", "whitened"), names)]))
    error = _identity_error(made, names[1], len(values)) if n else 0.0
    rows = [(c + 1, n, float(e), float(e / np.trace(matrix)), error, axes[:, c].tolist()) for c, e in enumerate(values)]
    schema = "component int, n long, eigenvalue double, explained double, identity_error double, axis array<double>"
    return made, spark.createDataFrame(rows, schema)


def _identity_error(table: DataFrame, name: str, count: int) -> float:
    """The largest absolute entry of the covariance of the array column less the identity."""
    if not count:
        return 0.0
    one = [F.col(name)[c] for c in range(count)]
    means = table.agg(*[F.avg(c) for c in one]).first()
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = table.agg(*[F.avg((one[i] - F.lit(means[i])) * (one[j] - F.lit(means[j]))) for i, j in pairs]).first()
    return float(max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs)))
