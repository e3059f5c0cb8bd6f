"""Clustering by centroids; each vector finds its nearest one in a vantage-point tree.

Vectors become integers, so distances, ties and means are exact.  Each round builds a
tree over the centroids, few as they are, and broadcasts it.  An inner node holds one of
them, its vantage point, and how near and how far the others below each of its two
children lie from it; a leaf holds up to ``LEAF``.  A vector opens nodes in order of their
lower bound, by the triangle inequality, and stops at the first bound beyond the best
distance found.  A bound equal to it is still opened, as a centroid with a smaller number
may lie there.  Bounds are real numbers with an allowance for rounding; distances at
vantage points and leaves are integers.

A round sends one row for each batch of vectors and centroid, its count and sums; only the
sums of each centroid come to the driver.  All vectors of a batch search side by side, each
with its own order of nodes.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, column, free_name, ship

#: Centroids in a leaf.
LEAF = 4
#: Bytes of centroids at most: they are sent to every executor.
MOST_BYTES = 64 << 20
#: Vectors that search side by side, and cells of their table of bounds.
TOGETHER, CELLS = 4096, 1 << 21
#: Allowance for the rounding of square roots, some thousand times what is needed.
SLACK = 1e-12


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return (apart * apart).sum(axis=-1)


def plant(points: np.ndarray) -> dict:
    """The tree over the rows of ``points``, as arrays by node; node 0 is the root."""
    vantage, children, reach, members = [], [], [], []

    def add(left: np.ndarray) -> int:
        node = len(vantage)
        vantage.append(-1)
        children.append((-1, -1))
        reach.append((0.0, 0.0, 0.0, 0.0))
        members.append([*left, *[-1] * (LEAF - len(left))] if len(left) <= LEAF else [-1] * LEAF)
        if len(left) > LEAF:
            top = left[_squares(points[left], points[left[0]]).argmax()]
            rest = left[left != top]
            away = np.sqrt(_squares(points[rest], points[top]).astype(np.float64))
            order = np.lexsort((rest, away))
            half = len(rest) // 2
            rest, away = rest[order], away[order]
            vantage[node] = top
            reach[node] = (away[0], away[half - 1], away[half], away[-1])
            children[node] = (add(rest[:half]), add(rest[half:]))
        return node

    add(np.arange(len(points)))
    return {
        "points": points,
        "vantage": np.array(vantage),
        "children": np.array(children),
        "reach": np.array(reach),
        "members": np.array(members),
    }


def search(tree: dict, vectors: np.ndarray):
    """Of each vector the nearest centroid, its squared distance, and how many distances were taken."""
    points, members = tree["points"], tree["members"]
    n, nodes = len(vectors), len(tree["vantage"])
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, len(points))
    taken = np.zeros(n, dtype=np.int64)

    def judge(rows, which):
        """Compares rows with one centroid each; ties go to the smaller number."""
        d = _squares(vectors[rows], points[which])
        taken[rows] += 1
        better = (d < best[rows]) | ((d == best[rows]) & (which < number[rows]))
        best[rows[better]], number[rows[better]] = d[better], which[better]
        return d

    step = max(1, min(TOGETHER, CELLS // nodes))
    for start in range(0, n, step):
        live = np.arange(start, min(n, start + step))
        bounds = np.full((len(live), nodes), np.inf)
        bounds[:, 0] = 0
        while len(live):
            node = bounds[live - start].argmin(axis=1)
            low = bounds[live - start, node]
            bounds[live - start, node] = np.inf
            # inclusive: at an equal bound a smaller number may wait
            on = (low <= np.sqrt(best[live].astype(np.float64)) * (1 + SLACK)) & (low < np.inf)
            live, node, low = live[on], node[on], low[on]
            inner = tree["vantage"][node] >= 0
            rows, at = live[inner], node[inner]
            if len(rows):
                away = np.sqrt(judge(rows, tree["vantage"][at]).astype(np.float64))
                near = tree["reach"][at]
                for side in (0, 1):
                    gap = np.maximum(away - near[:, 2 * side + 1], near[:, 2 * side] - away)
                    gap -= SLACK * (away + near[:, 2 * side + 1])
                    bounds[rows - start, tree["children"][at, side]] = np.maximum(low[inner], gap)
            rows, at = live[~inner], node[~inner]
            for place in range(LEAF if len(rows) else 0):
                which = members[at, place]
                judge(rows[which >= 0], which[which >= 0])
    return number, best, taken


def most(dim: int) -> int:
    """Integers below this in size have squared distances that a long can hold."""
    return 1 << (30 - ((max(dim, 1) - 1).bit_length() + 1) // 2)


def usable(vector, dim: int, scale: int):
    """Of this dimension, all components finite, and small enough as integers."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < most(dim) / scale)
    return F.coalesce((F.size(vector) == dim) & F.forall(vector, fits), F.lit(False))


def _read(array, dim: int) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(held, dim: int):
    """Count and sums of each centroid's vectors, for every batch."""

    def run(batches):
        import pyarrow as pa

        tree = held.value
        for batch in batches:
            vectors = _read(batch.column(0), dim)
            number, _, taken = search(tree, vectors)
            order = np.argsort(number, kind="stable")
            found, first = np.unique(number[order], return_index=True)
            sums = np.add.reduceat(vectors[order], first, axis=0) if len(found) else np.zeros((0, dim), np.int64)
            counts = np.diff(np.append(first, len(number)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * dim, pa.int32()), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts.astype(np.int64)), lists], names=["cluster", "n", "sums"])

    return run


def _nearest(held, dim: int):
    @F.arrow_udf("struct<cluster: int, distance: long>")
    def run(vectors):
        import pyarrow as pa

        number, best, _ = search(held.value, _read(vectors, dim))
        return pa.StructArray.from_arrays([pa.array(number.astype(np.int32)), pa.array(best)], names=["cluster", "distance"])

    return run


def clustered(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, id: str = "vec_id", vector: str = "embedding", salt: str = "2"
) -> DataFrame:
    """All columns of the vectors kept, and ``cluster, distance, cluster_inertia, inertia, centroid``.

    A component x becomes floor(scale * x).  Centroids start as the ``k`` vectors whose
    ``<salt>:<id>`` has the least SHA-256; a round assigns every vector to the nearest one and
    replaces each that has any by floor(sum / count); after the last round vectors are assigned
    once more.  ``distance`` is squared; the two sums are over its cluster and over all;
    ``centroid`` is an array.

    Kept are rows of exactly ``dim`` components, none null, NaN or infinite.  A component that
    is no smaller than ``most(dim)`` once it is an integer (2^19 = 524,288 before that, with 64
    components and a scale of 256) has no squared distance in a long: its row is left out too.
    Rows that repeat an id or a vector count each; of equal hashes the smaller vector starts
    first, a null id after all others.  With fewer than ``k`` rows each is a centroid; without
    any the result is empty.  A sum beyond a long is null.  Names that are taken get a leading
    underscore.
    """
    if k * dim * 8 > MOST_BYTES:
        raise ValueError(f"{k} centroids of {dim} components are more than {MOST_BYTES} bytes to broadcast")
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    whole = free_name(vectors, "integers")
    kept = vectors.where(usable(column(vector), dim, scale))
    kept = scratch.table(kept.withColumn(whole, F.transform(column(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))))
    order = F.sha2(F.concat(F.lit(f"{salt}:"), column(id).cast("string")), 256)
    starts = kept.select(order.alias("h"), F.col(whole).alias("v")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    points = np.array([r["v"] for r in starts], dtype=np.int64).reshape(-1, dim)

    schema = "cluster int, n long, sums array<long>"
    total = lambda d: F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}")
    for _ in range(rounds if len(points) else 0):
        held = spark.sparkContext.broadcast(plant(points))
        sums = kept.select(F.col(whole)).mapInArrow(_sums(held, dim), schema)
        found = sums.groupBy("cluster").agg(F.sum("n").alias("n"), *map(total, range(dim))).collect()
        points = points.copy()
        for row in found:
            points[row["cluster"]] = [int(s) // row["n"] for s in row[2:]]
        held.destroy()

    names = {c: free_name(vectors, c) for c in ("cluster", "distance", "cluster_inertia", "inertia", "centroid")}
    held = spark.sparkContext.broadcast(plant(points))
    found = _nearest(held, dim)(F.col(whole)).alias(whole)
    own = [column(c) for c in vectors.columns]
    near = scratch.table(kept.select(*own, found).select(*own, *[F.col(whole)[c].alias(names[c]) for c in ("cluster", "distance")]))
    held.destroy()
    spent = near.groupBy(F.col(names["cluster"]).alias("c")).agg(F.sum(F.col(names["distance"]).cast("decimal(38,0)")).alias("s")).collect()
    spent = {r["c"]: int(r["s"]) for r in spent}
    long = lambda s: s if s < 1 << 63 else None
    rows = [(c, long(spent.get(c, 0)), long(sum(spent.values())), points[c].tolist()) for c in range(len(points))]
    key = free_name(near, "of")
    told = spark.createDataFrame(rows, f"`{key}` int, `{names['cluster_inertia']}` long, `{names['inertia']}` long, `{names['centroid']}` array<long>")
    # one row for each centroid, whose bytes are bounded above
    return near.join(F.broadcast(told), F.col(names["cluster"]) == F.col(key), "left").drop(key)


def digest(centroid: Column) -> Column:
    """SHA-256 of a centroid's components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
