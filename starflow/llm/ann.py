"""Nearest neighbours by randomly rotated one-bit codes.

A vector less the mean is rotated at random, as often as it takes to fill ``BITS`` bits,
and each coordinate keeps its sign.  With the packed bits go two numbers: the vector's length
and the inner product of its direction with its code.  From these the inner product with a
rotated query is estimated without bias, and its error bounded: it exceeds ``EPSILON``
standard units with a probability that falls like a Gaussian tail.

Codes are made once, in a written table.  A query adds up, byte by byte of the codes, what
each byte is worth to it; the k likeliest rows are measured first, and then all rows whose
lower bound is not above the k-th distance so found.  Distances are exact, in double precision,
on the original vectors; ``reranked`` tells how many rows a query measured.

Rows and queries are dealt into blocks of bounded size and every block of rows meets
every block of queries; each pair of blocks gives at most k rows for a query, of which a
window keeps the best.  The vectors go with the codes: a query measures some rows of nearly
every block, so bringing each of them its vector later would move more.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, column, ship

EPSILON = 3.5
#: Bits of a code, at least one for each dimension: the error falls with their root.
BITS = 1024
#: Vectors that the mean is taken of, by a hash of their id; every row is indexed.
MOST_SAMPLED = 10_000
ROW_BLOCK, QUERY_BLOCK = 1 << 14, 1 << 11


#: The signs that each value of a byte stands for.
SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64).T * 2 - 1


def rotation(dim: int) -> np.ndarray:
    """Random orthogonal matrices side by side, the same for each dimension everywhere."""
    random, made = np.random.default_rng(dim), []
    for _ in range(max(1, BITS // dim)):
        q, r = np.linalg.qr(random.standard_normal((dim, dim)))
        made.append(q * np.sign(np.diag(r)))
    return np.concatenate(made, axis=1) / np.sqrt(len(made))


def encode(vectors: np.ndarray, mean: np.ndarray):
    """Packed sign bits, lengths, and inner products of directions with their codes."""
    turned = (vectors - mean) @ rotation(vectors.shape[1])
    length = np.linalg.norm(turned, axis=1)
    product = np.abs(turned).sum(axis=1) / (np.where(length > 0, length, 1) * np.sqrt(turned.shape[1]))
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, product, 1.0)


def bounds(bits, length, product, queries: np.ndarray, mean: np.ndarray):
    """Lower and upper bounds on the squared distances, a row for each query."""
    dim, turn = queries.shape[1], rotation(queries.shape[1])
    turned = (queries - mean) @ turn
    own = np.linalg.norm(turned, axis=1)[:, None]
    worth = np.zeros((len(queries), bits.shape[1] * 8))
    worth[:, : turned.shape[1]] = turned / np.sqrt(turned.shape[1])
    inner = np.zeros((len(queries), len(bits)))
    for at, values in enumerate(np.ascontiguousarray(bits.T)):
        inner += (worth[:, at * 8 : at * 8 + 8] @ SIGNS).take(values, axis=1)
    free = max(dim - 1, 1) * (turn.shape[1] // dim)
    error = EPSILON * np.sqrt(np.maximum(0, 1 - product**2) / product**2 / free)
    middle = length**2 + own**2 - 2 * length * inner / product
    # the last term is for what rounding loses
    slack = 2 * length * own * error + 1e-9 * (length**2 + own**2)
    return middle - slack, middle + slack


def distances(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Euclidean distances, also where squares leave the range of a double."""
    with np.errstate(over="ignore", under="ignore"):
        found = np.sqrt(((vectors - one) ** 2).sum(axis=1))
        odd = np.flatnonzero(~((found > 1e-140) & (found < 1e150)))
        if len(odd):
            half = vectors[odd] / 2 - one / 2
            half = np.where((np.abs(half) < 1e-200).all(axis=1)[:, None], (vectors[odd] - one) / 2, half)
            power = np.frexp(np.abs(half).max(axis=1))[1]
            found[odd] = np.ldexp(np.sqrt((np.ldexp(half, -power[:, None]) ** 2).sum(axis=1)), power + 1)
    return found


def _matrix(column) -> np.ndarray:
    import pyarrow as pa

    made = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return made.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _coded(mean: np.ndarray, power: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                bits, length, product = encode(np.ldexp(_matrix(batch["vector"]), -power), mean)
                more = {"bits": pa.array([x.tobytes() for x in bits], pa.binary()), "length": pa.array(length), "product": pa.array(product)}
                yield pa.RecordBatch.from_pydict({"id": batch["id"], "vector": batch["vector"], **more})

    return run


def _nearest(k: int, mean: np.ndarray, power: int):
    def run(_, rows, queries):
        import pyarrow as pa

        out = [[], [], [], []]
        if rows.num_rows and queries.num_rows:
            ids, asked = np.asarray(rows["id"]), np.asarray(queries["id"])
            vectors, wanted = _matrix(rows["vector"]), _matrix(queries["vector"])
            bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            code = bits, np.asarray(rows["length"]), np.asarray(rows["product"])
            for start in range(0, len(wanted), 64):
                part = wanted[start : start + 64]
                low, high = bounds(*code, np.ldexp(part, -power), mean)
                for q, vector in enumerate(part):
                    others = np.flatnonzero(ids != asked[start + q])
                    if not len(others):
                        continue
                    likely = low[q][others] + high[q][others]
                    first = others[np.argpartition(likely, k - 1)[:k]] if len(others) > k else others
                    most = np.ldexp(distances(vectors[first], vector).max(), -power) ** 2
                    near = np.union1d(others[low[q][others] <= most * (1 + 1e-9)], first)
                    score = distances(vectors[near], vector)
                    best = np.lexsort((ids[near], score))[:k]
                    out[0].append(np.full(len(best), asked[start + q]))
                    out[1].append(ids[near][best])
                    out[2].append(score[best])
                    out[3].append(np.where(np.arange(len(best)) == 0, len(near), 0))
        made = [np.concatenate(x) if x else np.zeros(0) for x in out]
        names = ("query_id", "vec_id", "score", "reranked")
        return pa.table({c: x.astype(np.float64 if c == "score" else np.int64) for c, x in zip(names, made)})

    return run


def usable(vector):
    """Neither null nor zero, and all components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score, reranked)``: the k nearest rows of each query but itself.

    The score is the Euclidean distance (infinite only if a double cannot hold it); ties go
    to the smaller id.  ``reranked`` counts the rows that were measured for the query.  Vectors that are
    null, empty, zero or hold null or non-finite components take no part, nor do those
    with a null id or whose dimension is not the table's most frequent one (the smaller
    of two as frequent).  Rows that repeat an id count once.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)

    def read(df):
        some = df.select(column(id).cast("long").alias("id"), column(vector).cast("array<double>").alias("vector"))
        return some.where(F.col("id").isNotNull() & usable(F.col("vector")))

    rows = scratch.table(read(vectors).groupBy("id").agg(F.min("vector").alias("vector")))
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = sizes["dim"] if sizes else 1
    rows = rows.where(F.size("vector") == dim)
    asked = scratch.table(read(queries).where(F.size("vector") == dim).groupBy("id").agg(F.min("vector").alias("vector")))
    counts = [df.count() for df in (rows, asked)]
    row_blocks, query_blocks = (max(1, -(-n // size)) for n, size in zip(counts, (ROW_BLOCK, QUERY_BLOCK)))
    # a power of two brings the largest component to 1: squares stay within a double
    greatest = rows.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 1.0
    power = max(-1000, int(np.frexp(greatest)[1]))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(MOST_SAMPLED)
    sample = sample.select(F.posexplode("vector").alias("at", "x")).groupBy("at")
    sums = sample.agg(F.avg(F.col("x") * F.lit(float(np.ldexp(1.0, -power)))).alias("x")).orderBy("at").collect()
    mean = np.array([r["x"] for r in sums] or [0.0] * dim)
    schema = "id long, vector array<double>, bits binary, length double, product double"
    rows = scratch.table(rows.mapInArrow(_coded(mean, power), schema))

    deal = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("*", deal(row_blocks, 1).alias("r"), every(query_blocks).alias("q"))
    right = asked.select("id", "vector", every(row_blocks).alias("r"), deal(query_blocks, 2).alias("q"))
    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q"))
    found = found.applyInArrow(_nearest(k, mean, power), "query_id long, vec_id long, score double, reranked long")
    one = Window.partitionBy("query_id")
    found = found.withColumn("rank", F.row_number().over(one.orderBy("score", "vec_id"))).withColumn("reranked", F.sum("reranked").over(one))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "reranked")
