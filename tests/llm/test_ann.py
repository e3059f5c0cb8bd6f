import numpy as np
from pyspark.sql import functions as F

from starflow.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows, asked, k=10):
    known = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in rows}
    out = {}
    for q in asked:
        others = [(float(np.sqrt(((known[i] - known[q]) ** 2).sum())), i) for i in known if i != q]
        out[q] = sorted(others)[:k]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert len(out[r.query_id]) == r["rank"]
    return out


def test_recall_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(ann, "ROW_BLOCK", 300)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 20)
    r = np.random.default_rng(1)
    centres = r.standard_normal((20, 48))
    rows = [(k, (centres[k % 20] + 0.3 * r.standard_normal(48)).tolist()) for k in range(2000)]
    df = frame(rows, SCHEMA)
    found = got(ann.nearest(df, df.where("vec_id % 40 = 0")))
    want = brute_force(rows, range(0, 2000, 40))
    hits = sum(len({i for _, i in want[q]} & {i for _, i in found[q]}) for q in want)
    assert hits >= 0.99 * 10 * len(want)
    for q, near in found.items():
        assert np.allclose([s for s, _ in near], [s for s, _ in want[q]], atol=1e-9) or hits < 10 * len(want)


def test_bounds_hold():
    r = np.random.default_rng(2)
    vectors, asked = r.standard_normal((3000, 64)), r.standard_normal((20, 64))
    mean = vectors.mean(axis=0)
    low, high = ann.bounds(*ann.encode(vectors, mean), asked, mean)
    true = ((vectors[None] - asked[:, None]) ** 2).sum(axis=2)
    assert ((low <= true) & (true <= high)).mean() > 0.999


def test_ties_copies_bad_vectors_and_clashing_names(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (5, [0.0, 2.0])]
    bad = [(7, None), (8, [0.0, 0.0]), (9, [nan, 1.0]), (10, [1.0, None]), (11, [inf, 1.0]), (12, [1.0]), (13, []), (None, [1.0, 1.0])]
    df = frame([(*x, 1, "r") for x in rows + bad], SCHEMA + ", id int, vector string")
    found = got(ann.nearest(df, df))
    assert found[0] == [(0.0, 2), (0.0, 3), (5**0.5, 5)] and set(found) == {0, 2, 3, 5}
    assert ann.nearest(frame([], SCHEMA), frame([], SCHEMA)).collect() == []


def test_query_over_the_test_data(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = brute_force(rows, [i for i, _ in rows if i % 100 == 0])
    found = got(queries.op4_nearest(spark, small))
    assert {q: [i for _, i in v] for q, v in found.items()} == {q: [i for _, i in v] for q, v in want.items()}


def test_codes_leave_out_most_rows_of_the_test_data(spark, small):
    rows = queries.op4_nearest(spark, small.replace("sf0.001", "sf0.1"))
    n = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.1')}/embeddings.parquet").where(ann.usable(F.col("embedding"))).count()
    assert rows.groupBy("query_id").agg(F.first("reranked").alias("n")).agg(F.avg("n")).first()[0] < 0.1 * n


def test_finite_vectors_of_any_size(frame):
    r = np.random.default_rng(3)
    schema = SCHEMA.replace("float", "double")
    for size in (1e39, 1e200, 1e-200, 1e-310):
        rows = [(k, (size * r.standard_normal(16)).tolist()) for k in range(200)]
        found = got(ann.nearest(frame(rows, schema), frame(rows[:5], schema)))
        known = [np.array(v) / size for _, v in rows]
        for q in range(5):
            want = sorted((float(np.sqrt(((v - known[q]) ** 2).sum())), k) for k, v in enumerate(known) if k != q)[:10]
            assert [k for _, k in found[q]] == [k for _, k in want]
            assert np.allclose([s / size for s, _ in found[q]], [s for s, _ in want], rtol=1e-9 if size > 1e-300 else 1e-2)
    mixed = [(0, [1.0, 0.0]), (1, [1e200, 0.0]), (2, [1.0, 1e-9]), (3, [1.0, 3e-9]), (4, [1e200, 1e190])]
    found = got(ann.nearest(frame(mixed, schema), frame(mixed, schema)))
    assert [[k for _, k in found[q]] for q in range(5)] == [[2, 3, 1, 4], [4, 0, 2, 3], [0, 3, 1, 4], [2, 0, 1, 4], [1, 0, 2, 3]]
