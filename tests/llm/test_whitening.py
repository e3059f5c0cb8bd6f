import math

import numpy as np
import pytest

from starflow.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>"


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    made = (q * np.asarray(values, dtype=float)) @ q.T
    return (made + made.T) / 2


def brute_force(rows, k=8, scale=1024, offset=100_000):
    """The integers, exact deviations, and the eigenpairs of a dense solver."""
    x = [[math.floor(scale * c) + offset for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    matrix = centred.T @ centred / n
    values, axes = np.linalg.eigh(matrix)
    return deviation, centred, matrix, values[::-1][:k], axes[:, ::-1][:, :k]


def check(rows, table, told, k=8):
    deviation, centred, matrix, values, axes = brute_force(rows, k)
    by_id = {i: (d, c) for (i, _), d, c in zip(rows, deviation, centred)}
    told = sorted(told.collect(), key=lambda r: r.component)
    assert [r.component for r in told] == list(range(1, len(values) + 1))
    assert np.allclose([r.eigenvalue for r in told], values, rtol=1e-10)
    assert np.allclose([r.explained for r in told], values / np.trace(matrix), rtol=1e-9)
    mine = np.array([r.axis for r in told]).T
    assert np.abs(np.abs((mine * axes).sum(axis=0)) - 1).max() < 1e-9
    assert all(r.n == len(rows) and r.identity_error < 1e-9 for r in told)
    found = table.collect()
    assert len(found) == len(rows)
    for r in found:
        d, c = by_id[r.vec_id]
        assert r.deviation == (d if d < 1 << 63 else None)
        assert np.allclose(r.whitened, c @ mine / np.sqrt(values), atol=1e-9)


@pytest.mark.parametrize("seed, dim", [(0, 3), (1, 8), (2, 24)])
def test_against_a_dense_solver(frame, seed, dim):
    r = np.random.default_rng(seed)
    rows = [(i, (r.standard_normal(dim) * np.arange(1, dim + 1) ** 0.5).tolist()) for i in range(300)]
    check(rows, *whitening.whitened(frame(rows, SCHEMA)), k=min(8, dim))


@pytest.mark.parametrize(
    "values",
    [np.linspace(1, 2, 40), np.r_[np.full(12, 5.0), np.ones(28)], np.r_[1e6, 1e3, np.linspace(3, 1, 30)], np.ones(9), [2.0], np.r_[np.ones(5), np.zeros(11)]],
)
def test_contour_against_a_dense_solver(values):
    matrix = symmetric(values)
    found, axes = whitening.components(matrix, 8)
    want = np.sort(values)[::-1][:8]
    want = want[want > 0]
    assert len(found) == len(want) and np.abs(found - want).max() < 1e-13 * max(values) * len(values)
    assert np.abs(matrix @ axes - axes * found).max() < 1e-12 * max(values)
    assert np.abs(axes.T @ axes - np.eye(len(found))).max() < 1e-12


def test_inertia_counts():
    r = np.random.default_rng(5)
    for _ in range(100):
        a = r.standard_normal((r.integers(1, 25),) * 2)
        a = a + a.T
        if r.random() < 0.4:
            np.fill_diagonal(a, 0)
        assert whitening.inertia(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert whitening.inertia(np.zeros((4, 4))) == 0


def test_a_missed_eigenvalue_is_noticed():
    """More are counted than the interval given holds: an error, not a smaller result."""
    with pytest.raises(ArithmeticError):
        whitening.feast(symmetric([5.0, 4.0, 1.0, 0.5]), 3.0, 6.0, 3, rounds=45)


def test_bad_vectors_repeats_and_clashing_names(frame):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(7)
    good = [(i, r.standard_normal(3).tolist()) for i in range(20)]
    bad = [(50, None), (51, [nan, 1.0, 1.0]), (52, [1.0, None, 1.0]), (53, [-inf, 1.0, 1.0]), (54, [1.0]), (55, []), (56, [1e300, 0.0, 0.0])]
    df = frame([(*x, 7.0) for x in good + bad], SCHEMA + ", whitened double")
    table, told = whitening.whitened(df)
    assert table.columns == ["vec_id", "embedding", "whitened", "deviation", "_whitened"]
    check(good, table.drop("whitened").withColumnRenamed("_whitened", "whitened"), told, k=3)
    table, told = whitening.whitened(frame([], SCHEMA))
    assert table.collect() == [] and told.collect() == []


def test_equal_rows_have_no_component(frame):
    table, told = whitening.whitened(frame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], SCHEMA))
    assert told.collect() == [] and [(r.deviation, r.whitened) for r in table.collect()] == [(0, [])] * 3


def test_large_numbers_stay_exact(frame):
    r = np.random.default_rng(8)
    rows = [(i, (1e12 * r.standard_normal(2)).tolist()) for i in range(50)]
    deviation = dict(zip((i for i, _ in rows), brute_force(rows)[0]))
    table, told = whitening.whitened(frame(rows, SCHEMA))
    assert all(d >= 1 << 63 for d in deviation.values()) and all(r.deviation is None for r in table.collect())
    check(rows, table, told, k=2)


def test_query_over_the_test_data(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    deviation, centred, matrix, values, _ = brute_force(rows)
    found = queries.op13_embedding_whitening(spark, small).collect()
    assert len(found) == 8 * len(rows) and max(r.identity_error for r in found) < 1e-4
    by_id = {i: d for (i, _), d in zip(rows, deviation)}
    assert all(r.deviation == by_id[r.vec_id] and r.n == len(rows) for r in found)
    for r in found:
        assert abs(r.explained / (values[r.component - 1] / np.trace(matrix)) - 1) < 1e-6
    white = np.zeros((len(rows), 8))
    place = {i: k for k, (i, _) in enumerate(rows)}
    for r in found:
        white[place[r.vec_id], r.component - 1] = r.whitened
    own = np.linalg.eigh(matrix)[1][:, ::-1][:, :8]
    assert np.abs(np.abs(white) - np.abs(centred @ own / np.sqrt(values))).max() < 1e-6
