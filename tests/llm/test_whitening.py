"""Whitened vectors and eigenpairs against dense linear algebra and exact integers."""

import math

import numpy as np
import pytest

from larkspur.llm import feast, whitening

SCHEMA = "vec_id long, embedding array<float>, place string, n string, total double, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "p", "n", 1.5, "c") for i, v in rows], SCHEMA)


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    [5.0], [3, 3, 3, 3], list(range(1, 40)), [1e9, 1e6, 1e3, 1, 1e-3, 1e-6, 1e-9, 0, 0, 0, 0, 0],
    [2.0] * 12 + [1.0] * 30, [1 + i * 1e-6 for i in range(30)], [0.0] * 9 + [1.0], [-4, -2, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10],
    list(np.geomspace(1, 1e-4, 64)),
])
def test_eigenpairs(values):
    matrix = spectrum(values)
    found, vectors = feast.eigenpairs(matrix, 8)
    want = np.sort(values)[::-1][:8]
    top = np.abs(values).max()
    assert np.allclose(found, want, rtol=0, atol=1e-13 * top * len(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-12 * top


def test_no_matrix():
    assert len(feast.eigenpairs(np.zeros((3, 3)), 8)[0]) == 0
    assert len(feast.eigenpairs(np.zeros((0, 0)), 8)[0]) == 0


@pytest.mark.parametrize("seed", range(5))
def test_inertia_counts(seed):
    draw = np.random.default_rng(seed)
    matrix = draw.standard_normal((17, 17))
    matrix = matrix + matrix.T
    np.fill_diagonal(matrix, 0)  # pivots off the diagonal
    values = np.linalg.eigvalsh(matrix)
    for shift in (*draw.uniform(-10, 10, 20), 0.0):
        assert feast.above(matrix, shift) == int((values > shift).sum())


def check(got, good):
    """Rows of the report against integers and a dense eigensolver."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good], dtype=object)
    n, s = len(x), x.sum(axis=0)
    exact = [int(((n * row - s) ** 2).sum()) for row in x]
    centred = (x.astype(float) - np.array([float(v) for v in s]) / n)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    k = min(8, x.shape[1])
    assert len(got) == n * k
    assert sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["component"], r["deviation"]) for r in got) == sorted(
        (i is not None, i or 0, c, d) for (i, _), d in zip(good, exact) for c in range(1, k + 1))
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-9
    place = {i: j for j, (i, _) in enumerate(good)}
    for c in range(k):
        want = centred @ vectors[:, c] / math.sqrt(values[c])
        own = [r for r in got if r["component"] == c + 1]
        assert max(abs(r["explained"] - values[c] / np.trace(covariance)) for r in own) <= 1e-9
        mine = np.array([r["whitened"] for r in own])
        theirs = np.array([want[place[r["vec_id"]]] for r in own])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) <= 1e-7


def test_report(spark):
    draw = np.random.default_rng(4)
    basis = draw.standard_normal((20, 20)) * np.linspace(1, 0.05, 20)
    good = [(i, [float(v) for v in draw.standard_normal(20) @ basis + 3]) for i in range(400)]
    good += [(1000 + i, good[0][1]) for i in range(30)] + [(None, good[1][1])]
    bad = [(2000, None), (2001, [1.0] * 19 + [None]), (2002, [float("nan")] + [0.0] * 19), (2003, [float("inf")] * 20), (2004, []),
           (2005, [1.0] * 7), (2006, [float(2**44)] + [0.0] * 19)]
    check(whitening.report(table(spark, good + bad).repartition(6)).collect(), good)


def test_narrow_and_repeated_vectors(spark):
    good = [(i, [float(i % 7), float(i % 3)]) for i in range(40)]
    check(whitening.report(table(spark, good)).collect(), good)
    assert whitening.report(table(spark, [])).collect() == []
    assert whitening.report(table(spark, [(1, [0.5, 0.25])] * 9)).collect() == []
    assert whitening.report(table(spark, [(1, None), (2, [])])).collect() == []
    line = whitening.report(table(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)])).collect()
    assert {r["component"] for r in line} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in line)


def test_deviation_beyond_a_long():
    model = whitening.Fit(2, 3, (0, 3 * 2**40), np.zeros(0), np.zeros((2, 0)), 0.0)
    x = np.array([[0, 2**40], [1, 2**40], [0, 0]], dtype=np.int64)
    assert whitening.deviations(x, model).to_pylist() == [0, 9, None]


def test_large_entries_sum_exactly(spark):
    rows = [(i, [float(2**40), float(-(2**40) + i)]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(frame)
    assert model.sums == (50 * (2**50 + 100000), sum((-(2**40) + i) * 1024 + 100000 for i in range(50)))
