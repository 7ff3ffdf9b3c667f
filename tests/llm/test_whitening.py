"""Whitening against a dense eigenvalue routine, and its edges."""

from __future__ import annotations

import numpy as np
import pytest

from cardlake.llm import whitening
from cardlake.llm.queries import QUERIES


def rounded(vectors):
    return [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]


def dense(rows, k):
    """Distinct rows, their sums, leading eigenpairs and the trace of the covariance."""
    fit = np.array(sorted({tuple(r) for r in rows}))
    mean = fit.mean(0)
    apart = fit - mean
    cov = apart.T @ apart / len(fit)
    values, vectors = np.linalg.eigh(cov)
    return fit, mean, values[::-1][:k], vectors[:, ::-1][:, :k], np.trace(cov)


def test_query(spark, sf_dir, table):
    vectors = {i: v for i, v in table("embeddings", "vec_id, embedding") if v is not None}
    rows = dict(zip(vectors, rounded(vectors.values())))
    fit, mean, values, directions, trace = dense(rows.values(), 16)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    found = QUERIES["op11_whitening"](spark, sf_dir).collect()
    assert {(r.vec_id, r.component) for r in found} == {(i, c) for i in rows for c in range(1, 17)}
    white = {i: (np.array(x) - mean) @ directions / np.sqrt(values) for i, x in rows.items()}
    exact = {
        i: sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for i, x in rows.items()
    }
    got = np.array([r.whitened for r in found])
    want = np.array([white[r.vec_id][r.component - 1] for r in found])
    component = np.array([r.component for r in found])
    for c in range(1, 17):
        a, b = got[component == c], want[component == c]
        assert np.abs(a - np.sign(a @ b) * b).max() < 1e-7
    for r in found:
        assert r.n == n and r.deviation == exact[r.vec_id]
        assert abs(r.explained * trace / values[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9


@pytest.mark.parametrize("dimensions, n, wanted", [(150, 400, 16), (300, 900, 3), (1, 9, 16), (40, 7, 16)])
def test_iteration_locks_to_double_precision(dimensions, n, wanted):
    rows = np.random.default_rng(5).standard_normal((n, dimensions)) * np.linspace(1, 0.2, dimensions)
    rows -= rows.mean(0)
    matrix, calls = rows.T @ rows / n, []

    def times(block):
        calls.append(block.shape[1])
        return matrix @ block

    values, vectors = whitening.leading(times, dimensions, wanted)
    wanted = min(wanted, dimensions)
    expected = np.linalg.eigvalsh(matrix)[::-1][:wanted]
    assert np.abs(values - expected).max() < 1e-13 * expected[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12 * expected[0]
    assert max(calls) <= wanted + 8


def test_equal_eigenvalues():
    matrix = np.diag([3.0] * 20 + [1.0] * 30)
    values, vectors = whitening.leading(lambda block: matrix @ block, 50, 16)
    assert np.allclose(values, 3.0, atol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-13)


SCHEMA = "vec_id long, embedding array<double>, deviation string, n int"


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [[float(c) for c in v] for v in rng.standard_normal((30, 4))]
    odd = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 0.0], [1.0, float("inf"), 0.0, 0.0],
           [1e300, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, "x", 1) for i, v in enumerate(good + odd)] + [(3, good[3], "x", 1)] * 20
    rows += [(None, good[4], None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fitted(frame)
    assert model.n == 30 and len(model.eigenvalues) == 4
    found = whitening.whitened(frame, model).collect()
    assert len(found) == 51 and found[0]["n"] == 1
    fit, mean, values, _, _ = dense(rounded(good), 4)
    assert np.allclose(model.eigenvalues, values)
    white = np.array([r.whitened for r in found[:30]])
    assert np.allclose(white.T @ white / 30, np.eye(4), atol=1e-9)
    sums = fit.sum(0).tolist()
    for r, x in zip(found, rounded(good)):
        assert r.deviation == sum((30 * c - s) ** 2 for c, s in zip(x, sums))


def test_wide_entries(spark):
    """Deviations stay exact beyond what doubles hold, and are null beyond 64 bits."""
    rows = [(i, [float(2 ** (2 * i)), 1.0]) for i in range(10)]
    for scale, fits in ((1, True), (2.0**20, False)):
        frame = spark.createDataFrame([(i, [c * scale for c in v]) for i, v in rows], "vec_id long, embedding array<double>")
        model = whitening.fitted(frame)
        xs = [[int(64 * c * scale) for c in v] for _, v in rows]
        sums = [sum(c) for c in zip(*xs)]
        exact = [sum((10 * c - s) ** 2 for c, s in zip(x, sums)) for x in xs]
        got = [r.deviation for r in whitening.whitened(frame, model).collect()]
        assert got == [e if e < 2**63 else None for e in exact]
        assert (None not in got) == fits


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5])]])
def test_nothing_varies(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fitted(frame)
    assert len(model.eigenvalues) == 0
    found = whitening.whitened(frame, model).collect()
    assert [(r.vec_id, r.deviation, r.whitened) for r in found] == [(i, 0, []) for i, v in rows if v]
