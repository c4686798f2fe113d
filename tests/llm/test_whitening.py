"""Whitening against numpy's eigenvectors, and its exact parts against small hand-made cases."""

from fractions import Fraction

import numpy as np
import pytest

from clickloom.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def determinant(m):
    m, out = [[Fraction(x) for x in row] for row in m], Fraction(1)
    for k in range(len(m)):
        pivot = next((i for i in range(k, len(m)) if m[i][k]), None)
        if pivot is None:
            return 0
        if pivot != k:
            m[k], m[pivot], out = m[pivot], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k], strict=True)]
    return int(out)


@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_polynomial(spark, n):
    rng = np.random.default_rng(n)
    a = rng.integers(-9, 9, (n, n))
    a[:, -1] = a[:, 0]  # a root at zero, and zeros below the diagonal of the reduced matrix
    matrix = (a @ a.T).tolist()
    poly = whitening.characteristic_polynomial(spark, matrix)
    for x in range(-2, n):
        shifted = [[(x if i == j else 0) - matrix[i][j] for j in range(n)] for i in range(n)]
        assert sum(c * x**k for k, c in enumerate(poly)) == determinant(shifted)


def test_primes():
    assert whitening.primes_below(100, 4) == [97, 89, 83, 79]


def test_roots_close_together_and_repeated():
    poly = [1]
    for r in (0, 0, 1, 1, 5, 5, 5, 7, 1000003, 1000004):
        poly = [(poly[i - 1] if i else 0) - r * (poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
    found = whitening.real_roots(poly, 10, 40)
    assert [(round(float(x), 9), many) for x, many in found] == [(1000004, 1), (1000003, 1), (7, 1), (5, 3), (1, 2)]
    assert [many for _, many in whitening.real_roots(poly, 3, 40)] == [1, 1, 1]


def test_query_against_numpy(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = queries.op12_whitening(spark, SF).collect()
    x = np.floor(64 * np.array([r.embedding for r in vectors], float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows) == 32 * n
    for i, r in enumerate(vectors):
        for k in range(32):
            got, want = by[r.vec_id, k + 1], (x[i] - sums / n) @ axes[:, k] / np.sqrt(values[k])
            assert abs(abs(got.whitened) - abs(want)) < 1e-7 and got.n == n
            assert got.deviation == int(((n * x[i] - sums) ** 2).sum())
            assert abs(got.explained - values[k] / values.sum()) < 1e-12 and got.identity_error < 1e-9
    whitened = np.array([[by[r.vec_id, k + 1].whitened for k in range(32)] for r in vectors])
    assert np.abs(np.cov(whitened.T, bias=True) - np.eye(32)).max() < 1e-9


def rows_of(spark, rows, kind="double"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n long, component int")
    return whitening.whiten(frame).collect()


def test_vectors_that_take_no_part(spark):
    odd = [None, [None, 1.0], [float("inf"), 1.0], [float("nan"), 1.0], [], [1.0, 2.0, 3.0], [1e300, 0.0]]
    good = [(1, [1.0, 2.0], 0, 0), (1, [1.0, 2.0], 0, 0), (None, [3.0, 5.0], 0, 0), (8, [-4.0, 1.5], 0, 0)]
    got = rows_of(spark, good + [(20 + i, x, 0, 0) for i, x in enumerate(odd)])
    assert sorted(x.vec_id or 0 for x in got) == [0, 0, 1, 1, 1, 1, 8, 8] and {x.n for x in got} == {4}
    assert all(x.identity_error < 1e-9 for x in got)


def test_no_spread_and_equal_eigenvalues(spark):
    assert rows_of(spark, [(1, [1.0, 2.0], 0, 0)] * 3) == [] and rows_of(spark, []) == []
    # Two equal dimensions, a constant one: two components are left.
    flat = rows_of(spark, [(i, [float(i), float(i), 0.0, float(i % 2)], 0, 0) for i in range(10)], "float")
    assert len(flat) == 20 and flat[0].identity_error < 1e-9
    axes = [[float(k == i) * s for i in range(3)] for k in range(3) for s in (1, -1)]
    equal = rows_of(spark, [(i, x, 0, 0) for i, x in enumerate(axes)])
    assert len(equal) == 18 and equal[0].identity_error < 1e-9 and abs(equal[0].explained - 1 / 3) < 1e-12


def test_entries_beyond_doubles_are_exact(spark):
    got = rows_of(spark, [(i, [1e15 * i, 3.0 * i * i], 0, 0) for i in range(5)])
    assert got[0].identity_error < 1e-9 and len(got) == 10
    wide = np.array([[1 << 40, 5], [3, -(1 << 41)], [7, 7]], np.int64)
    exact = [[sum(int(r[i]) * int(r[j]) for r in wide) for j in range(2)] for i in range(2)]
    assert whitening._products(wide).tolist() == exact
