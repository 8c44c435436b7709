"""Whitening: exact arithmetic against fractions and plain determinants, components against an eigensolver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from convolake.llm import whitening as W


def charpoly(a):
    """Faddeev-LeVerrier with fractions."""
    n = len(a)
    m, c = [[Fraction(0)] * n for _ in range(n)], [Fraction(1)]
    for k in range(1, n + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(n)) + (c[-1] if i == j else 0) for j in range(n)] for i in range(n)]
        am = [[sum(a[i][x] * m[x][j] for x in range(n)) for j in range(n)] for i in range(n)]
        c.append(-sum(am[i][i] for i in range(n)) / k)
    return [int(x) for x in c]


def gram(rng, d, n=20, size=500):
    y = rng.integers(-size, size, (n, d)).astype(object)
    return [[int(v) for v in row] for row in y.T @ y]


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_characteristic_polynomial(spark, d):
    rng = np.random.default_rng(d)
    for a in (gram(rng, d), gram(rng, d, n=2), [[0] * d for _ in range(d)], [[5 if i == j else 0 for j in range(d)] for i in range(d)]):
        want = charpoly(a)
        for p in (2_147_483_647, 101):
            assert W.charpoly_mod(np.array([[v % p for v in row] for row in a], np.int64), p).tolist() == [c % p for c in want]
        assert max(abs(c).bit_length() for c in want) <= W.coefficient_bits(a)
        assert W.characteristic_polynomial(spark, a) == want


def test_roots_are_counted_with_multiplicity():
    poly = [1]
    for root in (3, 3, 3, 10, 7):
        poly = [a - root * b for a, b in zip([*poly, 0], [0, *poly], strict=True)]
    assert [W.roots_above(poly, num, 0) for num in (0, 2, 3, 6, 7, 9, 10)] == [5, 5, 2, 2, 1, 1, 0]
    assert W.roots_above(poly, 13, 2) == 2 and W.roots_above(poly, 11, 2) == 5
    found = W.isolated(poly, 5)
    assert [roots for *_, roots in found] == [1, 1, 3]
    assert [float(W.refined(poly, *x)) for x in found] == [10.0, 7.0, 3.0]


def test_close_roots_part():
    """Roots 2**-40 apart, relatively: an eigensolver in doubles mixes their vectors, this must not."""
    big = 1 << 50
    a = [[big + (1 << 10), 0, 1 << 9], [0, big, 0], [1 << 9, 0, 5]]
    poly = charpoly(a)
    found = W.isolated(poly, 3)
    roots = [W.refined(poly, *x) for x in found]
    assert len(roots) == 3
    for root in roots:
        (v,) = W.null_space(a, root, 1)
        off = [sum(Fraction(a[i][j]) * Fraction(v[j]) for j in range(3)) - root * Fraction(v[i]) for i in range(3)]
        assert max(abs(x) for x in off) < root * Fraction(1, 1 << 50) + 1 and abs(math.hypot(*v) - 1) < 1e-14
    first, second = (W.null_space(a, r, 1)[0] for r in roots[:2])
    assert abs(abs(first[0]) - 1) < 1e-9 and abs(abs(second[1]) - 1) < 1e-14


def test_digits():
    y = np.array([[0, 1, -1, 16_384, -16_385, 2**53, -(2**53), 123_456_789_012]])
    parts = W.digits_of(y)
    assert all(np.abs(p).max() <= 1 << 14 for p in parts)
    assert sum(p.astype(object) * (1 << (15 * k)) for k, p in enumerate(parts)).tolist() == y.tolist()


def fitted(spark, rows):
    v = W.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(3)
    return v, W.fit_whitening(v, W.commonest_length(v))


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_against_eigh(spark, scale):
    rng = np.random.default_rng(5)
    e = rng.normal(size=(300, 10)) @ rng.normal(size=(10, 10)) * scale
    v, fit = fitted(spark, [(i, row.tolist()) for i, row in enumerate(e)])
    y = np.floor(1024 * e)
    values, vectors = np.linalg.eigh(np.cov(y.T, bias=True))
    assert fit.n == 300 and fit.sums == y.astype(np.int64).sum(0).tolist()
    assert np.allclose(fit.values, values[::-1][:8], rtol=1e-10) and np.allclose(fit.explained, (values / values.sum())[::-1][:8], rtol=1e-10)
    assert np.allclose(np.abs((fit.components * vectors.T[::-1][:8]).sum(1)), 1, atol=1e-10)
    z = W.whitened(v, fit).collect()
    exact = {i: sum((300 * int(a) - s) ** 2 for a, s in zip(row, fit.sums, strict=True)) for i, row in enumerate(y)}
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**63 else None) for r in z)
    assert W.identity_error(W.whitened(v, fit), 8) < 1e-9


def test_equal_eigenvalues_and_constant_dimensions(spark):
    rows = [[s * (i == k) for i in range(4)] + [0.25] for k in range(4) for s in (1.0, -1.0)]
    v, fit = fitted(spark, list(enumerate(rows)))
    assert len(fit.values) == 4 and len(set(fit.values)) == 1 and np.allclose(fit.components @ fit.components.T, np.eye(4), atol=1e-14)
    assert W.identity_error(W.whitened(v, fit), 4) < 1e-12


def test_nothing_to_fit(spark):
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5])], [(1, None), (2, [None]), (3, [])]):
        v, fit = fitted(spark, rows)
        assert fit.values == [] and W.whitened(v, fit).count() == v.count()
