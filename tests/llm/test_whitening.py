import math
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from riskloom.llm.charpoly import FRACTION, coefficient_bound, largest_roots, null_vectors, primes_for, recombined, residues
from riskloom.llm.whitening import exact_products, fit_whitening, whiten

SCHEMA = "vec_id long, embedding array<float>, component int, key string, n int"


def plain_polynomial(matrix):
    """Faddeev and LeVerrier's recurrence in fractions."""
    size = len(matrix)
    m = [[Fraction(0)] * size for _ in range(size)]
    c = [Fraction(0)] * size + [Fraction(1)]
    for k in range(1, size + 1):
        product = [[sum(matrix[i][t] * m[t][j] for t in range(size)) for j in range(size)] for i in range(size)]
        m = [[product[i][j] + (c[size - k + 1] if i == j else 0) for j in range(size)] for i in range(size)]
        c[size - k] = -sum(matrix[i][t] * m[t][i] for i in range(size) for t in range(size)) / k
    return [int(x) for x in c]


@pytest.mark.parametrize("size, rows", [(1, 4), (2, 5), (5, 3), (7, 30)])
def test_polynomial_equals_a_plain_recurrence(size, rows):
    rng = np.random.default_rng(size)
    x = rng.integers(-1000, 1000, (rows, size)).astype(object)
    scatter = (rows * x.T @ x - np.outer(x.sum(0), x.sum(0))).tolist()
    trace = sum(scatter[i][i] for i in range(size))
    primes = primes_for(coefficient_bound(trace, size))
    found = recombined(residues(scatter, primes), primes)
    assert found == plain_polynomial(scatter)
    roots = [r / 2**FRACTION for r, m in largest_roots(found, size, trace) for _ in range(m)]
    true = np.linalg.eigvalsh(np.array(scatter, float))[::-1][: len(roots)]
    assert len(roots) == min(size, rows - 1) and np.allclose(roots, true, rtol=1e-9)


def test_equal_roots_give_orthonormal_vectors():
    diagonal = [9, 5, 5, 5, 2, 2, 0, 0]
    matrix = np.diag(diagonal).tolist()
    primes = primes_for(coefficient_bound(28, 8))
    roots = largest_roots(recombined(residues(matrix, primes), primes), 16, 28)
    assert [(round(r / 2**FRACTION, 9), m) for r, m in roots] == [(9, 1), (5, 3), (2, 2)]
    vectors = null_vectors(matrix, roots[1][0], 3)
    assert np.allclose(vectors @ vectors.T, np.eye(3), atol=1e-15) and np.allclose(vectors[:, [0, 4, 5, 6, 7]], 0)


def test_products_are_exact_for_any_long():
    rng = np.random.default_rng(0)
    for top in (50, 1 << 31, (1 << 63) - 1):
        y = rng.integers(-top, top, (200, 3))
        assert (exact_products(y) == y.astype(object).T @ y.astype(object)).all()


def brute(rows):
    """(n, sums, deviations, numpy's eigenvalues and vectors, x) of plain Python integers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    distinct = sorted(set(map(tuple, x)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    away = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    z = np.array([[c - Fraction(s, n) for c, s in zip(v, sums)] for v in distinct], float)
    values, vectors = np.linalg.eigh(z.T @ z / n)
    return n, sums, away, values[::-1], vectors[:, ::-1], x


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    n, sums, away, values, vectors, x = brute([r.embedding for r in rows])
    found = entry.queries()["op11_whitening"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == 16 * len(rows)
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-10
    deviation = {r.vec_id: r.deviation for r in found}
    assert [deviation[r.vec_id] for r in rows] == away
    shares = {r.component: r.explained for r in found}
    assert np.allclose([shares[k] for k in range(1, 17)], values[:16] / values.sum(), rtol=1e-10)
    whitened = np.zeros((len(rows), 16))
    place = {r.vec_id: k for k, r in enumerate(rows)}
    for r in found:
        whitened[place[r.vec_id], r.component - 1] = r.whitened
    z = np.array([[c - Fraction(s, n) for c, s in zip(v, sums)] for v in x], float)
    wanted = z @ vectors[:, :16] / np.sqrt(values[:16])
    sign = np.sign((wanted * whitened).sum(0))
    assert np.allclose(whitened * sign, wanted, atol=1e-7)


def test_edges(spark):
    rows = [
        (1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 0.0]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [-1.0, 2.0]), (9, [3.0, -0.5]),
    ]
    df = spark.createDataFrame([(k, v, 1, "k", 1) for k, v in rows], SCHEMA)
    kept = [(k, v) for k, v in rows if v and len(v) == 2 and all(c is not None and math.isfinite(c) for c in v)]
    n, _, away, values, _, _ = brute([v for _, v in kept])
    found = whiten(df, fit_whitening(df)).collect()
    assert len(found) == 2 * len(kept) and {r.n for r in found} == {n} == {3}
    assert sorted((r.deviation for r in found if r.component == 1)) == sorted(away)
    for none in ([], [(1, None)], [(1, [2.0, 2.0])], [(1, [2.0]), (2, [2.0])], [(1, [])]):
        empty = spark.createDataFrame([(k, v, 1, "k", 1) for k, v in none], SCHEMA)
        result = whiten(empty, fit_whitening(empty))
        assert result.count() == 0 and result.columns[:2] == ["vec_id", "component"]


def test_huge_entries_stay_exact(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1e15, 2.0])]
    df = spark.createDataFrame([(k, v, 1, "k", 1) for k, v in rows], SCHEMA)
    found = whiten(df, fit_whitening(df)).collect()
    assert {r.component for r in found} == {1, 2} and all(r.deviation is None for r in found)
    # A spread of 1 beside one of 1e19 is below a double's grain: only the first component is whitened sharply.
    first = sorted(r.whitened for r in found if r.component == 1)
    assert np.isfinite([r.whitened for r in found]).all() and abs(np.mean(np.square(first)) - 1) < 1e-9
