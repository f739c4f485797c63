import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from flexframe.llm import whitening

from .conftest import SF


def good(rows):
    return [(i, [math.floor(1024 * float(x)) + 100000 for x in v]) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]


def check(rows, found, components=8):
    """The result against numpy's eigenvalues and the contract's definitions, for vectors of one length."""
    rows = good(rows)
    n, d = len(rows), len(rows[0][1])
    x = np.array([v for _, v in rows], float)
    s = [sum(v[j] for _, v in rows) for j in range(d)]
    cov = np.cov(x.T, bias=True).reshape(d, d)
    e = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    assert len(found) == n * k
    table = {}
    for r in found:
        assert r.n == n
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-6
        assert r.identity_error < 1e-6
        table.setdefault((r.vec_id, int(r.deviation)), {})[r.component] = r.whitened
    assert {key for key in table} == {(i, sum((n * c - t) ** 2 for c, t in zip(v, s))) for i, v in rows}
    # scores of all rows, centred, have the identity as covariance, and point along eigenvectors
    if len(table) == n:
        dev = {i: sum((n * c - t) ** 2 for c, t in zip(v, s)) for i, v in rows}
        w = np.array([[table[i, dev[i]][c + 1] for c in range(k)] for i, _ in rows])
        assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-8
        axes = np.linalg.lstsq(x - x.mean(axis=0), w * np.sqrt(e[:k]), rcond=None)[0]
        assert np.abs(cov @ axes - axes * e[:k]).max() < 1e-6 * e[0]


def test_given_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    check([(r.vec_id, r.embedding) for r in df.collect()], whitening.whiten(spark, df).collect())


def test_characteristic_polynomial_is_exact(spark):
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 7):
        b = rng.integers(-9, 10, (d, d + 2)).astype(object)
        a = (b @ b.T).tolist()
        # Faddeev and LeVerrier's recurrence in fractions
        m, coefficients = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
        for k in range(1, d + 1):
            m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (coefficients[-1] if i == j else 0) for j in range(d)] for i in range(d)]
            coefficients.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
        assert whitening.characteristic(spark, a) == [int(c) for c in coefficients]


def product(roots):
    p = [1]
    for r in roots:
        p = [a - r * b for a, b in zip(p + [0], [0] + p)]
    return p


def test_roots_are_counted_and_isolated():
    roots = [0, 0, 3, 3, 3, 8, 10 ** 12, 10 ** 12 + 1, 10 ** 12 + 1, 10 ** 15]
    p = product(roots)
    for t in (0, 2, 3, 7, 8, 10 ** 12, 10 ** 12 + 1, 10 ** 16):
        assert whitening.roots_above(p, t) == sum(r > t for r in roots)
    found = whitening.isolate(p, 8)
    values = [(whitening.refine(p, *x), x[3]) for x in found]
    assert [m for _, m in values] == [1, 2, 1, 1, 3]
    for (v, _), r in zip(values, [10 ** 15, 10 ** 12 + 1, 10 ** 12, 8, 3]):
        assert abs(v - r) <= Fraction(r, 2 ** 158)
    # irrational roots: x^2 - 6x + 7
    (a, b) = [whitening.refine([1, -6, 7], *x) for x in whitening.isolate([1, -6, 7], 2)]
    assert abs((a - 3) ** 2 - 2) < Fraction(1, 2 ** 150) and abs((b - 3) ** 2 - 2) < Fraction(1, 2 ** 150)


def test_close_roots_have_their_own_vectors():
    # eigenvalues 10^20 and 10^20 + 2, beyond double precision, along (1, -1) and (1, 1)
    a = [[10 ** 20 + 1, 1], [1, 10 ** 20 + 1]]
    p = [1, -2 * (10 ** 20 + 1), (10 ** 20 + 1) ** 2 - 1]
    for x, sign in zip(whitening.isolate(p, 2), (1, -1)):
        (v,) = whitening.null_vectors(a, whitening.refine(p, *x), 1)
        assert abs(v[1] - sign * v[0]) < 1e-15


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as component", "2 as n", "3 as v", "4 as dim")


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)]
    rows += [(None, [0.5, 0.25, 1.0, 0.0]), (3, rows[3][1]), (50, None), (51, [nan, 1.0, 1.0, 1.0]), (52, [1.0, inf, 1.0, 1.0]), (53, [None, 1.0, 1.0, 1.0]), (54, [])]
    check(rows, whitening.whiten(spark, frame(spark, rows)).collect())
    assert whitening.whiten(spark, frame(spark, rows).where("false")).count() == 0
    assert whitening.whiten(spark, frame(spark, rows[:1])).count() == 0
    assert whitening.whiten(spark, frame(spark, [rows[0]] * 3)).count() == 0


def test_constant_and_dependent_dimensions(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-50, 50, (30, 2)) / 64
    rows = [(i, [float(a), float(a), float(b), 2.0]) for i, (a, b) in enumerate(base)]
    check(rows, whitening.whiten(spark, frame(spark, rows)).collect())


def test_equal_eigenvalues(spark):
    rows = [(i, [float(s) if j == k else 0.0 for j in range(5)]) for i, (k, s) in enumerate((k, s) for k in range(5) for s in (1, -1))]
    check(rows, whitening.whiten(spark, frame(spark, rows)).collect())
    check(rows, whitening.whiten(spark, frame(spark, rows), components=3).collect(), 3)


def test_lengths_have_fit_lists_of_their_own(spark):
    rng = np.random.default_rng(7)
    a = [(i, [float(x) for x in rng.normal(size=2)]) for i in range(20)]
    b = [(100 + i, [float(x) for x in rng.normal(size=3)]) for i in range(25)]
    found = whitening.whiten(spark, frame(spark, a + b).repartition(3)).collect()
    check(a, [r for r in found if r.vec_id < 100])
    check(b, [r for r in found if r.vec_id >= 100])


@pytest.mark.parametrize("far", [1e3, 1e9])
def test_large_entries_stay_exact(spark, far):
    rows = [(i, [far * i, far * i * i, float(i % 3)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = [[math.floor(1024 * v) + 100000 for v in e] for _, e in rows]
    s = [sum(c) for c in zip(*x)]
    want = {i: Decimal(sum((12 * c - t) ** 2 for c, t in zip(v, s))) for i, v in enumerate(x)}
    found = whitening.whiten(spark, df).collect()
    assert {r.vec_id: r.deviation for r in found} == want
    assert max(r.identity_error for r in found) < 1e-4
