"""Whitening against exact and extended-precision recomputations, with awkward rows."""
import math
from fractions import Fraction

import numpy as np
import pytest

from biblioflow.llm.whitening import covariance, fit_whitening, products, solve, whiten

CLASH = "vec_id long, embedding array<double>, component string, n string, w int, _id string, i int, v string"


def frame(spark, rows):
    """Vectors with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, v, "c", "n", 1, "x", 2, "v") for i, v in rows], CLASH).repartition(3)


def grid(vectors):
    return [[math.floor(Fraction(c) * 1024) + 100000 for c in v] for v in vectors]


def exact(vectors):
    """(n, sums, covariance as fractions) of x."""
    x = grid(vectors)
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    mean = [Fraction(v, n) for v in s]
    cov = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]
    return x, n, s, cov


def test_whitened_values_are_right(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(90, 12)) * np.linspace(0.5, 0.1, 12) + rng.normal(size=12)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(0, rows[0][1]), (7, rows[8][1]), (None, rows[3][1]), (None, rows[3][1])]  # repeated rows and ids
    out = [(500, None), (501, [None] * 12), (502, [float("nan")] + [0.0] * 11), (503, [float("inf")] + [1.0] * 11),
           (504, [1.0] * 11), (505, []), (506, [2.0 ** 60] + [0.0] * 11)]
    got = whiten(frame(spark, rows + out)).collect()
    x, n, s, cov = exact([v for _, v in rows])
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    ids = sorted((i for i, _ in rows for _ in range(8)), key=repr)
    assert sorted((r["vec_id"] for r in got), key=repr) == ids
    v = np.array([[float(c) for c in r] for r in cov])
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    centred = np.array([[float(Fraction(a) - Fraction(b, n)) for a, b in zip(r, s)] for r in x])
    want = centred @ basis[:, :8] / np.sqrt(values[:8])
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    signs = np.array([np.sign(by[5, sum((n * a - b) ** 2 for a, b in zip(x[5], s))][c + 1][0] * want[5, c]) for c in range(8)])
    for (i, _), xs, w in zip(rows, x, want):
        mine = by[i, sum((n * a - b) ** 2 for a, b in zip(xs, s))]
        for c in range(8):
            assert min(abs(m - signs[c] * w[c]) for m in mine[c + 1]) < 1e-9
    trace = float(sum(cov[i][i] for i in range(12)))
    assert all(abs(r["explained"] * trace / values[r["component"] - 1] - 1) < 1e-12 for r in got)
    assert max(r["identity_error"] for r in got) < 1e-10


def residuals(cov, values, basis):
    a, x = np.array(cov, np.longdouble), basis.astype(np.longdouble)
    return float(np.abs(a @ x - x * values).max() / np.abs(a).max()), float(np.abs(x.T @ x - np.eye(len(a))).max())


@pytest.mark.parametrize("gap", [0.0, 1e-15, 1e-12, 1e-9, 1e-6, 1e-3])
def test_refinement_separates_clusters(gap):
    """Eigenvalues 1, 1 + gap, 1 + 2 gap, two equal small ones and a zero."""
    rng = np.random.default_rng(int(gap * 1e15) % 97)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0].astype(np.longdouble)
    for _ in range(3):  # orthonormal in extended precision
        q = q + q @ (np.eye(20, dtype=np.longdouble) - q.T @ q) / 2
    want = np.array([1 + 2 * gap, 1 + gap, 1.0, *np.linspace(0.9, 0.1, 14), 1e-6, 1e-6, 0.0], np.longdouble)
    cov = (q * want) @ q.T
    values, basis = solve((cov + cov.T) / 2)
    assert np.abs(values - want).max() < 1e-17
    off, skew = residuals(cov, values, basis)
    assert off < 1e-16 and skew < 1e-16
    if gap >= 1e-12:  # the vectors themselves, to double precision where the extended product has the digits
        assert np.abs(np.abs((q * basis).sum(axis=0)) - 1)[:3].max() < max(1e-15, (1e-18 / gap) ** 2 * 100)


def test_solve_of_degenerate_matrices():
    for cov in (np.zeros((3, 3), np.longdouble), np.eye(4, dtype=np.longdouble) * 7, np.zeros((0, 0), np.longdouble), np.full((1, 1), 5, np.longdouble)):
        values, basis = solve(cov)
        assert np.allclose(values.astype(float), np.linalg.eigvalsh(cov.astype(float))[::-1]) and basis.shape == cov.shape


def test_products_are_exact_for_entries_of_any_size():
    rng = np.random.default_rng(5)
    y = rng.integers(-900, 900, (5000, 3))
    y[17] = [2 ** 40, -3, 5]
    y[18] = [2 ** 30, 2 ** 27 + 1, 1]
    total = sum((p.astype(object) if p.dtype == object else p.astype(np.int64).astype(object)) for p, _ in products(y))
    assert (total == y.astype(object).T @ y.astype(object)).all()


def test_a_large_common_offset_costs_no_digits(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in 1e6 + rng.normal(size=3) * [0.5, 0.2, 0.05]]) for i in range(60)]
    fitted = fit_whitening(frame(spark, rows))
    _, n, s, cov = exact([v for _, v in rows])
    want = np.linalg.eigvalsh(np.array([[float(c) for c in r] for r in cov]))[::-1]
    assert fitted.n == n and np.abs(fitted.values / want - 1).max() < 1e-12
    assert [n * m + r for m, r in zip(fitted.centre, fitted.rest)] == s


def test_covariance_is_rounded_once():
    y = [[3, -1], [2, 5], [-4, 0]]
    rest = [1, 4]
    g = {(i, j): sum(r[i] * r[j] for r in y) for i in range(2) for j in range(i, 2)}
    got = covariance(3, rest, g)
    assert all(abs(float(got[i, j]) - float(Fraction(3 * g[i, j] - rest[i] * rest[j], 9))) < 1e-15 for i, j in g)


def test_few_rows_and_empty_tables(spark):
    assert whiten(frame(spark, [(1, [1.0, 2.0])]).limit(0)).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0])] * 4)).count() == 0  # no variance, no components
    got = whiten(frame(spark, [(1, [0.0, 1.0]), (2, [0.0, 3.0]), (3, [0.0, 2.0])])).collect()  # rank one
    assert sorted((r["vec_id"], r["component"], round(r["whitened"], 9), r["explained"]) for r in got) == [
        (1, 1, round(-math.sqrt(1.5), 9), 1.0), (2, 1, round(math.sqrt(1.5), 9), 1.0), (3, 1, 0.0, 1.0)]
    big = whiten(frame(spark, [(i, [float(2 ** 45 * i), 0.0]) for i in range(3)])).collect()
    assert sorted((r["vec_id"], r["deviation"]) for r in big) == [(0, None), (1, 0), (2, None)]
