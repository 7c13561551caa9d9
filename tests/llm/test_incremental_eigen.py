"""Whitening against dense linear algebra, and the rank-one updates against their matrices."""

from fractions import Fraction

import numpy as np
import pytest

from kiln.llm import incremental_eigen as ie


def integers(rows, scale=64, offset=1_000_000):
    return [(i, [int(np.floor(scale * float(np.float32(c)))) + offset for c in v]) for i, v in rows
            if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, whitened string, n int")


def check(got, rows, k=32):
    """got: result rows; rows: (vec_id, vector) of one length with distinct ids."""
    ok = integers(rows)
    x = np.array([v for _, v in ok], np.int64)
    n, total = len(x), x.sum(axis=0)
    c = (x * n - total) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    rank = min(k, int((e > e[0] * 1e-11).sum()) if e[0] > 0 else 0)
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == n * rank
    for j in range(rank):
        w = np.array([table[i, j + 1].whitened for i, _ in ok])
        want = c @ u[:, j] / np.sqrt(e[j])
        assert np.abs(w * np.sign(w @ want) - want).max() < 1e-7
        assert abs(table[ok[0][0], j + 1].explained - e[j] / e.sum()) < 1e-9
    for row, (i, _) in enumerate(ok):
        r = table.get((i, 1))
        if r:
            assert r.n == n and r.deviation == sum(int(v) ** 2 for v in x[row] * n - total) and r.identity_error < 1e-9


def test_whitening_equals_dense(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 40)) * np.linspace(0.05, 3, 40) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    rows = [(i, v[i].round(4).tolist()) for i in range(300)]
    rows += [(900, None), (901, [float("nan")] * 40), (902, [None] * 40), (903, [float("-inf")] * 40), (904, [])]
    check(ie.whitened(frame(spark, rows)).collect(), rows)


def test_deficient_rank(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-5, 6, (60, 3)).astype(float)
    v = np.hstack([base, base[:, :1] * 2, np.full((60, 2), 7.0)])       # repeated and constant dimensions
    check(ie.whitened(frame(spark, rows := [(i, v[i].tolist()) for i in range(60)])).collect(), rows)
    few = [(i, rng.normal(size=10).tolist()) for i in range(4)]          # fewer rows than dimensions
    check(ie.whitened(frame(spark, few)).collect(), few)


def test_nulls_repeats_lengths_and_empty(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.0, 0.5]), (3, [1.0, 2.0, 3.0]), (4, [0.0, 1.0, -3.0]), (5, [9.0])]
    got = ie.whitened(frame(spark, rows)).collect()
    two, three = [r for r in got if r.n == 4], [r for r in got if r.n == 2]
    assert len(two) == 8 and len(three) == 2 and len(got) == 10         # one row alone has no spread
    same = {(r.component, r.whitened) for r in two if r.vec_id == 1}
    assert len(same) == 2 and sum(r.vec_id is None for r in two) == 2
    assert ie.whitened(frame(spark, rows).limit(0)).count() == 0
    assert ie.whitened(frame(spark, [(1, [2.0, 2.0]), (2, [2.0, 2.0])])).count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    got = ie.whitened(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).collect()
    assert {r.vec_id: r.deviation for r in got}[1] is None


@pytest.mark.parametrize("dim", [1, 2, 3, 8, 33])
def test_rank_one_updates(dim):
    rng = np.random.default_rng(dim)
    for case in range(6):
        u = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        d = np.sort(rng.integers(0, 4 if case % 2 else 10 ** 6, dim).astype(float))      # many equal ones
        v = rng.normal(size=dim) * 10.0 ** rng.integers(-6, 4)
        if case > 3:
            v = u[:, 0] * 3                                                              # an eigenvector: all else deflates
        e, w = ie.rank_one(d, u, v, 0.7)
        a = u @ np.diag(d) @ u.T + 0.7 * np.outer(v, v)
        size = max(np.abs(a).max(), 1e-30)
        assert np.abs(w @ np.diag(e) @ w.T - a).max() < 1e-12 * size and np.abs(w.T @ w - np.eye(dim)).max() < 1e-12
        assert (np.diff(e) >= 0).all()


def test_secular_roots_interlace():
    d, z = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-8, 5.0]), np.array([1e-3, 1.0, 1e-7, 2.0, 1e-2])
    lam = d - np.diagonal(ie.secular_roots(d, z, 0.5))
    assert (lam >= d).all() and (lam[:-1] <= d[1:]).all()
    assert np.allclose(lam, np.linalg.eigvalsh(np.diag(d) + 0.5 * np.outer(z, z)), atol=1e-13)


def test_spectra_merge_to_the_whole():
    rng = np.random.default_rng(9)
    x = rng.integers(-20, 20, (90, 7)).astype(float)
    parts = [ie.Spectrum.empty(7) for _ in range(3)]
    for i, row in enumerate(x):
        parts[i % 3].add(row)
    whole = ie.Spectrum.unpack(parts[0].pack(), 7)
    for p in parts[1:]:
        whole.merge(p)
    c = x - x.mean(axis=0)
    assert whole.n == 90 and np.allclose(whole.mean, x.mean(axis=0)) and np.allclose(whole.u @ np.diag(whole.d) @ whole.u.T, c.T @ c)


def test_deviations_are_exact_beyond_longs():
    x, n = np.array([[2 ** 61, -3], [5, 7]], np.int64), 10 ** 6
    total = [int(v) for v in x.astype(object).sum(axis=0)]
    got = ie.deviations(x, n, total)
    assert [[int(v) for v in r] for r in got] == [[int(Fraction(int(a)) * n - t) for a, t in zip(r, total, strict=True)] for r in x]
