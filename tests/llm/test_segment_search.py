"""Exact top-k search against brute force in plain integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import segment_search as ss
from kiln.llm.q11 import SQL
from oracle import compare, duck_connection


def brute(rows, k=5, scale=256):
    """rows: (vec_id, vector) -> multiset of (query_id, rank, vec_id, score)."""
    ok = [(i, [int(np.floor(scale * float(np.float32(c)))) for c in v]) for i, v in rows
          if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is None or i % 50:
            continue
        all_ = [(-sum(x * y for x, y in zip(q, v, strict=True)), j is None, j or 0, b, j) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q)]
        out += [(i, r + 1, t[4], -t[0]) for r, t in enumerate(sorted(all_)[:k])]
    return sorted(out, key=str)


def result(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 0.5) for i, v in rows], "vec_id long, embedding array<float>, score string, rank double")
    return sorted([tuple(r) for r in ss.nearest(df, F.col("id") % 50 == 0, **kw).select("query_id", "rank", "vec_id", "score").collect()], key=str)


def test_awkward_rows_and_ties(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 12)).round(2)
    rows = [(i * 25, base[i].tolist()) for i in range(40)]
    rows += [(50, base[0].tolist()), (50, base[0].tolist()), (None, base[1].tolist()), (7, base[1].tolist()), (6, base[1].tolist())]
    rows += [(100, None), (150, [float("nan")] * 12), (200, [None] * 12), (250, [float("inf")] + [0.0] * 11), (-50, [0.0] * 12)]
    rows += [(1000, [1.0, 2.0]), (1001, [2.0, -1.0]), (1050, [0.5]), (2000, []), (2001, [])]
    assert result(spark, rows) == brute(rows)


def test_few_and_no_rows(spark):
    assert result(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])]) == [(0, 1, 1, 256 * 128)]
    assert result(spark, [(0, [1.0])]) == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    out = ss.nearest(empty, F.col("id") % 50 == 0)
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_huge_entries_saturate(spark):
    rows = [(0, [3e38, 1.0]), (1, [-3e38, 0.0]), (2, [1.0, 1.0]), (3, [3e38, 3e38])]
    got = [r for r in result(spark, rows) if r[0] == 0]
    assert [r[2:] for r in got] == [(2, 2 ** 63 - 1), (3, 2 ** 63 - 1), (1, -2 ** 63)]      # equal scores: smaller id first


def test_many_chunks_clusters_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(ss, "CHUNK", 150)
    monkeypatch.setattr(ss, "SEEDS", 60)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 32)) * 3
    v = (centres[rng.integers(0, 6, 1200)] + rng.normal(size=(1200, 32)) * 0.3).round(3)
    v[::3] = v[0]                                     # a third of all rows hold one vector
    rows = [(i, v[i].tolist()) for i in range(1200)]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("dim", [1, 5, 16, 64])
def test_bounds_hold_at_every_level(dim):
    rng = np.random.default_rng(dim)
    q, y = rng.integers(-300, 300, (20, dim)), rng.integers(-300, 300, (50, dim))
    exact, last = ss.exact_products(q, y), None
    for starts in ss.levels(dim):
        a, b = ss.summary(q, starts), ss.summary(y, starts)
        far = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
        true = ((q[:, None, :] - y[None, :, :]) ** 2).sum(-1)
        assert (far <= true + 1e-6 * true.max()).all() and (a @ b.T >= exact - 1e-6 * np.abs(exact).max()).all()
        assert last is None or (a @ b.T <= last + 1e-6 * np.abs(last).max()).all()
        last = a @ b.T


def test_query_equals_sql(spark):
    from kiln.llm.q11 import QUERIES
    sf = "/root/testdata/sf0.01"
    assert not compare(QUERIES["op11_exact_top_k"](spark, sf).toPandas(), duck_connection(sf).execute(SQL).df())
