"""Exact ranks, positions with many hot values, block products, mergeable metrics and the online line."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import metrics as M
from kiln.operators import position as P
from kiln.operators import products as PR
from kiln.operators import stats as ST


# ------------------------------------------------------------------------------ selection

def _values():
    rng = random.Random(3)
    ties = [7.0] * 4000 + [8.0] * 3000 + [rng.gauss(7.5, 1) for _ in range(3000)]
    wide = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(9998)] + [float("inf"), float("-inf")]
    odd = [None if i % 3 == 0 else float("nan") if i % 3 == 1 else float(i) for i in range(10_000)]
    same = [5.0] * 10_000
    return list(zip(ties, wide, odd, same, strict=True))


@pytest.mark.parametrize("most", [5, 300, 100_000])
def test_exact_ranks_equal_sorting(spark, most):
    rows = _values()
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    probs = [0.0, 0.1, 0.39999, 0.4, 0.5, 0.7, 0.95, 1.0]
    got = ST.exact_ranks(df, ["a", "b", "c", "d"], lambda n: [int(p * (n - 1)) for p in probs], accuracy=200, most=most)
    for i, c in enumerate("abcd"):
        v = sorted((r[i] for r in rows if r[i] is not None), key=lambda x: (math.isnan(x), x))
        want = [v[int(p * (len(v) - 1))] for p in probs]
        assert [x == y or (math.isnan(x) and math.isnan(y)) for x, y in zip(got[c], want, strict=True)] == [True] * len(probs), c


def test_exact_ranks_of_few_and_no_values(spark):
    df = spark.createDataFrame([(1, None), (3, None)], "a int, b double")
    assert ST.exact_ranks(df, ["a", "b"], lambda n: [0, n - 1]) == {"a": [1.0, 3.0], "b": []}
    rows = ST.exact_quantiles(df, ["a", "b"], [0.5]).collect()
    assert [tuple(r) for r in rows] == [("a", 0.5, 1.0), ("b", 0.5, None)]
    assert ST.exact_ranks(df, [], lambda n: [0]) == {}


# ------------------------------------------------------------------------------ positions

@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_a_thousand_hot_values_are_split(spark, direction):
    n, nb = 200_000, 1_500
    df = spark.range(n).select((F.col("id") % 1000).cast("string").alias("a"), (F.col("id") % 7 % 2).alias("b"), "id")     # both leading keys are hot
    df = df.where("a <> '3'").unionByName(spark.range(200).select(F.lit(None).cast("string").alias("a"), F.lit(0).cast("long").alias("b"), (F.col("id") + n).alias("id")))
    keys = [("a", direction), ("b", direction), "id"]
    out, count = P.with_position_and_count(df, keys, buckets=nb, keep_intervals=True)
    assert "__kiln_b1" in out.columns
    rows = out.collect()
    sign = 1 if direction == "asc" else -1
    text = lambda v: (0 if v is None else 1, v or "")
    want = sorted(rows, key=lambda r: r["id"])
    want = sorted(want, key=lambda r: sign * r["b"])
    want = sorted(want, key=lambda r: text(r["a"]), reverse=direction == "desc")
    assert count == len(rows) and [r["pos"] for r in want] == list(range(count))
    sizes = {}
    for r in rows:
        sizes[r["__kiln_b1"], r["__kiln_b2"]] = sizes.get((r["__kiln_b1"], r["__kiln_b2"]), 0) + 1
    assert max(sizes.values()) <= 2 * count / nb + 50


# ------------------------------------------------------------------------------ products

def test_block_products_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(PR, "BLOCK", 300)
    rng = np.random.default_rng(5)
    a, b = rng.integers(-3, 4, (60, 6)).astype(float), rng.integers(-3, 4, (20_000, 6)).astype(float)
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)] + [(None, [0.0] * 6), (99, None), (98, [None] * 6), (97, [])], "i long, v array<double>")
    right = spark.createDataFrame([(int(j), v.tolist()) for j, v in enumerate(b)], "j long, w array<double>").repartition(5)
    got = {}
    for r in PR.dot_products(left, "i", "v", right, "j", "w", k=4).collect():
        got.setdefault(r["a"], []).append((r["rank"], r["b"], r["dot"]))
    dots = a @ b.T                                                     # whole numbers: many ties
    for i in range(60):
        want = sorted(range(20_000), key=lambda j: (-dots[i, j], j))[:4]
        assert sorted(got.pop(i)) == [(n + 1, j, dots[i, j]) for n, j in enumerate(want)]
    assert not got
    few = right.where("j < 700")
    assert {(r["a"], r["b"]): r["dot"] for r in PR.dot_products(left, "i", "v", few, "j", "w").collect()} == {
        (i, j): dots[i, j] for i in range(60) for j in range(700)}
    assert PR.dot_products(left, "i", "v", right.limit(0), "j", "w", k=2).count() == 0


def test_largest_products_leave_a_task_once_per_left_row(spark, monkeypatch):
    monkeypatch.setattr(PR, "BLOCK", 64)
    monkeypatch.setattr(PR, "HELD", 100)
    rng = np.random.default_rng(6)
    rows = [(int(i) // 2, v.tolist()) for i, v in enumerate(rng.integers(-2, 3, (700, 5)).astype(float))]      # ids come twice
    rows += [(5_000 + i, [1.0] * 5) for i in range(300)] + [(6_000 + i, [float(i % 3), 1.0]) for i in range(90)]   # copies; another length
    df = spark.createDataFrame(rows, "i long, v array<double>").repartition(4)
    got = {}
    for r in PR.dot_products(df, "i", "v", df, "i", "v", k=3).collect():
        got.setdefault(r["a"], []).append((r["rank"], r["dot"], r["b"]))
    want = {}
    for i, v in rows:
        want.setdefault(i, []).extend((-float(np.dot(v, w)), j) for j, w in rows if len(w) == len(v))
    assert {i: sorted(g) for i, g in got.items()} == {i: [(n + 1, -d, j) for n, (d, j) in enumerate(sorted(p)[:3])] for i, p in want.items()}
    best = PR._Best(np.arange(2), np.array([[1.0], [-1.0]]), 2)
    for start in (0, 4, 8):                                              # NaN is the largest, as in the window's order
        best.add(np.arange(start, start + 4), np.array([[1.0], [np.nan if start == 4 else 2.0], [0.0], [-3.0]]), start != 4)
    assert best.row.tolist() == [0, 0, 1, 1] and best.other.tolist() == [5, 1, 5, 3]
    assert len(best.rows()) == 4                                         # not k rows per left row and right block


def test_more_centroids_than_literals(spark, monkeypatch):
    from kiln.plans import q_metrics, q_vectors
    sf = "/root/testdata/sf0.001"
    want = sorted(map(tuple, q_vectors.q_pairwise_dot(spark, sf).collect()))
    err = q_metrics.q_error_reduction(spark, sf).collect()
    monkeypatch.setattr(q_vectors, "MAX_CENTROIDS", 3)
    monkeypatch.setattr(q_metrics, "MAX_CENTROIDS", 3)
    assert sorted(map(tuple, q_vectors.q_pairwise_dot(spark, sf).collect())) == want
    assert q_metrics.q_error_reduction(spark, sf).collect() == err


# ------------------------------------------------------------------------------ mergeable metrics

def _auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_by_group_and_merged_over_days(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None]), rng.randrange(3), rng.randrange(0, 20) / 20, rng.randrange(2)) for _ in range(900)]
    df = spark.createDataFrame(rows + [("x", 0, None, 1), ("only", 0, 0.5, 1)], "g string, day int, s double, y int").repartition(9)
    m = M.auc_metric("s", "y", bins=20)
    got = {r["g"]: r["auc"] for r in m.evaluate(df, by=["g"]).collect()}
    want = {g: _auc([(s, y) for k, _, s, y in rows if k == g]) for g in ("x", "y", None)}
    assert got.pop("only") is None and got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-12 for g in want)
    days = m.states(df, by=["g", "day"])                               # states are a table: merged without the rows
    again = {r["g"]: m.result(np.frombuffer(bytes(r["__state"]))) for r in m.merged(days, ["g"]).collect()}
    assert all(abs(again[g] - want[g]) < 1e-12 for g in want)
    assert abs(m.evaluate(df).first()["auc"] - _auc([(s, y) for _, _, s, y in rows] + [(0.5, 1)])) < 1e-12
    assert m.evaluate(df.limit(0), by=["g"]).count() == 0


def test_a_metric_whose_merge_is_no_sum(spark):
    spread = M.MergeableMetric("spread", ["v"], lambda: np.array([np.inf, -np.inf]),
                               lambda s, c: np.array([min(s[0], c["v"].min(initial=np.inf)), max(s[1], c["v"].max(initial=-np.inf))]),
                               lambda a, b: np.array([min(a[0], b[0]), max(a[1], b[1])]), lambda s: float(s[1] - s[0]), fan=3)
    df = spark.range(1000).select((F.col("id") % 4).alias("g"), F.col("id").cast("double").alias("v")).repartition(13)
    assert {r["g"]: r["spread"] for r in spread.evaluate(df, ["g"]).collect()} == {0: 996.0, 1: 996.0, 2: 996.0, 3: 996.0}
    assert spread.evaluate(df).first()["spread"] == 999.0


# ------------------------------------------------------------------------------ online line

def test_online_line_over_files_and_a_restart(spark, tmp_path):
    from datetime import datetime, timedelta

    from kiln.session import scratch_path
    from kiln.streaming.online import replay, stream_online_regression
    rng = random.Random(8)
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=60 * i + rng.random()), rng.choice(["a", "b", None]), rng.random(), rng.random()) for i in range(240)]
    rows[7] = (*rows[7][:3], None, 0.5)
    rows[8] = (*rows[8][:3], float("nan"), 0.5)
    schema = "id long, ts timestamp_ntz, k string, u double, v double"
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive(part):
        import pyarrow as pa
        import pyarrow.parquet as pq
        cols = list(zip(*part, strict=True))
        table = pa.table({"id": pa.array(cols[0], pa.int64()), "ts": pa.array(cols[1], pa.timestamp("us")), "k": pa.array(cols[2], pa.string()),
                          "u": pa.array(cols[3], pa.float64()), "v": pa.array(cols[4], pa.float64())})
        pq.write_table(table, str(folder / f"{part[0][0]:04d}.parquet"))

    paths = (scratch_path(spark, "lines"), scratch_path(spark, "lines-ckpt"))
    run = lambda: stream_online_regression(spark, str(folder), "*.parquet", df.schema, "ts", "k", "id", F.col("u"), F.col("v"), 0.2, (0.3, 0.6), 1, paths)
    df = spark.createDataFrame(rows, schema)
    out = None
    for first in (0, 80, 160):                                          # each run continues from the last one's checkpoint
        arrive(rows[first:first + 80])
        out = {r["key"]: tuple(r)[1:] for r in run().collect()}
    good = df.where("u IS NOT NULL AND NOT isnan(u)")
    want = {r["key"]: tuple(r)[1:] for r in replay(good, "k", F.col("ts"), "id", F.col("u"), F.col("v"), 0.2, (0.3, 0.6)).collect()}
    assert out.keys() == want.keys() == {"a", "b", None}
    for k in want:
        assert out[k][0] == want[k][0] and all(abs(x - y) < 1e-12 for x, y in zip(out[k][1:], want[k][1:], strict=True))


# ------------------------------------------------------------------------------ a vectorised user function

def test_storage_parser_over_a_series():
    import pandas as pd

    from kiln.plans.q_user import storage_udf
    got = storage_udf(pd.Series(["128GB SSD +  1TB HDD", None, "", "1.0TB Hybrid", "64GB Flash Storage + 2tb ssd", "1.2.3GB SSD", "SSD"], index=[5, 5, 1, 0, 2, 3, 4]))
    assert got.values.tolist() == [[128.0, 1024.0, 0.0], [0.0] * 3, [0.0] * 3, [0.0] * 3, [2048.0, 0.0, 64.0], [0.0] * 3, [0.0] * 3]
    assert storage_udf(pd.Series([], dtype=object)).shape == (0, 3)
