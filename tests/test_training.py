"""Epoch-wise training against the same steps done densely in NumPy, and its loop's promises."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import training as TR

NET = TR.Network(5, (TR.Head("yes", "binary", "y"), TR.Head("kind", "classes", "k", 3), TR.Head("part", "unit", "u")), hidden=(4, 3), seed=7)


def rows(n=90, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)).round(3)
    out = [(i, x[i].tolist(), int(x[i, 0] > 0), int(i % 3), float(abs(x[i, 1]) % 1)) for i in range(n)]
    return [(i, f, None if i % 10 == 3 else y, None if i % 7 == 2 else k, u) for i, f, y, k, u in out]


SCHEMA = "key long, features array<double>, y int, k int, u double"


def loss(net, w, data):
    """Summed loss of some rows, one at a time."""
    total = {h.name: [] for h in net.heads}
    for _, x, *labels in data:
        a = np.zeros(net.dim) if x is None else np.array(x)
        for i in range(len(net.hidden)):
            a = np.maximum(a @ w[f"w{i}"] + w[f"b{i}"], 0)
        for h, y in zip(net.heads, labels, strict=True):
            if y is None:
                continue
            z = a @ w[f"w_{h.name}"] + w[f"b_{h.name}"]
            if h.kind == "classes":
                total[h.name].append(np.log(np.exp(z - z.max()).sum()) - (z - z.max())[y])
            else:
                p = 1 / (1 + np.exp(-z[0]))
                total[h.name].append(-np.log(p if y else 1 - p) if h.kind == "binary" else (p - y) ** 2)
    return sum(np.mean(v) for v in total.values() if v)


def by_hand(net, data, epochs, batches, rate, optimizer):
    """The training with derivatives by finite differences."""
    from hashlib import md5
    batch = lambda k: int(md5(f"{k}|{net.seed}".encode()).hexdigest()[:8], 16) % batches
    w = net.start()
    s = {n: np.zeros_like(v) for n, v in w.items()}
    for epoch in range(1, epochs + 1):
        for b in TR.batch_order(epoch, batches, net.seed):
            part, grad = [r for r in data if batch(r[0]) == b], {}
            for n, v in w.items():
                g = np.zeros_like(v)
                for at in np.ndindex(v.shape):
                    old = v[at]
                    v[at] = old + 1e-6
                    up = loss(net, w, part)
                    v[at] = old - 1e-6
                    g[at] = (up - loss(net, w, part)) / 2e-6
                    v[at] = old
                grad[n] = g
            for n in w:
                s[n] = 0.9 * s[n] + 0.1 * grad[n] ** 2
                w[n] = w[n] - rate * (grad[n] / (np.sqrt(s[n]) + 1e-7) if optimizer == "rmsprop" else grad[n])
    return w


@pytest.mark.parametrize("optimizer", ["sgd", "rmsprop"])
def test_steps_equal_finite_differences(spark, optimizer):
    data = rows(40)
    done = TR.fit(NET, spark.createDataFrame(data, SCHEMA), "key", epochs=2, batches=2, rate=0.02, optimizer=optimizer)
    want = by_hand(NET, data, 2, 2, 0.02, optimizer)
    for n, w in want.items():
        assert np.abs(done.weights[n] - w).max() < (1e-7 if optimizer == "sgd" else 2e-4), n


def test_history_and_validation(spark):
    train, val = rows(60), rows(30, seed=2)
    done = TR.fit(NET, spark.createDataFrame(train, SCHEMA), "key", spark.createDataFrame(val, SCHEMA), epochs=3, batches=2, optimizer="sgd", rate=0.1)
    h = done.history(spark).orderBy("epoch").collect()
    assert [r["epoch"] for r in h] == [1, 2, 3]
    assert abs(h[-1]["val_loss"] - loss(NET, done.weights, val)) < 1e-9
    assert abs(h[0]["loss"] - sum(h[0][f"{x}_loss"] for x in ("yes", "kind", "part"))) < 1e-12
    got = done.evaluate(spark.createDataFrame(val, SCHEMA))
    assert got["yes"]["n"] == 27 and abs(got["yes"]["loss"] - h[-1]["val_yes_loss"]) < 1e-12


def test_sums_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(TR, "FAN", 2)                                   # several rounds of combining
    df = spark.createDataFrame(rows(), SCHEMA).repartition(9, "key")
    w = NET.start()
    many, one = (TR._total(NET, w, d, True, t) for d, t in ((df, 9), (df.coalesce(1), 1)))
    for h in ("yes", "kind", "part"):
        assert np.allclose(many[h][0], one[h][0]) and all(np.allclose(many[h][1][n], one[h][1][n]) for n in one[h][1])


def test_resume_repeats_nothing_and_ends_the_same(spark, monkeypatch):
    from kiln.session import scratch_path
    df = spark.createDataFrame(rows(50), SCHEMA)
    whole = TR.fit(NET, df, "key", df, epochs=4, batches=2)
    path = scratch_path(spark, "resume")
    TR.fit(NET, df, "key", df, epochs=2, batches=2, path=path)
    steps = []
    total = TR._total
    monkeypatch.setattr(TR, "_total", lambda *a: steps.append(a[3]) or total(*a))
    again = TR.fit(NET, df, "key", df, epochs=4, batches=2, path=path, resume=True)
    assert sum(steps) == 4                                              # two epochs of two steps
    assert all(np.allclose(again.weights[n], whole.weights[n], atol=1e-12) for n in whole.weights)
    for a, b in zip(again.rows, whole.rows, strict=True):
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_early_stop_returns_the_best_epoch(spark):
    train, val = rows(40), [(i, f, None if y is None else 1 - y, k, u) for i, f, y, k, u in rows(40)]   # validation contradicts training
    net = TR.Network(5, (TR.Head("yes", "binary", "y"),), hidden=(8,))
    done = TR.fit(net, spark.createDataFrame(train, SCHEMA), "key", spark.createDataFrame(val, SCHEMA), epochs=9, batches=2, rate=0.05, patience=2)
    losses = [r["val_loss"] for r in done.rows]
    assert done.stopped == len(losses) < 9 and done.best == int(np.argmin(losses)) + 1 == done.stopped - 2
    kept, _, row = TR.load_epoch(spark, done.path, net, done.best)
    assert all((kept[n] == done.weights[n]).all() for n in kept) and row["val_loss"] == min(losses)


def test_null_and_empty_rows(spark):
    data = [(1, None, 1, None, None), (None, [1.0] * 5, 0, 2, 0.9), (2, [0.0] * 5, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    done = TR.fit(NET, df, "key", df, epochs=1, batches=2)
    out = {r["key"]: r for r in done.predict(df, ["key"]).collect()}
    assert len(out) == 3 and abs(sum(out[None]["kind"]) - 1) < 1e-12 and done.evaluate(df)["kind"]["n"] == 1
    assert np.isfinite(done.weights["w0"]).all() and done.weights["b_kind"].any() and done.weights["b_part"].any()
    none = TR.fit(NET, df.limit(0), "key", df.limit(0), epochs=2, batches=2)
    assert none.rows[0]["loss"] is None and all((none.weights[n] == w).all() for n, w in NET.start().items())
    assert none.predict(df.limit(0), ["key"]).count() == 0 and none.history(spark).count() == 2


def test_sparse_equals_dense(spark):
    rng = np.random.default_rng(4)
    idx = [sorted(set(rng.integers(0, 6, 3).tolist())) for _ in range(30)]
    net = [TR.Network(6, (TR.Head("yes", "binary", "y"),), hidden=(3,), sparse=s) for s in (True, False)]
    sparse = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(idx)], "key long, features array<int>, y int")
    dense = sparse.withColumn("features", F.transform(F.sequence(F.lit(0), F.lit(5)), lambda j: F.array_contains("features", j).cast("double")))
    a, b = (TR.fit(n, d, "key", epochs=2, batches=1) for n, d in zip(net, (sparse, dense), strict=True))
    assert all(np.allclose(a.weights[n], b.weights[n]) for n in a.weights)


def test_unknown_optimizer(spark):
    with pytest.raises(ValueError):
        TR.fit(NET, spark.createDataFrame(rows(3), SCHEMA), "key", optimizer="adam")


def test_mllib_estimators_fit_and_are_stored(spark):
    from pyspark.ml.classification import LogisticRegressionModel

    from kiln.operators import models as MD
    from kiln.session import scratch_path
    from kiln.sources import sinks as SK
    df = spark.createDataFrame([(i, [float(i % 2), float(i % 3)], i % 2) for i in range(60)], "id int, v array<double>, label int")
    x = MD.training_table(MD.assemble(df, ["v"]))
    model = MD.fit_logistic(x, "label")
    path = scratch_path(spark, "mllib")
    SK.save_model(model, path)
    again = MD.probabilities(SK.load_model(LogisticRegressionModel, path), x, ["id", "label"])
    assert again.where("class = label AND prob > 0.9").count() == 60
    assert MD.fit_mlp(x, "label", [2, 3, 2], max_iter=60).transform(x).where("prediction = label").count() == 60
    x.unpersist()


def test_line_without_rows(spark):
    from kiln.operators import models as MD
    none = spark.createDataFrame([(None, 1.0, 1)], "a double, b double, y int")
    rows = MD.linear_gd(none, ["a", "b"], "y", steps=2).collect()
    assert [tuple(r) for r in rows] == [(1, None, 0.0, 0.0, 0.0), (2, None, 0.0, 0.0, 0.0)]
    g = MD.gram_sums(none, ["a", "b"], "y")
    assert MD.decision_boundary(spark, [1.0, 2.0], 0.0, g.low[0], g.high[0]).count() == 0
    assert MD.decision_boundary(spark, [1.0, 0.0], 0.0, 0.0, 1.0, 3).where("y IS NULL").count() == 3
