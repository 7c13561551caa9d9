"""Epoch-wise mini-batch training of dense networks, data-parallel, with a history.

A :class:`Network` has any number of hidden relu layers that all outputs share, and one or more
outputs (:class:`Head`): ``binary`` (sigmoid, cross-entropy), ``classes`` (softmax, cross-entropy) and
``unit`` (sigmoid, squared error: a regressed value in [0, 1]). The loss is the sum of the outputs'
means, each over the rows that have its label.

Rows are dealt to ``batches`` mini-batches by a hash of their key and stored once, one folder per batch,
so an epoch reads each row once; the order of the batches is shuffled per epoch. A step is one job: every
task adds up the gradients of its rows in NumPy, the sums are combined ``FAN`` at a time until at most
``FAN`` are left, and the driver adds these and updates the weights. Nothing but sums of the size of the
model leaves a task, and a lost executor costs its tasks of one step.

After each epoch the validation rows are scored, the epoch goes to the history (loss and accuracy as the
mean over the epoch's batches before their updates, and ``val_`` values), weights and optimizer state are
written to the shared folder, and early stopping is decided. ``resume`` continues from the last epoch stored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators.position import hash_int
from kiln.session import scratch_path

FAN = 32             # gradient sums that are combined at a time
ROWS = 64            # rows per matrix product
CLIP = 1e-7          # probabilities are kept this far from 0 and 1 in a loss
RHO, EPSILON = 0.9, 1e-7


@dataclass(frozen=True)
class Head:
    """An output: its name, kind, label column and number of classes."""
    name: str
    kind: str
    label: str
    size: int = 1


@dataclass(frozen=True)
class Network:
    """``dim`` inputs, hidden relu layers, outputs. ``sparse``: a row's features are the indices of its
    ones (an array of integers) instead of ``dim`` values."""
    dim: int
    heads: tuple[Head, ...]
    hidden: tuple[int, ...] = (16,)
    sparse: bool = False
    seed: int = 42

    def shapes(self) -> dict[str, tuple[int, ...]]:
        sizes, out = (self.dim, *self.hidden), {}
        for i, (a, b) in enumerate(zip(sizes[:-1], sizes[1:], strict=True)):
            out |= {f"w{i}": (a, b), f"b{i}": (b,)}
        for h in self.heads:
            out |= {f"w_{h.name}": (sizes[-1], h.size), f"b_{h.name}": (h.size,)}
        return out

    def start(self) -> dict[str, np.ndarray]:
        """First weights: uniform within sqrt(6 / (inputs + outputs)) by a formula any engine can repeat."""
        out = {}
        for layer, (name, shape) in enumerate(self.shapes().items()):
            if len(shape) == 1:
                out[name] = np.zeros(shape)
                continue
            i, k = np.meshgrid(np.arange(shape[0]), np.arange(shape[1]), indexing="ij")
            draw = (i * 7919 + k * 104729 + layer * 1299709 + self.seed * 15485863) % 1000003 / 1000003 - 0.5
            out[name] = draw * (2 * math.sqrt(6 / (shape[0] + shape[1])))
        return out


def batch_order(epoch: int, batches: int, seed: int) -> list[int]:
    """The order of the batches in an epoch, by hash."""
    return sorted(range(batches), key=lambda b: hashlib.md5(f"{epoch}:{b}:{seed}".encode()).hexdigest())


# ------------------------------------------------------------------------------ inside tasks

def _inputs(net: Network, column: pa.Array) -> np.ndarray:
    """Rows of features as a matrix; null is a row of zeros, indices outside the inputs are ignored."""
    x = np.zeros((len(column), net.dim))
    for r, v in enumerate(column):
        if v.is_valid:
            v = v.values.to_numpy(zero_copy_only=False)
            if net.sparse:
                x[r, v[(v >= 0) & (v < net.dim)].astype(np.int64)] = 1.0
            else:
                x[r] = v
    return x


def _forward(net: Network, weights: dict[str, np.ndarray], x: np.ndarray) -> tuple[list[np.ndarray], dict[str, np.ndarray]]:
    """Inputs of every layer, and the outputs."""
    layers = [x]
    for i in range(len(net.hidden)):
        layers.append(np.maximum(layers[-1] @ weights[f"w{i}"] + weights[f"b{i}"], 0.0))
    out = {}
    for h in net.heads:
        z = layers[-1] @ weights[f"w_{h.name}"] + weights[f"b_{h.name}"]
        if h.kind == "classes":
            e = np.exp(z - z.max(axis=1, keepdims=True))
            out[h.name] = e / e.sum(axis=1, keepdims=True)
        else:
            with np.errstate(over="ignore"):
                out[h.name] = 1.0 / (1.0 + np.exp(-z))
    return layers, out


def _errors(head: Head, p: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, metric (accuracy; absolute error of a regressed value) and derivative by the logits, per row."""
    if head.kind == "classes":
        hot = np.zeros_like(p)
        hot[np.arange(len(y)), y.astype(np.int64)] = 1.0
        own = np.clip(p[hot > 0], CLIP, 1 - CLIP)
        return -np.log(own), (p.argmax(axis=1) == y).astype(np.float64), p - hot
    q, y = p[:, 0], y.astype(np.float64)
    if head.kind == "binary":
        c = np.clip(q, CLIP, 1 - CLIP)
        return -(y * np.log(c) + (1 - y) * np.log(1 - c)), ((q > 0.5) == (y > 0.5)).astype(np.float64), (q - y)[:, None]
    return (q - y) ** 2, np.abs(q - y), (2 * (q - y) * q * (1 - q))[:, None]


def _names(net: Network, head: Head) -> list[str]:
    return [n for n in net.shapes() if n[0] in "wb" and (n[1:].isdigit() or n[2:] == head.name)]


def _sums(net: Network, weights: dict[str, np.ndarray], gradients: bool):
    """Rows -> one row (part, body): per output its count, loss and metric sums and, for each weight,
    the sum of the derivatives of that output's loss."""
    names = {h.name: _names(net, h) for h in net.heads}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {h.name: np.zeros(3) for h in net.heads}
        grads = {h.name: {n: np.zeros_like(weights[n]) for n in names[h.name]} for h in net.heads} if gradients else {}
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                layers, out = _forward(net, weights, _inputs(net, part.column("features")))
                for h in net.heads:
                    label = part.column(h.label)
                    has = label.is_valid().to_numpy(zero_copy_only=False)
                    if not has.any():
                        continue
                    loss, metric, d = _errors(h, out[h.name][has], label.drop_null().to_numpy(zero_copy_only=False))
                    totals[h.name] += [has.sum(), loss.sum(), metric.sum()]
                    if not gradients:
                        continue
                    g, x = grads[h.name], [v[has] for v in layers]
                    g[f"w_{h.name}"] += x[-1].T @ d
                    g[f"b_{h.name}"] += d.sum(axis=0)
                    d = d @ weights[f"w_{h.name}"].T
                    for i in reversed(range(len(net.hidden))):
                        d = d * (x[i + 1] > 0)
                        g[f"w{i}"] += x[i].T @ d
                        g[f"b{i}"] += d.sum(axis=0)
                        d = d @ weights[f"w{i}"].T if i else d
        body = np.concatenate([np.concatenate([totals[h.name], *[grads[h.name][n].ravel() for n in names[h.name]]] if gradients else [totals[h.name]])
                               for h in net.heads])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([body.tobytes()], pa.binary())],
                                         names=["part", "body"])
    return run


def _added(rows: pa.Table) -> pa.Table:
    bodies = [np.frombuffer(b, np.float64) for b in rows.sort_by("part").column("body").to_pylist()]
    return pa.table({"part": pa.array([rows.column("part")[0].as_py() // FAN], pa.int64()), "body": pa.array([np.sum(bodies, axis=0).tobytes()], pa.binary())})


def _total(net: Network, weights: dict[str, np.ndarray], rows: DataFrame, gradients: bool, tasks: int) -> dict[str, tuple[np.ndarray, dict[str, np.ndarray]]]:
    """Per output: (count, loss sum, metric sum) and gradient sums over all rows."""
    parts = rows.mapInArrow(_sums(net, weights, gradients), "part long, body binary")
    while tasks > FAN:
        parts = parts.groupBy(F.expr(f"part div {FAN}")).applyInArrow(_added, "part long, body binary")
        tasks = -(-tasks // FAN)
    bodies = [np.frombuffer(bytes(r["body"]), np.float64) for r in sorted(parts.collect(), key=lambda r: r["part"])]
    at, out, shapes = 0, {}, net.shapes()
    body = np.sum(bodies, axis=0) if bodies else np.zeros(sum(3 + sum(math.prod(shapes[n]) for n in _names(net, h)) for h in net.heads))
    for h in net.heads:
        totals, at, grads = body[at:at + 3], at + 3, {}
        for n in _names(net, h) if gradients else []:
            size = math.prod(shapes[n])
            grads[n], at = body[at:at + size].reshape(shapes[n]), at + size
        out[h.name] = (totals, grads)
    return out


# ------------------------------------------------------------------------------ the loop

@dataclass
class Fit:
    """A trained network: its weights, the history rows and where the epochs' weights are."""
    net: Network
    weights: dict[str, np.ndarray]
    rows: list[dict] = field(default_factory=list)
    path: str | None = None
    stopped: int | None = None     # the epoch after which training stopped early
    best: int | None = None        # the epoch whose weights these are

    def history(self, spark: SparkSession) -> DataFrame:
        """(epoch, loss, val_loss, and per output its loss, metric and their ``val_`` values)."""
        names = [f"{p}{h.name}_{m}" for h in self.net.heads for m in ("loss", "metric") for p in ("", "val_")]
        schema = "epoch int, loss double, val_loss double, " + ", ".join(f"`{n}` double" for n in names)
        return spark.createDataFrame([tuple(r[c] for c in ("epoch", "loss", "val_loss", *names)) for r in self.rows], schema)

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and per output the probability or value (classes: an array) of every row."""
        net, weights = self.net, self.weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    part = batch.slice(a, ROWS)
                    _, out = _forward(net, weights, _inputs(net, part.column("features")))
                    cols = [pa.array(list(out[h.name])) if h.kind == "classes" else pa.array(out[h.name][:, 0]) for h in net.heads]
                    yield pa.RecordBatch.from_arrays([*[part.column(k) for k in keep], *cols], names=[*keep, *[h.name for h in net.heads]])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
        schema += "".join(f", `{h.name}` " + ("array<double>" if h.kind == "classes" else "double") for h in net.heads)
        return df.select(*keep, "features").mapInArrow(run, schema)

    def evaluate(self, df: DataFrame) -> dict[str, dict[str, float | None]]:
        """Loss and metric per output."""
        rows = df.select("features", *{h.label for h in self.net.heads})
        total = _total(self.net, self.weights, rows, False, rows.rdd.getNumPartitions())
        return {name: _means(t) for name, (t, _) in total.items()}


def _means(t: np.ndarray) -> dict[str, float | None]:
    return {"n": int(t[0]), "loss": float(t[1] / t[0]) if t[0] else None, "metric": float(t[2] / t[0]) if t[0] else None}


def batch_number(key: Column | str, batches: int, seed: int) -> Column:
    return F.pmod(hash_int(key, seed), F.lit(batches)).cast("int")


def save_epoch(spark: SparkSession, path: str, epoch: int, row: dict, weights: dict, state: dict) -> None:
    tables = [(name, kind, a.ravel().tolist()) for kind, t in (("weight", weights), ("state", state)) for name, a in t.items()]
    entries = [(k, "history", [None if v is None else float(v)]) for k, v in row.items()]
    (spark.createDataFrame(tables + entries, "name string, kind string, values array<double>").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/epoch={epoch}"))


def load_epoch(spark: SparkSession, path: str, net: Network, epoch: int) -> tuple[dict, dict, dict]:
    """Weights, optimizer state and history row of a stored epoch."""
    out: dict[str, dict] = {"weight": {}, "state": {}, "history": {}}
    for r in spark.read.parquet(f"{path}/epoch={epoch}").collect():
        out[r["kind"]][r["name"]] = r["values"][0] if r["kind"] == "history" else np.array(r["values"]).reshape(net.shapes()[r["name"]])
    out["history"]["epoch"] = int(out["history"]["epoch"])
    return out["weight"], out["state"], out["history"]


def fit(net: Network, train: DataFrame, key: str, val: DataFrame | None = None, epochs: int = 5, batches: int = 4, rate: float = 0.01,
        optimizer: str = "rmsprop", patience: int | None = None, monitor: str = "val_loss", path: str | None = None, resume: bool = False) -> Fit:
    """Trains ``net`` on ``train`` (key, features, labels). ``patience``: stop after so many epochs in which
    ``monitor`` did not fall and return the best epoch's weights. ``path``: folder of the epochs' weights;
    with ``resume`` the epochs found there are not repeated. Without rows the weights stay as they start."""
    if optimizer not in ("sgd", "rmsprop"):
        raise ValueError(f"optimizer must be 'sgd' or 'rmsprop', not {optimizer!r}")
    spark = train.sparkSession
    labels = sorted({h.label for h in net.heads})
    par = spark.sparkContext.defaultParallelism
    place = scratch_path(spark, "train-batches")
    dealt = train.select("features", *labels, batch_number(key, batches, net.seed).alias("batch"), F.pmod(F.xxhash64(key), F.lit(max(1, par // batches))).alias("_s"))
    dealt.repartition("batch", "_s").drop("_s").write.partitionBy("batch").parquet(place)
    stored = spark.read.schema(dealt.drop("_s").schema).parquet(place)
    # a null key has no batch number: such rows are a part of the first batch
    steps = [stored.where((F.col("batch") == b) | (F.lit(b == 0) & F.col("batch").isNull())).drop("batch") for b in range(batches)]
    tasks = [s.rdd.getNumPartitions() for s in steps]
    checks = None
    if val is not None:
        at = scratch_path(spark, "train-val")
        val.select("features", *labels).write.parquet(at)
        checks = spark.read.parquet(at)
        val_tasks = checks.rdd.getNumPartitions()
    path = path or scratch_path(spark, "train-epochs")

    weights = net.start()
    state = {n: np.zeros_like(w) for n, w in weights.items()}
    done = Fit(net, weights, [], path)
    best: tuple[float, int, dict] | None = None
    stored_epochs = sorted(_epochs_at(spark, path)) if resume else []
    for epoch in range(1, epochs + 1):
        if epoch in stored_epochs:
            weights, state, row = load_epoch(spark, path, net, epoch)
        else:
            seen = {h.name: np.zeros(3) for h in net.heads}
            for b in batch_order(epoch, batches, net.seed):
                total = _total(net, weights, steps[b], True, tasks[b])
                grad = {n: np.zeros_like(w) for n, w in weights.items()}
                for name, (t, g) in total.items():
                    seen[name] += t
                    for n in g:
                        grad[n] += g[n] / max(t[0], 1.0)
                if optimizer == "rmsprop":
                    state = {n: RHO * s + (1 - RHO) * grad[n] ** 2 for n, s in state.items()}
                    grad = {n: g / (np.sqrt(state[n]) + EPSILON) for n, g in grad.items()}
                weights = {n: w - rate * grad[n] for n, w in weights.items()}
            row = {"epoch": epoch} | _row(net, seen, "")
            checked = _total(net, weights, checks, False, val_tasks) if checks is not None else {}
            row |= _row(net, {h.name: checked[h.name][0] if checked else np.zeros(3) for h in net.heads}, "val_")
            save_epoch(spark, path, epoch, row, weights, state)
        done.rows.append(row)
        value = row.get(monitor)
        if value is not None and (best is None or value < best[0]):
            best = (value, epoch, weights)
        if patience is not None and best is not None and epoch - best[1] >= patience:
            done.stopped = epoch
            break
    done.weights, done.best = (best[2], best[1]) if patience is not None and best else (weights, len(done.rows) or None)
    return done


def _row(net: Network, totals: dict[str, np.ndarray], prefix: str) -> dict:
    each = {h.name: _means(totals[h.name]) for h in net.heads}
    losses = [m["loss"] for m in each.values() if m["loss"] is not None]
    out: dict = {f"{prefix}loss": sum(losses) if losses else None}
    for name, m in each.items():
        out |= {f"{prefix}{name}_loss": m["loss"], f"{prefix}{name}_metric": m["metric"]}
    return out


def _epochs_at(spark: SparkSession, path: str) -> list[int]:
    """Epochs stored below ``path``, on whatever file system it is."""
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.parquet(path).where("kind = 'history' AND name = 'epoch'").select("values").collect()
    except AnalysisException:                     # nothing is stored yet
        return []
    return [int(r["values"][0]) for r in rows]
