"""Losses, metrics and training-history operators as aggregates and small windows.

Row-level work is one aggregate (partial on every task); windows only run over per-epoch or
per-batch summaries, whose size is the number of epochs/batches, not the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-7


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------------------ column terms

def clip_prob(p: Column | str, eps: float = EPS) -> Column:
    return F.least(F.greatest(_c(p).cast("double"), F.lit(eps)), F.lit(1.0 - eps))


def bce_term(p: Column | str, y: Column | str, eps: float = EPS) -> Column:
    q = clip_prob(p, eps)
    yy = _c(y).cast("double")
    return -(yy * F.log(q) + (F.lit(1.0) - yy) * F.log(F.lit(1.0) - q))


def scce_term(probs: Column | str, label: Column | str, eps: float = EPS) -> Column:
    """-ln p[label] for an integer target."""
    return -F.log(clip_prob(F.element_at(_c(probs), _c(label).cast("int") + 1), eps))


def cce_term(probs: Column | str, onehot: Column | str, eps: float = EPS) -> Column:
    """-Σ_k y_k ln p_k for a one-hot target."""
    return -F.aggregate(F.zip_with(_c(onehot), _c(probs), lambda y, p: y.cast("double") * F.log(clip_prob(p, eps))),
                        F.lit(0.0), lambda acc, v: acc + v)


def onehot_sq_error(probs: Column | str, label: Column | str) -> Column:
    """Σ_k (onehot_k - p_k)² for one row."""
    lab = _c(label).cast("int")
    return F.aggregate(F.transform(_c(probs), lambda p, i: F.pow(F.when(i == lab, F.lit(1.0)).otherwise(F.lit(0.0))
                                                                    - p.cast("double"), 2)),
                       F.lit(0.0), lambda acc, v: acc + v)


# ------------------------------------------------------------------------------ aggregates

def accuracy(df: DataFrame, pred: str, label: str, by: list[str] | None = None) -> DataFrame:
    a = F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy")
    return df.groupBy(*by).agg(a) if by else df.agg(a)


def mse(df: DataFrame, pred: Column | str, target: Column | str) -> DataFrame:
    return df.agg(F.avg(F.pow(_c(pred).cast("double") - _c(target).cast("double"), 2)).alias("mse"))


def mae(df: DataFrame, pred: Column | str, target: Column | str) -> DataFrame:
    return df.agg(F.avg(F.abs(_c(pred).cast("double") - _c(target).cast("double"))).alias("mae"))


def rmse_onehot(df: DataFrame, probs: str, label: str) -> DataFrame:
    """sqrt(Σ over rows and classes (onehot - p)² / rows) – divided by rows, not rows × classes."""
    return df.agg(F.sqrt(F.sum(onehot_sq_error(probs, label)) / F.count(F.lit(1))).alias("rmse"))


def loss_bce(df: DataFrame, p: str, y: str) -> DataFrame:
    return df.agg(F.avg(bce_term(p, y)).alias("bce"))


def loss_scce(df: DataFrame, probs: str, label: str) -> DataFrame:
    return df.agg(F.avg(scce_term(probs, label)).alias("loss"))


def loss_cce(df: DataFrame, probs: str, onehot: Column | str) -> DataFrame:
    return df.agg(F.avg(cce_term(probs, onehot)).alias("loss"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Long-form confusion table (label, pred, count)."""
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------------------------ history

def batch_summary(df: DataFrame, epoch: str, batch: str, loss: Column | str, correct: Column | str,
                  role: str | None = None) -> DataFrame:
    """Per (role, epoch, batch): sums and counts – the only pass over the rows."""
    keys = ([role] if role else []) + [epoch, batch]
    return df.groupBy(*keys).agg(F.sum(_c(loss).cast("double")).alias("loss_sum"),
                                 F.sum(_c(correct).cast("double")).alias("correct_sum"),
                                 F.count(F.lit(1)).alias("n"))


def epoch_summary(df: DataFrame, epoch: str, loss: Column | str, correct: Column | str, role: str) -> DataFrame:
    """Per (role, epoch): sums and counts. Epoch values need no batches, so no row order either."""
    return df.groupBy(role, epoch).agg(F.sum(_c(loss).cast("double")).alias("loss_sum"),
                                       F.sum(_c(correct).cast("double")).alias("correct_sum"),
                                       F.count(F.lit(1)).alias("n"))


def running_metric(summary: DataFrame, epoch: str, batch: str, role: str | None = None,
                   chunk: int = 4096) -> DataFrame:
    """Value after every batch, reset at each epoch: a distributed prefix sum over batch summaries.

    Batch ids are dense within an epoch, so batches are cut into chunks of ``chunk`` ids: running
    sums inside a chunk (one window task per chunk) plus the totals of the earlier chunks of the
    epoch (a table ``chunk`` times smaller). A busy epoch is spread over many tasks.
    """
    part = ([role] if role else []) + [epoch]
    c = "__kiln_chunk"
    s = summary.withColumn(c, F.floor(F.col(batch) / F.lit(chunk)))
    totals = s.groupBy(*part, c).agg(F.sum("loss_sum").alias("__l"), F.sum("correct_sum").alias("__c"),
                                     F.sum("n").alias("__n"))
    w_prev = Window.partitionBy(*part).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, c, *[F.coalesce(F.sum(x).over(w_prev), F.lit(0)).alias(x + "0")
                                        for x in ("__l", "__c", "__n")])
    w = Window.partitionBy(*part, c).orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    # plain join: adaptive execution broadcasts the offsets when their measured size is small
    j = s.join(offsets, part + [c])
    n = F.sum("n").over(w) + F.col("__n0")
    return j.select(*part, batch,
                    ((F.sum("loss_sum").over(w) + F.col("__l0")) / n).alias("running_loss"),
                    ((F.sum("correct_sum").over(w) + F.col("__c0")) / n).alias("running_accuracy"))


def history_epoch(summary: DataFrame, epoch: str, role: str, train: str = "train", val: str = "val") -> DataFrame:
    """Loss and accuracy per epoch, train and validation side by side (``val_`` prefix)."""
    def agg(name: str, prefix: str):
        r = F.col(role) == name
        return [(F.sum(F.when(r, F.col("loss_sum"))) / F.sum(F.when(r, F.col("n")))).alias(prefix + "loss"),
                (F.sum(F.when(r, F.col("correct_sum"))) / F.sum(F.when(r, F.col("n")))).alias(prefix + "accuracy")]
    return summary.groupBy(epoch).agg(*agg(train, ""), *agg(val, "val_"))


def _rank_value(monitor: str, mode: str) -> Column:
    """The monitored value with its sign turned so that lower is always better."""
    if mode not in ("min", "max"):
        raise ValueError(f"mode must be 'min' or 'max', not {mode!r}")
    return F.col(monitor) if mode == "min" else -F.col(monitor)


def early_stop(history: DataFrame, epoch: str, monitor: str = "val_loss", patience: int = 2,
               mode: str = "min") -> DataFrame:
    """Epoch at which training stops: the first epoch with ``patience`` epochs without improvement
    (lower is better, or higher with ``mode='max'``, e.g. for an accuracy); null when it never
    triggers. Also the best epoch and value. Ties on the monitored value keep the earlier epoch."""
    flagged = _since_best(history, epoch, monitor, mode)
    best = F.min(monitor) if mode == "min" else F.max(monitor)
    return flagged.agg(
        F.min(F.when(F.col("epochs_since_best") >= patience, F.col(epoch))).alias("stop_epoch"),
        F.min_by(epoch, F.struct(_rank_value(monitor, mode), F.col(epoch))).alias("best_epoch"),
        best.alias("best_value"))


def _since_best(history: DataFrame, epoch: str, monitor: str, mode: str = "min") -> DataFrame:
    """Adds improved (strictly better than every earlier value) and epochs_since_best."""
    value = _rank_value(monitor, mode)
    w_prev = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    h = history.withColumn("prev_best", F.min(value).over(w_prev))
    h = h.withColumn("improved", F.col("prev_best").isNull() | (value < F.col("prev_best")))
    w_all = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("last_best", F.max(F.when(F.col("improved"), F.col(epoch))).over(w_all))
    return h.withColumn("epochs_since_best", (F.col(epoch) - F.col("last_best")).cast("int"))


def best_checkpoint(history: DataFrame, epoch: str, monitor: str = "val_loss", mode: str = "min") -> DataFrame:
    """Epochs at which the monitored value improves (a checkpoint is saved), and which is best."""
    h = _since_best(history, epoch, monitor, mode).where("improved")
    w = Window.orderBy(_rank_value(monitor, mode), F.col(epoch))
    return h.select(epoch, monitor, (F.row_number().over(w) == 1).alias("is_best"))


def lr_plateau(history: DataFrame, epoch: str, monitor: str = "val_loss", lr0: float = 0.01,
               factor: float = 0.5, patience: int = 2, mode: str = "min") -> DataFrame:
    """Reduce the rate on plateau: every ``patience`` epochs without improvement multiply by
    ``factor``. ``lr_next`` is the rate for the following epoch."""
    h = _since_best(history, epoch, monitor, mode)
    reduce_now = ((F.col("epochs_since_best") > 0) & (F.col("epochs_since_best") % patience == 0)).cast("int")
    w_all = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("reductions", F.sum(reduce_now).over(w_all))
    return h.select(epoch, monitor, "epochs_since_best",
                    (F.lit(lr0) * F.pow(F.lit(factor), F.col("reductions"))).alias("lr_next"))


def overfit_gap(history: DataFrame, epoch: str) -> DataFrame:
    """Train minus validation accuracy per epoch; flags the epoch of lowest validation loss."""
    w = Window.orderBy(F.col("val_loss"), F.col(epoch))
    return history.select(epoch, (F.col("accuracy") - F.col("val_accuracy")).alias("accuracy_gap"),
                          (F.col("val_loss") - F.col("loss")).alias("loss_gap"),
                          (F.row_number().over(w) == 1).alias("lowest_val_loss"))


def error_reduction(err_a: Column, err_b: Column) -> Column:
    """Relative drop of the error rate from model a to model b."""
    return (err_a - err_b) / err_a


# ------------------------------------------------------------------------------ user metrics

@dataclass(frozen=True)
class UserMetric:
    """A custom metric: state (aggregate columns), result (expression over the state).

    ``update`` is the per-row contribution; the state is summed (reset = a new group), so a metric
    runs on any grouping – per batch, per epoch or over everything – as one aggregate.
    """
    name: str
    state: dict[str, Callable[[], Column]]
    result: Callable[[dict[str, Column]], Column]

    def evaluate(self, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        aggs = [F.sum(fn()).alias(k) for k, fn in self.state.items()]
        g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        return g.select(*(by or []), self.result({k: F.col(k) for k in self.state}).alias(self.name))


@dataclass(frozen=True)
class MergeableMetric:
    """A user metric whose state is any array of numbers, merged by any associative rule.

    ``init()`` gives an empty state, ``update(state, columns)`` adds a batch of rows (NumPy arrays by
    column), ``merge(a, b)`` joins two states and ``result(state)`` is the value (None: no value). Every
    task folds its rows into one state per group; the states of a group are merged ``fan`` at a time, so
    a group may be spread over any number of tasks. Columns reach ``update`` without rows that are null
    in any of them.
    """
    name: str
    columns: list[str]
    init: Callable[[], np.ndarray]
    update: Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray]
    merge: Callable[[np.ndarray, np.ndarray], np.ndarray]
    result: Callable[[np.ndarray], float | None]
    fan: int = 64

    def _partial(self, by: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            states: dict[tuple, np.ndarray] = {}
            for batch in batches:
                frame = batch.to_pandas()
                groups = frame.groupby(by, dropna=False, sort=False) if by else [((), frame)]
                for key, rows in groups:
                    key = tuple(None if isinstance(v, float) and v != v else v for v in (key if isinstance(key, tuple) else (key,)))
                    states[key] = self.update(states.get(key, self.init()), {c: rows[c].to_numpy() for c in self.columns})
            if states:
                part = TaskContext.get().partitionId()
                fields = [pa.array([k[i] for k in states], batch.schema.field(c).type) for i, c in enumerate(by)]
                bodies = pa.array([np.asarray(s, np.float64).tobytes() for s in states.values()], pa.binary())
                yield pa.RecordBatch.from_arrays([*fields, pa.array([part] * len(states), pa.int64()), bodies], names=[*by, "__part", "__state"])
        return run

    def states(self, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        """(by..., __state): one merged state per group. States can be stored and merged later."""
        by = by or []
        rows = df.select(*by, *self.columns).where(reduce(lambda a, c: a & F.col(c).isNotNull(), self.columns, F.lit(True)))
        tasks = rows.rdd.getNumPartitions()
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*by).schema] if by else []
        parts = rows.mapInArrow(self._partial(by), ", ".join([*fields, "__part long", "__state binary"]))
        while tasks > self.fan:
            parts = self.merged(parts.withColumn("__part", F.expr(f"__part div {self.fan}")), [*by, "__part"])
            tasks = -(-tasks // self.fan)
        return self.merged(parts, by)

    def merged(self, states: DataFrame, by: list[str]) -> DataFrame:
        """States merged by group: of several tables, days or tasks."""
        def join(rows: pd.DataFrame) -> pd.DataFrame:
            state = reduce(self.merge, (np.frombuffer(b) for b in rows["__state"]))
            return rows.iloc[:1][by].assign(__state=[state.tobytes()]) if by else pd.DataFrame({"__state": [state.tobytes()]})

        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in states.select(*by).schema] if by else []
        return states.groupBy(*by).applyInPandas(join, ", ".join([*fields, "__state binary"]))

    def evaluate(self, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        """(by..., name): the metric of every group that has rows."""
        result = self.result

        @F.pandas_udf("double")
        def value(states: pd.Series) -> pd.Series:
            return pd.Series([result(np.frombuffer(b)) for b in states], dtype="float64")

        return self.states(df, by).select(*(by or []), value("__state").alias(self.name))


def auc_metric(score: str, label: str, bins: int = 1000, name: str = "auc") -> MergeableMetric:
    """Area under the ROC curve of scores in [0, 1] from two histograms of ``bins`` equal buckets; rows of
    one bucket count as ties (half). Null without rows of both classes."""
    def update(state: np.ndarray, cols: dict[str, np.ndarray]) -> np.ndarray:
        at = np.clip((cols[score].astype(np.float64) * bins).astype(np.int64), 0, bins - 1) + bins * (cols[label] == 1)
        return state + np.bincount(at, minlength=2 * bins)

    def result(state: np.ndarray) -> float | None:
        neg, pos = state[:bins], state[bins:]
        pairs = pos.sum() * neg.sum()
        return float((pos * (np.cumsum(neg) - neg / 2)).sum() / pairs) if pairs else None

    return MergeableMetric(name, [score, label], lambda: np.zeros(2 * bins), update, lambda a, b: a + b, result)
