"""A regression line per key that improves with every arriving point.

State per key: the sums of its points so far and the line's slope and intercept. Each arrival adds its
point and takes one step of gradient descent on the mean squared error over all points so far, which the
sums give without the points. The state is eight numbers a key, kept by Spark's state store with the
query's checkpoint, so a restarted query goes on where it stopped and replays a lost batch from the same
state. Arrivals of one micro-batch are taken in the order of (event time, id); ``files_per_trigger``
bounds how many of a key one task sorts.

Defined results: points with a null or non-finite coordinate, or without a time, are no arrivals; a null
key is a key of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kiln.streaming.twins import _publish, event_time, file_stream

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "n double, sx double, sy double, sxx double, sxy double, slope double, intercept double"


def descend(state: tuple[float, ...], x: np.ndarray, y: np.ndarray, rate: float) -> tuple[float, ...]:
    """The state after some arrivals: (n, sx, sy, sxx, sxy, slope, intercept)."""
    n, sx, sy, sxx, sxy, m, b = state
    for u, v in zip(x.tolist(), y.tolist(), strict=True):
        n, sx, sy, sxx, sxy = n + 1, sx + u, sy + v, sxx + u * u, sxy + u * v
        m, b = m - rate * (2 * (m * sxx + b * sx - sxy) / n), b - rate * (2 * (m * sx + b * n - sy) / n)
    return n, sx, sy, sxx, sxy, m, b


class OnlineLine(StatefulProcessor):
    """Carries each key's line through the micro-batches."""

    def __init__(self, rate: float, start: tuple[float, float]):
        self.rate, self.start = rate, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("line", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        arrivals = pd.concat(list(rows)).sort_values(["t", "id"], kind="stable")
        before = tuple(self.state.get()) if self.state.exists() else (0.0, 0.0, 0.0, 0.0, 0.0, *self.start)
        after = descend(before, arrivals["x"].to_numpy(), arrivals["y"].to_numpy(), self.rate)
        self.state.update(after)
        yield pd.DataFrame({"key": [key[0]], "n": [int(after[0])], "slope": [after[5]], "intercept": [after[6]]})

    def close(self) -> None:
        pass


def stream_online_regression(spark: SparkSession, folder: str, glob: str, schema, ts: str, key: str, row_id: str, x: Column, y: Column,
                             rate: float = 0.2, start: tuple[float, float] = (0.0, 0.0), files_per_trigger: int = 1000,
                             paths: tuple[str, str] | None = None) -> DataFrame:
    """(key, n, slope, intercept) of every key after the available input. ``x``, ``y``: expressions over
    the source's columns and ``__et``, its event time. ``paths`` (output, checkpoint) continue an earlier run."""
    src = file_stream(spark, folder, glob, schema, files_per_trigger).withColumn("__et", event_time(ts, spark))
    points = src.select(F.col(key).cast("string").alias("key"), F.unix_micros("__et").alias("t"), F.col(row_id).cast("long").alias("id"),
                        x.cast("double").alias("x"), y.cast("double").alias("y"))
    fine = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    points = points.where(fine("x") & fine("y") & F.col("t").isNotNull())
    lines = points.groupBy("key").transformWithStateInPandas(OnlineLine(rate, start), "key string, n long, slope double, intercept double", "Update", "None")
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)               # the state store that arbitrary state needs
    try:
        return _publish(lines, "online-lines", keys=["key"], mode="update", paths=paths)
    finally:
        spark.conf.set(STORE, before)


def replay(df: DataFrame, key: str, t: Column, row_id: str, x: Column, y: Column, rate: float = 0.2,
           start: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """The same lines from a table whose rows are taken in the order of (t, id), as a batch job."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["t", "id"], kind="stable")
        s = descend((0.0, 0.0, 0.0, 0.0, 0.0, *start), rows["x"].to_numpy(), rows["y"].to_numpy(), rate)
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "n": [int(s[0])], "slope": [s[5]], "intercept": [s[6]]})

    points = df.select(F.col(key).cast("string").alias("key"), t.alias("t"), F.col(row_id).cast("long").alias("id"),
                       x.cast("double").alias("x"), y.cast("double").alias("y"))
    return points.groupBy("key").applyInPandas(run, "key string, n long, slope double, intercept double")
