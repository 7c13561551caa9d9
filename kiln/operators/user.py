"""The user-function surface: escapes for code that SQL expressions cannot state.

* :func:`row_parse` – a user function over pandas batches that may emit any number of rows per
  input row (``mapInPandas``: Arrow batches, runs inside each partition, no shuffle).
* :func:`elementwise` – a vectorised pandas function with declared output type (``pandas_udf``).
* :func:`route` – user routing of rows to N outputs: one routing column, then filters.
* :class:`Callback` / :func:`run_callbacks` – hooks evaluated over the training-history table.

Prefer built-in column expressions (``kiln.functions``); these are for the remainder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_parse(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of every partition; ``fn`` returns rows of ``schema``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def elementwise(fn: Callable[[pd.Series], pd.Series | pd.DataFrame], return_type: T.DataType | str):
    """Wrap a vectorised function (Series in → Series, or DataFrame for a struct type, out)."""
    return F.pandas_udf(fn, return_type)


def write_routed(df: DataFrame, fn: Callable[[dict[str, Column]], Column], path: str, route_col: str = "route") -> None:
    """Write every row below ``path`` by its route (one folder per output) in one pass over the rows."""
    tagged = df.withColumn(route_col, fn({c: F.col(f"`{c}`") for c in df.columns}).cast("int"))
    tagged.write.mode("overwrite").partitionBy(route_col).parquet(path)


def route(df: DataFrame, fn: Callable[[dict[str, Column]], Column], n: int,
          route_col: str = "route") -> dict[int, DataFrame]:
    """Tag each row with ``fn(columns)`` in [0, n) and return one filtered frame per output. Each frame
    reads the input when used; to store all outputs use :func:`write_routed`, which reads it once."""
    tagged = df.withColumn(route_col, fn({c: F.col(f"`{c}`") for c in df.columns}).cast("int"))
    return {i: tagged.where(F.col(route_col) == i) for i in range(n)}


#: Hooks of a callback, with the table each one sees: one row per epoch (history) or per batch.
HOOKS = {"on_train_begin": "history", "on_epoch_begin": "history", "on_batch_begin": "batches",
         "on_batch_end": "batches", "on_epoch_end": "history", "on_train_end": "history"}


class Callback:
    """Override any hook: table → rows (epoch, value), or None for nothing to report.

    A hook is called once with the whole table, not once per epoch or batch: what it returns for each
    row is what a call at that time would report. Begin hooks should read only the keys of their row
    (and earlier rows); the metrics of a row exist at its end.
    """
    name = "callback"

    def on_train_begin(self, history: DataFrame) -> DataFrame | None:
        return None

    def on_epoch_begin(self, history: DataFrame) -> DataFrame | None:
        return None

    def on_batch_begin(self, batches: DataFrame) -> DataFrame | None:
        return None

    def on_batch_end(self, batches: DataFrame) -> DataFrame | None:
        return None

    def on_epoch_end(self, history: DataFrame) -> DataFrame | None:
        return None

    def on_train_end(self, history: DataFrame) -> DataFrame | None:
        return None


def run_callbacks(history: DataFrame, callbacks: list[Callback], batches: DataFrame | None = None) -> DataFrame:
    """All hooks' rows as (epoch, callback, value); batch hooks run when ``batches`` is given."""
    tables = {"history": history, "batches": batches}
    outs = [(cb, getattr(cb, hook)(tables[seen])) for cb in callbacks for hook, seen in HOOKS.items() if tables[seen] is not None]
    outs = [o.select(F.col("epoch").cast("bigint"), F.lit(cb.name).alias("callback"), F.col("value").cast("double"))
            for cb, o in outs if o is not None]
    if not outs:
        return history.sparkSession.createDataFrame([], "epoch bigint, callback string, value double")
    result = outs[0]
    for o in outs[1:]:
        result = result.unionByName(o)
    return result
