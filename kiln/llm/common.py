"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import scratch_path

#: ASCII white space, the separator of "words" in the quality rules and the shingle join.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage with a table
    that survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of few rows, so that what a task makes of one at a time stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def whole_row(df: DataFrame, name: str = "_row") -> Column:
    """All columns of ``df`` as one struct, so that no later name can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpack(df: DataFrame, results: list[str], row: str = "_row", only: list[str] | None = None) -> DataFrame:
    """The carried columns followed by the result columns; a result replaces a carried column
    of the same name."""
    carried = only if only is not None else df.schema[row].dataType.fieldNames()
    return df.select(*[F.col(row).getField(c).alias(c) for c in carried if c not in results],
                     *[F.col(f"`{c}`") for c in results])


def broadcast_if_small(df: DataFrame, most: int) -> DataFrame:
    """Broadcast a stored table of at most ``most`` rows; a longer one is left to a shuffle join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
