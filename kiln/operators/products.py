"""Products of all rows of two vector tables, block by block.

All products: the right-hand rows are dealt to blocks of about ``BLOCK`` rows, packed as matrices; the
left-hand rows are packed where they lie. Every left block meets every right block through a join on the
right block's number, one matrix product each.

The k largest: the left-hand rows are dealt to groups of about ``HELD`` rows. A task holds one group and
the packed right-hand rows stream past it; each left row keeps its k best so far, whose last one is the
bound that a product of the next block must reach. So no block is sorted, k rows per left row leave a task,
and it holds one group, one batch and one block of products, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2_048
HELD = 8_192         # left-hand rows that a task holds when the k largest are wanted
LEAST_HELD = 256     # smaller groups are not worth a task


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, id, v), those of a block together -> (block, ids, dim, body) of at most BLOCK rows."""
    block, ids, rows = None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if ids:
            m = np.array(rows, np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([m.shape[1]], pa.int32()),
                                              pa.array([m.tobytes()], pa.binary())], names=["block", "ids", "dim", "body"])

    for batch in batches:
        for b, i, v in zip(*(batch.column(c).to_pylist() for c in ("block", "id", "v")), strict=True):
            if b != block or len(ids) == BLOCK or (rows and len(v) != len(rows[0])):
                yield from flush()
                block, ids, rows = b, [], []
            ids.append(i)
            rows.append(v)
    yield from flush()


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, body, dim, other, ob in zip(*(batch.column(c).to_pylist() for c in ("ids", "body", "dim", "o_ids", "o_body")), strict=True):
            a, b = np.frombuffer(body).reshape(-1, dim), np.frombuffer(ob).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids), len(b))), pa.array(np.tile(np.array(other), len(a))),
                                              pa.array((a @ b.T).ravel())], names=["a", "b", "dot"])


class _Best:
    """The k largest products so far of some left rows (ties: smaller right id; NaN is the largest)."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, k: int):
        self.ids, self.m, self.k, self.finite = ids, m, k, bool(np.isfinite(m).all())
        self.row, self.dot, self.other = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.least, self.last = np.full(len(ids), -np.inf), np.full(len(ids), np.iinfo(np.int64).max)

    def add(self, other: np.ndarray, b: np.ndarray, finite: bool) -> None:
        """Takes in the products with the right rows ``b`` of ids ``other``."""
        dots = self.m @ b.T
        if finite and self.finite:
            least = self.least
            if self.k < len(other) and np.isneginf(least).any():       # a row without k products yet: the k-th of this block
                least = np.maximum(least, np.partition(dots, -self.k, axis=1)[:, -self.k])
            row, col = np.nonzero(dots >= least[:, None])
        else:
            row, col = (x.ravel() for x in np.indices(dots.shape))
        dot, other = dots[row, col], other[col]
        better = ~(dot <= self.least[row]) | (other < self.last[row])
        if not better.any():
            return
        row, dot, other = (np.concatenate(x) for x in ((self.row, row[better]), (self.dot, dot[better]), (self.other, other[better])))
        order = np.lexsort((other, -dot, ~np.isnan(dot), row))
        row = row[order]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        size = np.diff(np.append(first, len(row)))
        keep = np.arange(len(row)) - np.repeat(first, size) < self.k
        full = size >= self.k
        ends = order[first[full] + self.k - 1]
        self.least[row[first[full]]] = np.where(np.isnan(dot[ends]), np.inf, dot[ends])
        self.last[row[first[full]]] = other[ends]
        self.row, self.dot, self.other = row[keep], dot[order[keep]], other[order[keep]]

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.row]), pa.array(self.other), pa.array(self.dot)], names=["a", "b", "dot"])


def _largest(k: int):
    """Packed rows of whole groups, the left ones (kind 0) before the right ones -> the k best of every left row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                group, dim, kind = (batch.column(c)[n].as_py() for c in ("block", "dim", "kind"))
                if key != (group, dim):
                    yield from (h.rows() for h in held)
                    key, held = (group, dim), []
                ids = batch.column("ids")[n].values.to_numpy(zero_copy_only=False)
                m = np.frombuffer(batch.column("body")[n].as_buffer()).reshape(-1, dim)
                if kind == 0:
                    held.append(_Best(ids.copy(), m.copy(), k))
                    continue
                finite = bool(np.isfinite(m).all())
                for h in held:
                    h.add(ids, m, finite)
        yield from (h.rows() for h in held)
    return run


def dot_products(left: DataFrame, left_id: str, left_vector: str, right: DataFrame, right_id: str, right_vector: str,
                 k: int | None = None) -> DataFrame:
    """(a, b, dot) for every pair of rows with vectors of one length, or with ``k`` the k largest products
    of every left row (ties: smaller right id) with their ``rank`` from 1. Null ids or vectors, and vectors
    with null entries, take no part."""
    fine = lambda df, i, v: (df.select(F.col(i).cast("long").alias("id"), F.col(v).cast("array<double>").alias("v"))
                             .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull())))
    a, b = fine(left, left_id, left_vector), fine(right, right_id, right_vector)
    schema = "block int, ids array<long>, dim int, body binary"
    if k is not None:
        rows = a.count()
        par = a.sparkSession.sparkContext.defaultParallelism
        groups = max(1, -(-rows // HELD), min(par, rows // LEAST_HELD))
        a = a.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
        a = a.repartition(groups, "block").sortWithinPartitions("block", F.size("v")).mapInArrow(_packed, schema)
        b = b.withColumn("block", F.lit(0)).sortWithinPartitions(F.size("v")).mapInArrow(_packed, schema)
        b = b.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        both = a.withColumn("kind", F.lit(0)).unionByName(b.withColumn("kind", F.lit(1)))
        both = both.repartition(groups, "block").sortWithinPartitions("block", "dim", "kind")
        w = Window.partitionBy("a").orderBy(F.desc("dot"), "b")
        out = both.mapInArrow(_largest(k), "a long, b long, dot double")
        return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    blocks = max(1, -(-b.count() // BLOCK))
    b = b.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    b = b.repartition("block").sortWithinPartitions("block", F.size("v")).mapInArrow(_packed, schema)
    a = a.withColumn("block", F.lit(0)).mapInArrow(_packed, schema)
    a = a.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = a.join(b.select("block", "dim", F.col("ids").alias("o_ids"), F.col("body").alias("o_body")), ["block", "dim"])
    return met.select("ids", "body", "dim", "o_ids", "o_body").mapInArrow(_products, "a long, b long, dot double")
