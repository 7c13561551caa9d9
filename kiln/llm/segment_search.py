"""Exact top-k inner products by multi-resolution segment statistics.

Vectors become integers, floor(scale * x). At level l a vector is cut into 2^l segments; of each the
mean m and the deviation s (over its w entries) are kept. For two vectors

    d(q, y)^2  >=  sum over segments of  w * ((m_q - m_y)^2 + (s_q - s_y)^2),

and with |q|^2 = sum w * (m_q^2 + s_q^2) that is the same as q.y <= sum w * (m_q m_y + s_q s_y), an inner
product of two short summaries. Levels run coarse to fine over the pairs that are left; survivors get
their exact integer product.

On Spark: rows are dealt to chunks of about ``CHUNK`` rows by coarse statistics (which side of the mean
each segment mean and deviation lies on), large cells are split by a hash of the row. A first threshold
of each query is its k-th score among ``SEEDS`` fixed rows, a bound that holds for any choice of them. A
query goes to the chunks whose envelope of statistics can reach its threshold, and only there: one
shuffle brings rows and queries of a chunk together, rows first, so a task holds one chunk and streams
the queries past it. Each chunk returns at most k rows of a query, and a window keeps the k best.
Nothing but the seeds and the column means of the statistics reaches the driver.

Defined results: vectors that are null or hold null or non-finite entries take no part; scaled entries
saturate at +-2^62 and scores at the range of a long; vectors are compared with those of their own length
only; a null id is no query, and as a candidate it ranks after equal scores with an id; repeated rows are
separate candidates and, as queries, each have a result (only the very same row is left out); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import broadcast_if_small, slices, stored

CHUNK = 16_384       # rows that a task holds at a time
SEEDS = 1_024        # rows behind the first thresholds
WIDTH = 8            # coarse statistics by which chunks are made: 4 means, 4 deviations
DENSE = 0.125        # share of surviving pairs above which a level is one matrix product
PIECE = 2_048
MAX_BROADCAST_CELLS = 20_000
STATS = [f"f{i}" for i in range(WIDTH)]
INDEX = "row long, id long, y array<long>, dim int, norm double, " + ", ".join(f"{c} double" for c in STATS)
LIMIT = 2 ** 62


def scaled(vector: Column, scale: int, offset: int = 0) -> Column:
    """floor(scale * x) + offset of every entry, exact; null unless all entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT))))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda c: whole(c) + F.lit(offset).cast("long")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column whose lists all have ``dim`` entries, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def levels(dim: int) -> list[np.ndarray]:
    """Segment starts of every level, coarse to fine; the finest have 4 entries or a few more."""
    out = [np.zeros(1, np.int64)]
    while dim >= 8 * len(out[-1]):
        n = 2 * len(out[-1])
        out.append(np.arange(n, dtype=np.int64) * dim // n)
    return out


def summary(y: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of sqrt(w) * mean of each segment, then sqrt(w) * deviation of each segment."""
    if not y.shape[1]:
        return np.zeros((len(y), 2))
    y = y.astype(np.float64)
    w = np.diff(np.append(starts, y.shape[1]))
    mean = np.add.reduceat(y, starts, axis=1) / w
    dev = np.sqrt(np.add.reduceat((y - np.repeat(mean, w, axis=1)) ** 2, starts, axis=1))
    return np.hstack([mean * np.sqrt(w), dev])


def exact_products(q: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer products of all rows of ``q`` and ``y``, exact: in doubles where they must be whole."""
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(y.astype(np.float64)).max(initial=0))
    if top * max(q.shape[1], 1) < 2.0 ** 52:
        return (q.astype(np.float64) @ y.T.astype(np.float64)).astype(np.int64)
    return q.astype(object) @ y.T.astype(object) if q.shape[1] else np.zeros((len(q), len(y)), np.int64)


class Piece:
    """Some rows of a chunk with the summaries of every level."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, nulls: np.ndarray, y: np.ndarray):
        self.rows, self.ids, self.nulls, self.y = rows, ids, nulls, y
        self.levels = [summary(y, s) for s in levels(y.shape[1])]
        self.norm = float(np.linalg.norm(y.astype(np.float64), axis=1).max(initial=0))

    def survivors(self, q: np.ndarray, sums: list[np.ndarray], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) whose bound reaches the query's threshold at every level."""
        slack = 1e-9 * self.norm * np.linalg.norm(q.astype(np.float64), axis=1) + 1e-3
        least = least - slack
        i = j = None
        for a, b in zip(sums, self.levels, strict=True):
            if i is None or len(i) > DENSE * len(q) * len(self.y):
                keep = a @ b.T >= least[:, None]
                if i is not None:
                    alive = np.zeros_like(keep)
                    alive[i, j] = True
                    keep &= alive
                i, j = np.nonzero(keep)
            else:
                keep = np.concatenate([np.einsum("ij,ij->i", a[i[k:k + 65536]], b[j[k:k + 65536]]) >= least[i[k:k + 65536]]
                                       for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
                i, j = i[keep], j[keep]
        return i, j

    def products(self, q: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if len(i) > DENSE * len(q) * len(self.y):
            return exact_products(q, self.y)[i, j]
        top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(self.y.astype(np.float64)).max(initial=0))
        kind = np.int64 if top * max(q.shape[1], 1) < 2.0 ** 62 else object
        out = [(q[i[k:k + 65536]].astype(kind) * self.y[j[k:k + 65536]].astype(kind)).sum(axis=1) for k in range(0, len(i), 65536)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def best_of(query: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best entries of every query: score falling, then id, then row."""
    order = np.lexsort((rows, ids, null, ~score, query))       # ~ falls like -, without overflow
    q = query[order]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[place < k]


def search(pieces: list[Piece], own: np.ndarray, q: np.ndarray, least: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """The k best rows of the pieces for each query (``own``: its row), of those that reach ``least``."""
    sums = [summary(q, s) for s in levels(q.shape[1])]
    least = least.copy()
    found = {"query": np.zeros(0, np.int64), "score": np.zeros(0, np.int64), "null": np.zeros(0, bool),
             "ids": np.zeros(0, np.int64), "rows": np.zeros(0, np.int64)}
    for p in pieces:
        i, j = p.survivors(q, sums, least)
        other = p.rows[j] != own[i]
        i, j = i[other], j[other]
        score = np.clip(p.products(q, i, j), -2 ** 63, 2 ** 63 - 1).astype(np.int64)
        more = {"query": i, "score": score, "null": p.nulls[j], "ids": p.ids[j], "rows": p.rows[j]}
        found = {c: np.concatenate([found[c], more[c]]) for c in found}
        top = best_of(**found, k=k)
        found = {c: v[top] for c, v in found.items()}
        full = np.flatnonzero(np.bincount(found["query"], minlength=len(q)) >= k)
        ends = np.searchsorted(found["query"], full, side="right") - 1
        least[full] = np.maximum(least[full], found["score"][ends].astype(np.float64))
    return found


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, y) -> the same with length, norm and coarse statistics."""
    for batch in slices(batches, PIECE):
        y = batch.column("y")
        dims = pc.list_value_length(y).to_numpy()
        stats = np.zeros((len(dims), WIDTH))
        norm = np.zeros(len(dims))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            m = matrix(y.take(pa.array(at)), dim)
            starts = levels(dim)
            s = summary(m, starts[min(2, len(starts) - 1)])
            half = s.shape[1] // 2
            stats[at, :half], stats[at, WIDTH // 2:WIDTH // 2 + half] = s[:, :half], s[:, half:]
            norm[at] = np.linalg.norm(m.astype(np.float64), axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), y, pa.array(dims.astype(np.int32)), pa.array(norm),
             *[pa.array(stats[:, i]) for i in range(WIDTH)]], names=["row", "id", "y", "dim", "norm", *STATS])


def _first_thresholds(seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, PIECE):
            dims, least = batch.column("dim").to_numpy(), np.full(batch.num_rows, -np.inf)
            for dim in np.unique(dims):
                rows, y = seeds.get(int(dim), (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
                at = np.flatnonzero(dims == dim)
                if len(rows) > k:
                    own = batch.column("row").to_numpy()[at]
                    s = exact_products(matrix(batch.column("y").take(pa.array(at)), dim), y).astype(np.float64)
                    s[own[:, None] == rows[None, :]] = -np.inf
                    # a score above 2^53 may be rounded up: stay below it
                    top = np.partition(s, -k, axis=1)[:, -k]
                    least[at] = np.where(np.abs(top) > 2.0 ** 52, top - np.abs(top) * 1e-12, top)
            yield batch.append_column("least", pa.array(least))
    return run


def _search_chunks(k: int):
    """Rows of whole chunks, each with its data rows before its queries -> candidates per query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, data, pieces = None, [], []
        for batch in slices(batches, PIECE):
            cols = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dim", "cell", "salt", "kind")])
            cuts = np.flatnonzero(np.concatenate(([True], (cols[:, 1:] != cols[:, :-1]).any(axis=0), [True])))
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                dim, kind = int(cols[0, i]), cols[3, i]
                if key != tuple(cols[:3, i]):
                    key, data, pieces = tuple(cols[:3, i]), [], []
                part = batch.slice(i, j - i)
                rows, ids = part.column("row").to_numpy(), part.column("id")
                y = matrix(part.column("y"), dim)
                if kind == 0:
                    data.append((rows, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), y))
                    continue
                if data:
                    whole = [np.concatenate(x) for x in zip(*data, strict=True)]
                    pieces += [Piece(*[x[a:a + PIECE] for x in whole]) for a in range(0, len(whole[0]), PIECE)]
                    data = []
                for a in range(0, len(rows), 512):
                    at = slice(a, a + 512)
                    f = search(pieces, rows[at], y[at], part.column("least").to_numpy()[at], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[at][f["query"]]), ids.take(pa.array(f["query"] + a)), pa.array(f["score"]), pa.array(f["ids"], mask=f["null"]),
                         pa.array(f["rows"])], names=["query_row", "query_id", "score", "vec_id", "row"])
    return run


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest integer inner product for every row
    whose id satisfies ``is_query`` (an expression over the column ``id``)."""
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("y"))
    rows = rows.filter("y IS NOT NULL")
    index = stored(rows.mapInArrow(_indexed, INDEX), "segment-index")
    total, *means = index.agg(F.count("*"), *[F.avg(c) for c in STATS]).first()
    bits = min(WIDTH, max(0, (max(total, 1) // CHUNK).bit_length()))
    cell = sum((F.when(F.col(STATS[i]) > F.lit(means[i] or 0.0), 1 << i).otherwise(0) for i in range(bits)), F.lit(0))
    index = index.withColumn("cell", cell)
    half = WIDTH // 2
    cells = index.groupBy("dim", "cell").agg(
        F.ceil(F.count("*") / CHUNK).cast("int").alias("salts"), F.max("norm").alias("top"),
        *[F.min(f"f{i}").alias(f"lo{i}") for i in range(half)], *[F.max(f"f{i}").alias(f"hi{i}") for i in range(WIDTH)])
    cells = broadcast_if_small(stored(cells, "segment-cells"), MAX_BROADCAST_CELLS)

    seeds: dict[int, list] = {}
    for r in index.select("row", "dim", "y").orderBy(F.xxhash64("row"), "row").limit(SEEDS).collect():
        seeds.setdefault(r["dim"], []).append((r["row"], r["y"]))
    seeds = {d: (np.array([r for r, _ in s], np.int64), np.array([y for _, y in s], np.int64).reshape(len(s), d)) for d, s in seeds.items()}
    queries = index.filter(is_query).drop("cell")
    queries = stored(queries.mapInArrow(_first_thresholds(seeds, k), INDEX + ", least double"), "segment-queries")

    bound = sum((F.greatest(F.col(f"f{i}") * F.col(f"lo{i}"), F.col(f"f{i}") * F.col(f"hi{i}")) for i in range(half)), F.lit(0.0))
    bound = sum((F.col(f"f{i}") * F.col(f"hi{i}") for i in range(half, WIDTH)), bound) + F.lit(1e-9) * F.col("norm") * F.col("top") + F.lit(1e-3)
    routed = queries.join(cells, "dim").filter(bound >= F.col("least"))
    routed = routed.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(1).alias("kind"), "row", "id", "y", "least")
    data = index.join(cells.select("dim", "cell", "salts"), ["dim", "cell"])
    data = data.select("dim", "cell", F.pmod(F.xxhash64("row"), "salts").cast("int").alias("salt"), F.lit(0).alias("kind"), "row", "id", "y",
                       F.lit(None).cast("double").alias("least"))
    both = data.unionByName(routed).repartition("dim", "cell", "salt").sortWithinPartitions("dim", "cell", "salt", "kind")
    found = both.mapInArrow(_search_chunks(k), "query_row long, query_id long, score long, vec_id long, row long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
