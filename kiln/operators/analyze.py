"""Analyze-then-transform: full-pass statistics on the training rows, frozen and reused.

A user function maps input columns to output columns and may call analyzers through the context
(``ctx.zscore``, ``ctx.mean``, ``ctx.impute_mean``, ``ctx.vocab``). :func:`analyze` runs it in
passes: every analyzer whose input is ready is computed in the pass – all numeric analyzers of a
pass fused into ONE aggregate, one ``groupBy`` per vocabulary – and results are frozen as literals
and small vocabulary tables. Analyzers fed by other analyzers (z-score of a mean-imputed column)
resolve in the next pass. :class:`Transform` then applies the frozen result to any split with one
projection plus a broadcast lookup per vocabulary; no new pass over the training rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.position import with_position
from kiln.session import cut_lineage

# Vocabularies up to this many rows are broadcast to the lookup; larger ones use a shuffle join.
BROADCAST_VOCAB_ROWS = 500_000
UNSEEN_ID = -1

_PENDING = "__kiln_pending_"


# Vocabularies up to this many terms are ranked with one window per vocabulary; larger ones
# use the distributed position index.
WINDOW_RANK_TERMS = 1_000_000


def _rank(counts: DataFrame, term: str, size: int) -> DataFrame:
    """ids 0.. by descending count, ties by term descending."""
    if size <= WINDOW_RANK_TERMS:
        w = Window.orderBy(F.col("count").desc(), F.col(term).desc())
        return counts.withColumn("id", (F.row_number().over(w) - 1).cast("bigint"))
    neg = "__kiln_neg"
    return with_position(counts.withColumn(neg, -F.col("count")), [neg, (term, "desc")], pos_col="id").drop(neg)


def vocab_build(df: DataFrame, col: Column | str, top_k: int | None = None, term: str = "term") -> DataFrame:
    """(term, count, id): distinct values by descending count, ties by term descending; ids from 0.

    Counting is a partial aggregate (hot terms are combined map-side). With ``top_k`` a distributed
    top-k (each task keeps k rows) bounds the table, and the k rows are ranked directly. Without a
    cap the counts are materialised once and ranked by the distributed position index when large.
    """
    c = F.col(col) if isinstance(col, str) else col
    counts = (df.select(c.alias(term)).where(F.col(term).isNotNull())
              .groupBy(term).agg(F.count(F.lit(1)).alias("count")))
    if top_k is not None:
        top = counts.orderBy(F.col("count").desc(), F.col(term).desc()).limit(int(top_k))
        return _rank(top, term, int(top_k)).select(term, "count", "id")
    counts = cut_lineage(counts)
    return _rank(counts, term, counts.count()).select(term, "count", "id")


def vocab_build_many(df: DataFrame, exprs: list[Column], top_ks: list[int | None]) -> list[tuple[DataFrame, int]]:
    """Several vocabularies from ONE pass: melt (vocab index, term), one grouped count for all,
    materialise the counts once, then rank each vocabulary. Returns (table, size) per vocabulary."""
    pairs = F.array(*[F.struct(F.lit(i).alias("v"), e.cast("string").alias("term")) for i, e in enumerate(exprs)])
    counts = cut_lineage(df.select(F.inline(pairs)).where(F.col("term").isNotNull())
                         .groupBy("v", "term").agg(F.count(F.lit(1)).alias("count")))
    sizes = {r["v"]: r["n"] for r in counts.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    small = [i for i in range(len(exprs)) if sizes.get(i, 0) <= WINDOW_RANK_TERMS]
    ranked_small = None
    if small:
        w = Window.partitionBy("v").orderBy(F.col("count").desc(), F.col("term").desc())
        ranked_small = cut_lineage(counts.where(F.col("v").isin(small))
                                   .withColumn("id", (F.row_number().over(w) - 1).cast("bigint")))
    for i, k in enumerate(top_ks):
        n = sizes.get(i, 0)
        if i in small:
            t = ranked_small.where(F.col("v") == i).select("term", "count", "id")
        else:
            t = _rank(counts.where(F.col("v") == i).select("term", "count"), "term", n).select("term", "count", "id")
        if k is not None:
            t = t.where(F.col("id") < k)
            n = min(n, k)
        out.append((t, n))
    return out


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_VOCAB_ROWS, known_rows: int | None = None) -> DataFrame:
    """Broadcast hint only after checking the size (a known bound, or a count over an already
    aggregated table)."""
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df


def vocab_apply(df: DataFrame, col: Column | str, vocab: DataFrame, out: str, default: int = UNSEEN_ID,
                term: str = "term", vocab_rows: int | None = None) -> DataFrame:
    """Term → id with a left lookup join; unseen terms get ``default``."""
    key = "__kiln_vkey"
    c = F.col(col) if isinstance(col, str) else col
    v = broadcast_if_small(vocab.select(F.col(term).alias(key), F.col("id").alias(out)), known_rows=vocab_rows)
    return (df.withColumn(key, c).join(v, key, "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(default)).cast("bigint")).drop(key))


def zscore_expr(x: Column, mean: float | None, std: float | None) -> Column:
    """(x - mean) / std with the population std; std 0 (or no data) gives 0."""
    if mean is None or not std:
        return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
    return (x.cast("double") - F.lit(mean)) / F.lit(std)


@dataclass
class _Analyzer:
    kind: str                 # 'mean' | 'zscore' | 'vocab'
    expr: Column | None = None
    top_k: int | None = None
    result: object = None     # (mean, std) | mean | vocab DataFrame
    size: int | None = None   # vocabulary rows (known after analysis)
    resolved: bool = False


@dataclass
class AnalyzeContext:
    """Handed to the user function; analyzer calls are matched across passes by call order."""
    analyzers: list[_Analyzer] = field(default_factory=list)
    _i: int = 0

    def _next(self, kind: str, expr: Column, top_k: int | None = None) -> _Analyzer:
        if self._i < len(self.analyzers):
            a = self.analyzers[self._i]
            if a.kind != kind:
                raise RuntimeError("preprocessing function must call analyzers in the same order every time")
            if not a.resolved:
                a.expr = expr
        else:
            a = _Analyzer(kind, expr, top_k)
            self.analyzers.append(a)
        self._i += 1
        return a

    def _pending(self) -> Column:
        return F.lit(f"{_PENDING}{self._i}").try_cast("double")

    def mean(self, x: Column) -> Column:
        a = self._next("mean", x)
        return F.lit(a.result).cast("double") if a.resolved else self._pending()

    def impute_mean(self, x: Column) -> Column:
        """Missing → mean of the non-missing training values."""
        return F.coalesce(x.cast("double"), self.mean(x))

    def zscore(self, x: Column) -> Column:
        a = self._next("zscore", x)
        if not a.resolved:
            return self._pending()
        mean, std = a.result
        return zscore_expr(x, mean, std)

    def vocab(self, x: Column, top_k: int | None = None) -> Column:
        """Id of the value in the training vocabulary (-1 when unseen)."""
        idx = self._i
        a = self._next("vocab", x, top_k)
        if not a.resolved:
            return self._pending().cast("bigint")
        return F.coalesce(F.col(f"__kiln_vocab_{idx}_id"), F.lit(UNSEEN_ID)).cast("bigint")


def _is_pending(c: Column | None) -> bool:
    return c is not None and _PENDING in str(c)


class Transform:
    """Frozen result of :func:`analyze`: apply it to any split with :meth:`apply`."""

    def __init__(self, fn: Callable[[dict[str, Column], AnalyzeContext], dict[str, Column]],
                 ctx: AnalyzeContext, keep: list[str]):
        self.fn, self.ctx, self.keep = fn, ctx, keep

    def apply(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Outputs of the frozen function for ``df``, plus the ``keep`` columns (default: the ones
        named at analysis)."""
        keep = self.keep if keep is None else keep
        self.ctx._i = 0
        outputs = self.fn({c: F.col(f"`{c}`") for c in df.columns}, self.ctx)
        cur = df
        for idx, a in enumerate(self.ctx.analyzers):
            if a.kind != "vocab":
                continue
            key = f"__kiln_vocab_{idx}_key"
            v = broadcast_if_small(a.result.select(F.col("term").alias(key), F.col("id").alias(f"__kiln_vocab_{idx}_id")),
                                   known_rows=a.size)
            cur = cur.withColumn(key, a.expr).join(v, key, "left")
        return cur.select(*[F.col(f"`{k}`") for k in keep], *[c.alias(name) for name, c in outputs.items()])

    def statistics(self) -> list[tuple[int, str, object]]:
        return [(i, a.kind, a.result if a.kind != "vocab" else "table") for i, a in enumerate(self.ctx.analyzers)]


def analyze(df: DataFrame, fn: Callable[[dict[str, Column], AnalyzeContext], dict[str, Column]],
            keep: list[str] | None = None, max_passes: int = 8) -> Transform:
    """Run the analyzers of ``fn`` over ``df`` (the training rows) and return the frozen Transform."""
    ctx = AnalyzeContext()
    cols = {c: F.col(f"`{c}`") for c in df.columns}
    for _ in range(max_passes):
        ctx._i = 0
        fn(cols, ctx)
        ready = [a for a in ctx.analyzers if not a.resolved and not _is_pending(a.expr)]
        if not ready:
            break
        numeric = [a for a in ready if a.kind in ("mean", "zscore")]
        if numeric:
            aggs = []
            for j, a in enumerate(numeric):
                x = a.expr.cast("double")
                aggs.append(F.avg(x).alias(f"m{j}"))
                if a.kind == "zscore":
                    aggs.append(F.stddev_pop(x).alias(f"s{j}"))
            row = df.agg(*aggs).first()   # one row of statistics (bounded by the analyzer count)
            for j, a in enumerate(numeric):
                a.result = row[f"m{j}"] if a.kind == "mean" else (row[f"m{j}"], row[f"s{j}"])
                a.resolved = True
        vocabs = [a for a in ready if a.kind == "vocab"]
        if vocabs:
            built = vocab_build_many(df, [a.expr for a in vocabs], [a.top_k for a in vocabs])
            for a, (table, n) in zip(vocabs, built):
                a.result, a.size, a.resolved = table, n, True
        if all(a.resolved for a in ctx.analyzers):
            break
    if not all(a.resolved for a in ctx.analyzers):
        raise RuntimeError("analyzers could not be resolved (cyclic dependency?)")
    return Transform(fn, ctx, keep or [])
