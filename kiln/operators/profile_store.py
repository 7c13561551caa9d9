"""Statistics kept per span on disk, merged without reading rows again.

:func:`write_span` profiles one span (a day, a delivery) in one pass and stores one row per feature:
counts, sums about the span's mean, extremes, and mergeable sketches of quantiles, distinct values and
heavy values. Everything later – the statistics of any set of spans, distances between two sets, drift of
each span against the one before – merges these rows; their number is spans x features, whatever the data.

Bounds. Counts, means, deviations and extremes are exact up to rounding. Quantiles are within
``RANK_ERROR`` of their rank, distinct counts within some 3 % (one standard error is 1.6 %). Value shares are exact while a
feature has at most 0.75 * ``HEAVY`` distinct values over the merged spans; beyond, a share is at most
``SHARE_ERROR`` off, and so is the largest difference of two shares, twice that.

A span is written to its own folder and replaced as a whole, so writing it again changes nothing.
Null cells count as missing, NaN and infinite values are no numbers and count as ``other``; a feature that
a span does not have simply has no row there; an empty span stores zero counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.stats import NUMERIC, q

HEAVY = 10_000               # values that a sketch of a feature tracks
QUANTILE_K = 1_600
RANK_ERROR = 0.003
SHARE_ERROR = 4.0 / HEAVY


def _features(df: DataFrame, remove: set[str] | None) -> tuple[list[str], list[str]]:
    cols = [f for f in df.schema.fields if f.name not in (remove or ())]
    return ([f.name for f in cols if isinstance(f.dataType, NUMERIC)], [f.name for f in cols if isinstance(f.dataType, T.StringType)])


def write_span(df: DataFrame, path: str, span: str, remove: set[str] | None = None) -> None:
    """Profile the numeric and string columns of one span into ``path``."""
    write_spans(df.withColumn("__span", F.lit(span)), path, "__span", remove)


def write_spans(df: DataFrame, path: str, span_col: str, remove: set[str] | None = None) -> None:
    """Profile every span of a table in one pass: cells are grouped by span and feature, partly in each task."""
    numeric, strings = _features(df.drop(span_col), remove)
    cells = [F.struct(F.lit(c).alias("feature"), F.col(q(c)).cast("double").alias("x"), F.lit(None).cast("string").alias("v")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("x"), F.col(q(c)).alias("v")) for c in strings]
    kinds = F.create_map(*[e for c in numeric for e in (F.lit(c), F.lit("number"))], *[e for c in strings for e in (F.lit(c), F.lit("string"))])
    rows = df.select(F.col(q(span_col)).cast("string").alias("span"), F.inline(F.array(*cells)))
    real = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf"))
    x, v = F.when(real, F.col("x")), F.col("v")
    out = rows.groupBy("span", "feature").agg(
        F.count(F.coalesce(v, x.cast("string"))).alias("count"), F.count_if(F.col("x").isNull() & v.isNull()).alias("missing"),
        F.count_if(F.col("x").isNotNull() & ~real).alias("other"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
        F.count_if(x == 0).alias("zeros"), F.min(x).alias("min"), F.max(x).alias("max"), F.sum(F.length(v)).alias("letters"),
        F.kll_sketch_agg_double(x, QUANTILE_K).alias("quantiles"), F.hll_sketch_agg(F.coalesce(v, x.cast("string")), 12).alias("distinct"),
        F.expr(f"approx_top_k_accumulate(v, {HEAVY})").alias("heavy"))
    out = out.withColumn("kind", kinds[F.col("feature")])
    out.repartition("span").write.partitionBy("span").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def stored(spark: SparkSession, path: str, spans: list[str] | None = None) -> DataFrame:
    """The stored rows, of some spans."""
    rows = spark.read.option("basePath", path).schema(spark.read.parquet(path).drop("span").schema.add("span", "string")).parquet(path)
    return rows if spans is None else rows.where(F.col("span").isin(spans))


def merged(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per feature (and ``by``) of all the given spans, in the same form."""
    keys = [*(by or []), "feature", "kind"]
    whole = rows.withColumn("__n", F.col("count") * (F.col("kind") == "number").cast("int"))
    means = whole.groupBy(*keys).agg((F.sum(F.col("mean") * F.col("__n")) / F.sum("__n")).alias("__mean"))
    sums = whole.join(means, keys).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("count", "missing", "other", "zeros", "letters")], F.first("__mean").alias("mean"),
        F.sum(F.coalesce("m2", F.lit(0.0)) + F.coalesce(F.col("__n") * (F.col("mean") - F.col("__mean")) ** 2, F.lit(0.0))).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"), F.expr(f"approx_top_k_combine(heavy, {HEAVY})").alias("heavy"))
    return sums


def statistics(rows: DataFrame, probs: list[float] | None = None) -> DataFrame:
    """(feature, kind, count, missing, other, mean, std_dev, zeros, min, quantiles, max, distinct, avg_length)
    of merged rows; ``quantiles`` at ``probs`` (default: the median)."""
    def at(p: float) -> Column:
        some = F.when((F.col("kind") == "number") & (F.col("count") > 0), F.col("quantiles"))
        return F.kll_sketch_get_quantile_double(some, F.lit(float(p)))

    number = F.col("kind") == "number"
    return rows.select(
        "feature", "kind", "count", "missing", "other", "mean",
        F.when(number & (F.col("count") > 0), F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / F.col("count"))).alias("std_dev"), F.when(number, F.col("zeros")).alias("zeros"),
        "min", F.array(*[at(p) for p in (probs or [0.5])]).alias("quantiles"), "max", F.hll_sketch_estimate("distinct").alias("distinct"),
        F.when(~number & (F.col("count") > 0), F.col("letters") / F.col("count")).alias("avg_length"))


def shares(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., feature, value, share) of the heavy values of string features."""
    some = rows.where((F.col("kind") == "string") & (F.col("count") > 0))
    each = some.select(*(by or []), "feature", "count", F.explode(F.expr(f"approx_top_k_estimate(heavy, {HEAVY})")).alias("e"))
    return each.where("e.item IS NOT NULL").select(*(by or []), "feature", F.col("e.item").alias("value"), (F.col("e.count") / F.col("count")).alias("share"))


def _largest(pairs: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    d = F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))
    out = pairs.groupBy(*keys).agg(F.max(d).alias("distance"), F.min_by("value", F.struct((-d).alias("nd"), F.col("value").alias("v"))).alias("at_value"))
    return out.withColumn("threshold", F.lit(threshold)).withColumn("is_anomaly", F.col("distance") > F.col("threshold"))


def distance(current: DataFrame, previous: DataFrame, threshold: float) -> DataFrame:
    """(feature, distance, at_value, threshold, is_anomaly): largest difference of a value's share between
    two sets of merged rows (skew or drift)."""
    a, b = shares(current).withColumnRenamed("share", "p"), shares(previous).withColumnRenamed("share", "q")
    return _largest(a.join(b, ["feature", "value"], "full_outer"), ["feature"], threshold)


def drift_of_spans(rows: DataFrame, threshold: float) -> DataFrame:
    """(span, previous_span, feature, distance, ...): every stored span against the one before it in which
    the feature was profiled."""
    w = Window.partitionBy("feature").orderBy("span")              # spans of a feature: metadata
    rows = rows.where((F.col("kind") == "string") & (F.col("count") > 0)).withColumn("previous_span", F.lag("span").over(w))
    current = shares(rows, ["span", "previous_span"]).withColumnRenamed("share", "p").where("previous_span IS NOT NULL")
    links = rows.select("span", "previous_span", "feature").where("previous_span IS NOT NULL")
    before = shares(rows.drop("previous_span"), ["span"]).select(F.col("span").alias("previous_span"), "feature", "value", F.col("share").alias("q"))
    before = before.join(links, ["previous_span", "feature"])
    keys = ["span", "previous_span", "feature"]
    return _largest(current.join(before, [*keys, "value"], "full_outer"), keys, threshold)
