"""Profiling statistics as DataFrames.

* numeric features: ONE aggregate over all columns, unpivoted with ``inline`` to one row per feature;
* string features: melt to (feature, value), ONE ``groupBy(feature, value).count()`` (partial
  aggregation makes hot values cheap), then per-feature measures over that frequency table.

Outputs are long tables keyed by ``feature`` so later steps (schema inference, validation,
comparison) are joins of small tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def q(c: str) -> str:
    """Backtick-quote a column name (names may contain hyphens)."""
    return "`" + c.replace("`", "``") + "`"


def feature_kind(dtype: T.DataType) -> str:
    """Schema type of a Spark type: INT, FLOAT or BYTES (arrays take their element's kind)."""
    if isinstance(dtype, T.ArrayType):
        return feature_kind(dtype.elementType)
    if isinstance(dtype, INTEGRAL) or isinstance(dtype, T.BooleanType):
        return "INT"
    if isinstance(dtype, NUMERIC):
        return "FLOAT"
    return "BYTES"


def allowed(df: DataFrame, allow: list[str] | None = None, remove: set[str] | None = None) -> list[str]:
    cols = list(allow) if allow else list(df.columns)
    return [c for c in cols if c in df.columns and c not in (remove or set())]


def numeric_columns(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC)]


def string_columns(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]


NUMERIC_STATS_SCHEMA = ("feature string, ordinal int, count bigint, missing bigint, mean double, std_dev double, "
                        "zeros bigint, min double, median double, max double")
STRING_STATS_SCHEMA = ("feature string, ordinal int, count bigint, missing bigint, distinct bigint, "
                       "avg_length double, top string, top_freq bigint")


def _numeric_aggs(cols: list[str], accuracy: int) -> list:
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(q(c)).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.count_if(x.isNull()).alias(f"m{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_pop(x).alias(f"s{i}"), F.count_if(x == 0).alias(f"z{i}"), F.min(x).alias(f"lo{i}"),
                 F.percentile_approx(x, 0.5, accuracy).alias(f"md{i}"), F.max(x).alias(f"hi{i}")]
    return aggs


def _numeric_rows(cols: list[str]):
    return F.array(*[F.struct(
        F.lit(c).alias("feature"), F.lit(i).alias("ordinal"),
        F.col(f"c{i}").cast("bigint").alias("count"), F.col(f"m{i}").cast("bigint").alias("missing"),
        F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std_dev"),
        F.col(f"z{i}").cast("bigint").alias("zeros"), F.col(f"lo{i}").alias("min"),
        F.col(f"md{i}").alias("median"), F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)])


def stats_numeric(df: DataFrame, cols: list[str] | None = None, accuracy: int = 10000,
                  exact_median: bool = False) -> DataFrame:
    """Per numeric feature: count, missing, mean, std_dev (population), zeros, min, median, max.

    The median is ``percentile_approx`` (a bounded sketch per column; exact while a column has fewer
    values than ``accuracy``). With ``exact_median`` it is the value at rank floor((n-1)/2) of the
    non-missing values, found without sorting the columns (:func:`_exact_medians`, three jobs in all).
    """
    cols = numeric_columns(df, cols or df.columns)
    out = df.agg(*_numeric_aggs(cols, accuracy)).select(F.inline(_numeric_rows(cols)))
    if not exact_median:
        return out
    med = None
    for c, value in _exact_medians(df, cols, accuracy).items():
        cond = F.col("feature") == F.lit(c)
        med = F.when(cond, F.lit(value).cast("double")) if med is None else med.when(cond, F.lit(value).cast("double"))
    return out.withColumn("median", med) if med is not None else out


#: Values of one column and rank that are ranked on the driver at the end of a selection.
MAX_RANKED = 10_000


def exact_ranks(df: DataFrame, cols: list[str], ranks: Callable[[int], list[int]], accuracy: int = 10000,
                most: int = MAX_RANKED) -> dict[str, list[float | None]]:
    """The values at 0-based ranks of the non-missing values of numeric columns, by distributed selection.

    ``ranks`` gives a column's ranks from its count. Every rank has an open bracket (lo, hi) of values.
    A round sketches the values inside each bracket around the wanted rank and counts, in one aggregate
    each, what lies below, on and between the new bounds: the rank is at a bound (ties of any weight end
    here) or strictly between them, where at most a share of some 4/``accuracy`` of the bracket is left.
    Rounds go on until the values inside all brackets are at most ``most`` a rank; these are counted by
    value and collected. No task sorts or holds more, whatever the ties. NaN counts as the largest value.
    """
    if not cols:
        return {}
    x = [F.col(q(c)).cast("double") for c in cols]
    counts = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(x)]).first()
    wanted = {i: ranks(int(counts[f"n{i}"])) if counts[f"n{i}"] else [] for i in range(len(cols))}
    found: dict[tuple[int, int], float] = {}
    # (column, rank) -> (lo, hi, values at or below lo, values inside); no bound yet: None
    todo = {(i, k): (None, None, 0, int(counts[f"n{i}"])) for i, ks in wanted.items() for k in set(ks) if 0 <= k < counts[f"n{i}"]}

    def inside(i: int, lo: float | None, hi: float | None) -> Column:
        cond = x[i].isNotNull()
        if lo is not None:
            cond &= x[i] > F.lit(lo)
        return cond if hi is None else cond & (x[i] < F.lit(hi))

    eps = 2.0 / accuracy
    while any(t[3] > most for t in todo.values()):
        large = [(key, t) for key, t in todo.items() if t[3] > most]
        sketch = []
        for j, ((i, k), (lo, hi, below, m)) in enumerate(large):
            p = (k - below + 0.5) / m
            probs = F.array(F.lit(max(0.0, p - eps)), F.lit(min(1.0, p + eps)))
            sketch.append(F.percentile_approx(F.when(inside(i, lo, hi), x[i]), probs, accuracy).alias(f"b{j}"))
        cuts = df.agg(*sketch).first()
        aggs = []
        for j, ((i, _), (lo, hi, _, _)) in enumerate(large):
            a, b = (float(v) for v in cuts[f"b{j}"])
            v = inside(i, lo, hi)
            aggs += [F.count_if(v & (x[i] < F.lit(a))).alias(f"l{j}"), F.count_if(v & (x[i] == F.lit(a))).alias(f"a{j}"),
                     F.count_if(v & (x[i] > F.lit(a)) & (x[i] < F.lit(b))).alias(f"m{j}"), F.count_if(v & (x[i] == F.lit(b))).alias(f"e{j}")]
        r = df.agg(*aggs).first()
        for j, (key, (lo, hi, below, m)) in enumerate(large):
            a, b = (float(v) for v in cuts[f"b{j}"])
            left = key[1] - below - r[f"l{j}"]
            if left < 0:                                         # below the sketch's bracket
                todo[key] = (lo, a, below, r[f"l{j}"])
            elif left < r[f"a{j}"]:
                found[key] = a
            elif left < r[f"a{j}"] + r[f"m{j}"]:
                todo[key] = (a, b, below + r[f"l{j}"] + r[f"a{j}"], r[f"m{j}"])
            elif left < r[f"a{j}"] + r[f"m{j}"] + r[f"e{j}"]:
                found[key] = b
            else:
                upto = r[f"l{j}"] + r[f"a{j}"] + r[f"m{j}"] + r[f"e{j}"]
                todo[key] = (b, hi, below + upto, m - upto)
        todo = {key: t for key, t in todo.items() if key not in found}
    if todo:
        rest = list(todo.items())
        cells = F.array(*[F.when(inside(i, lo, hi), F.struct(F.lit(j).alias("j"), x[i].alias("x"))) for j, ((i, _), (lo, hi, _, _)) in enumerate(rest)])
        rows = (df.select(F.explode(F.array_compact(cells)).alias("c")).select("c.*")
                .groupBy("j", "x").agg(F.count(F.lit(1)).alias("n")).collect())      # at most ``most`` a rank
        for j, (key, (_, _, below, _)) in enumerate(rest):
            upto = below
            for v, n in sorted(((r["x"], r["n"]) for r in rows if r["j"] == j), key=lambda t: (t[0] != t[0], t[0])):
                upto += n
                if upto > key[1]:
                    found[key] = v
                    break
    return {c: [found.get((i, k)) for k in wanted[i]] for i, c in enumerate(cols)}


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """(feature, prob, value): the value at rank floor(prob * (n - 1)) of each numeric column, exact."""
    found = exact_ranks(df, cols, lambda n: [int(p * (n - 1)) for p in probs])
    rows = [(c, float(p), v) for c, vs in found.items() for p, v in zip(probs, vs or [None] * len(probs), strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, prob double, value double")


def _exact_medians(df: DataFrame, cols: list[str], accuracy: int) -> dict[str, float | None]:
    """Value at rank floor((n-1)/2) of every column."""
    found = exact_ranks(df, cols, lambda n: [(n - 1) // 2], accuracy)
    return {c: vs[0] if vs else None for c, vs in found.items()}


def melt_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value) rows for the given string columns; one output row per input cell."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(q(c)).alias("value")) for c in cols])
    return df.select(F.inline(pairs))


def stats_value_freq(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, value, count) for string features; nulls are not values (they are 'missing')."""
    cols = string_columns(df, cols or df.columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, value string, count bigint")
    return (melt_strings(df, cols).where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count")))


def value_counts_with_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, count) including one null-value row per feature for its missing cells:
    a single grouped count gives frequencies, missing counts and row counts."""
    cols = string_columns(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, value string, count bigint")
    return melt_strings(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))


def _string_aggs() -> list:
    """Per-feature measures over (value, count) rows, missing cells being the null-value row."""
    present = F.col("value").isNotNull()
    return [
        F.sum(F.when(present, F.col("count")).otherwise(0)).cast("bigint").alias("count"),
        F.sum(F.when(~present, F.col("count")).otherwise(0)).cast("bigint").alias("missing"),
        F.count_if(present).cast("bigint").alias("distinct"),
        (F.sum(F.when(present, F.col("count") * F.length("value"))) /
         F.sum(F.when(present, F.col("count")))).alias("avg_length"),
        F.min_by(F.when(present, F.col("value")),
                 F.when(present, F.struct((-F.col("count")).alias("nc"), F.col("value").alias("v")))).alias("top"),
        F.max(F.when(present, F.col("count"))).cast("bigint").alias("top_freq")]


def stats_string(df: DataFrame, cols: list[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Per string feature: count, missing, distinct, avg_length, top value, top frequency.

    Computed from :func:`value_counts_with_missing` (no other pass over the rows). Ties for the
    top value go to the smallest value (byte order).
    """
    cols = string_columns(df, cols or df.columns)
    counts = counts if counts is not None else value_counts_with_missing(df, cols)
    per = counts.groupBy("feature").agg(*_string_aggs())
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature string, ordinal int")
    return (F.broadcast(names).join(per, "feature", "left")
            .select("feature", "ordinal", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
                    F.coalesce("missing", F.lit(0)).cast("bigint").alias("missing"),
                    F.coalesce("distinct", F.lit(0)).cast("bigint").alias("distinct"),
                    "avg_length", "top", "top_freq"))


def stats_histogram(df: DataFrame, col: str, buckets: int = 10) -> DataFrame:
    """Equal-width histogram: a min/max pass (one row to the driver), then a bucket index and a
    group count, 0 for empty buckets. Bucket i covers [min + i*w, min + (i+1)*w); the maximum falls
    into the last one.
    """
    x = F.col(q(col)).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "feature string, bucket int, low double, high double, count bigint")
    lo_c, hi_c = F.lit(float(lo)), F.lit(float(hi))
    b = (F.lit(0) if hi == lo else F.least(F.floor((x - lo_c) * buckets / (hi_c - lo_c)), F.lit(buckets - 1)))
    counts = df.where(x.isNotNull()).groupBy(b.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1 if hi == lo else buckets).select(F.col("id").cast("int").alias("bucket"))
    return (every.join(counts, "bucket", "left")
            .select(F.lit(col).alias("feature"), "bucket",
                    (lo_c + F.col("bucket") * (hi_c - lo_c) / buckets).alias("low"),
                    (lo_c + (F.col("bucket") + 1) * (hi_c - lo_c) / buckets).alias("high"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("count")))


def stats_describe(df: DataFrame, col: str) -> DataFrame:
    """count / unique / top / freq of one column (as a one-row table)."""
    s = stats_string(df.select(col), [col])
    return s.select(F.col("count"), F.col("distinct").alias("unique"), F.col("top"), F.col("top_freq").alias("freq"))


def stats_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Number of features, number of examples, first and last feature of a profile."""
    cols = cols or df.columns
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("num_examples")).select(
        F.lit(len(cols)).cast("bigint").alias("num_features"), "num_examples",
        F.lit(cols[0]).alias("first_feature"), F.lit(cols[-1]).alias("last_feature"))


def profile(df: DataFrame, allow: list[str] | None = None, remove: set[str] | None = None,
            accuracy: int = 10000, materialize: bool = True) -> dict[str, DataFrame]:
    """Profile a table: numeric stats, string stats and the string value frequencies.

    Two aggregates read the rows – one for all numeric features, one grouped count of the melted
    string features (missing cells included). With ``materialize`` both results, which are
    statistics-sized, are checkpointed to the shared folder, so every later rule, comparison and
    schema step reads those small tables instead of repeating a pass over the data.
    """
    from kiln.session import cut_lineage
    cols = allowed(df, allow, remove)
    nums = numeric_columns(df, cols)
    strs = string_columns(df, cols)
    numeric = stats_numeric(df, nums, accuracy) if nums else None
    counts = value_counts_with_missing(df, strs)
    string = None
    if materialize:
        # per-feature tables: one row per feature, kept as local tables; the frequency table can
        # be large and is checkpointed to the shared folder
        numeric = _local(numeric) if numeric is not None else None
        counts = cut_lineage(counts) if strs else counts
        string = _local(stats_string(df, strs, counts)) if strs else None
    elif strs:
        string = stats_string(df, strs, counts)
    others = [c for c in cols if c not in nums and c not in strs]
    other = df.agg(*_present_aggs(others)).select(F.inline(_present_rows(others))) if others else None
    return {
        "numeric": numeric,
        "string": string,
        "other": _local(other) if other is not None and materialize else other,
        "freq": counts.where(F.col("value").isNotNull()),
        "features": df.sparkSession.createDataFrame(  # one row per profiled feature (small)
            [(c, i, feature_kind(df.schema[c].dataType)) for i, c in enumerate(cols)],
            "feature string, ordinal int, type string"),
    }


def _present_aggs(cols: list[str]) -> list:
    """Rows with and without a value, for features that get no other statistics (booleans, dates,
    times, binaries, arrays, structs)."""
    return [a for i, c in enumerate(cols) for a in (F.count(F.col(q(c))).alias(f"pc{i}"), F.count_if(F.col(q(c)).isNull()).alias(f"pm{i}"))]


def _present_rows(cols: list[str]):
    return F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ordinal"), F.col(f"pc{i}").cast("bigint").alias("count"),
                              F.col(f"pm{i}").cast("bigint").alias("missing")) for i, c in enumerate(cols)])


def profile_splits(tagged: DataFrame, names: tuple[str, ...], split_col: str = "split",
                   remove: set[str] | None = None, exclude: dict[str, set[str]] | None = None,
                   accuracy: int = 10000) -> dict[str, dict[str, DataFrame]]:
    """Profiles of every split of a tagged table from ONE pass over it.

    The numeric aggregate and the melted value count are grouped by split as well, so train,
    eval and serving cost one scan instead of three. ``exclude`` drops features from a split's
    profile (the label of the serving rows). The value counts are checkpointed once; the
    per-feature tables (splits × features rows) are brought back as local tables.
    """
    from kiln.session import cut_lineage
    spark = tagged.sparkSession
    exclude = exclude or {}
    cols = allowed(tagged, remove=set(remove or ()) | {split_col})
    nums, strs = numeric_columns(tagged, cols), string_columns(tagged, cols)
    others = [c for c in cols if c not in nums and c not in strs]
    other_rows: dict[str, dict[str, tuple]] = {}
    if others:
        for r in (tagged.groupBy(F.col(q(split_col)).alias("__split")).agg(*_present_aggs(others))
                  .select("__split", F.inline(_present_rows(others))).collect()):      # splits × features
            other_rows.setdefault(r["__split"], {})[r["feature"]] = tuple(r)[3:]
    num_rows: dict[str, dict[str, tuple]] = {}
    if nums:
        for r in (tagged.groupBy(F.col(q(split_col)).alias("__split")).agg(*_numeric_aggs(nums, accuracy))
                  .select("__split", F.inline(_numeric_rows(nums))).collect()):       # splits × features
            num_rows.setdefault(r["__split"], {})[r["feature"]] = tuple(r)[3:]
    counts = None
    str_rows: dict[str, dict[str, tuple]] = {}
    if strs:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(q(c)).alias("value")) for c in strs])
        counts = cut_lineage(tagged.select(F.col(q(split_col)).alias("__split"), F.inline(pairs))
                             .groupBy("__split", "feature", "value").agg(F.count(F.lit(1)).alias("count")))
        for r in counts.groupBy("__split", "feature").agg(*_string_aggs()).collect():  # splits × features
            str_rows.setdefault(r["__split"], {})[r["feature"]] = tuple(r)[2:]
    out = {}
    for name in names:
        ex = set(exclude.get(name, ()))
        feats = [c for c in cols if c not in ex]
        n_s = [c for c in nums if c not in ex]
        s_s = [c for c in strs if c not in ex]
        nr = num_rows.get(name, {})
        sr = str_rows.get(name, {})
        numeric = (spark.createDataFrame(
            [(c, i, *(nr.get(c) or (0, 0, None, None, 0, None, None, None))) for i, c in enumerate(n_s)],
            NUMERIC_STATS_SCHEMA) if n_s else None)
        string = (spark.createDataFrame(
            [(c, i, *(sr.get(c) or (0, 0, 0, None, None, None))) for i, c in enumerate(s_s)],
            STRING_STATS_SCHEMA) if s_s else None)
        freq = (counts.where((F.col("__split") == name) & F.col("value").isNotNull() & ~F.col("feature").isin(list(ex)))
                .drop("__split") if counts is not None
                else spark.createDataFrame([], "feature string, value string, count bigint"))
        o_s = [c for c in others if c not in ex]
        other = (spark.createDataFrame([(c, i, *(other_rows.get(name, {}).get(c) or (0, 0))) for i, c in enumerate(o_s)],
                                       "feature string, ordinal int, count bigint, missing bigint") if o_s else None)
        out[name] = {
            "numeric": numeric, "string": string, "other": other, "freq": freq,
            "features": spark.createDataFrame([(c, i, feature_kind(tagged.schema[c].dataType)) for i, c in enumerate(feats)],
                                              "feature string, ordinal int, type string"),
        }
    return out


def _local(df: DataFrame) -> DataFrame:
    """A metadata-sized result (one row per feature) brought back as a local table."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def long_measures(stats: DataFrame, measures: list[str]) -> DataFrame:
    """Unpivot a wide per-feature stats table to (feature, measure, value double)."""
    return stats.select("feature", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])))


def stats_compare(left: DataFrame, right: DataFrame, measures: list[str],
                  left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Overlay two stat sets: (feature, measure, <left>, <right>) with a full outer join."""
    lo = long_measures(left, measures).withColumnRenamed("value", left_name)
    ro = long_measures(right, measures).withColumnRenamed("value", right_name)
    return lo.join(ro, ["feature", "measure"], "full_outer")


def stats_typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to schema types first (``try_cast``: bad values become missing)."""
    spark_type = {"INT": "bigint", "FLOAT": "double", "BYTES": "string"}
    cols = []
    for c in df.columns:
        if c in types:
            cols.append(F.expr(f"try_cast({q(c)} as {spark_type[types[c]]})").alias(c))
        else:
            cols.append(F.col(q(c)))
    return df.select(*cols)


def top_values(freq: DataFrame, k: int) -> DataFrame:
    """k most frequent values per feature (ties by value); a per-feature limit before the shuffle."""
    w = Window.partitionBy("feature").orderBy(F.col("count").desc(), F.col("value"))
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
