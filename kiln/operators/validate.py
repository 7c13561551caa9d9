"""Validation rules: each returns anomalies as (feature, anomaly, detail, value).

All rules work on profile tables (features × values) and the schema tables, never on raw rows,
so they are joins of small tables; only the profile that produced them touched the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.analyze import broadcast_if_small
from kiln.operators.schema import Schema, env_filter
from kiln.session import cut_lineage

ANOMALY_COLS = ["feature", "anomaly", "detail", "value"]


def _shape(df: DataFrame) -> DataFrame:
    return df.select(F.col("feature").cast("string"), F.col("anomaly").cast("string"),
                     F.col("detail").cast("string"), F.col("value").cast("double"))


def _observed(prof: dict[str, DataFrame]) -> DataFrame:
    return prof["features"].select("feature", F.col("type").alias("observed_type"))


def unexpected_values(freq: DataFrame, schema: Schema, env: str | None = None) -> DataFrame:
    """Values outside the feature's domain with their share of the feature's non-missing rows."""
    feats = env_filter(schema, env).where(F.col("domain").isNotNull()).select("feature", "domain", "min_domain_mass")
    totals = freq.groupBy("feature").agg(F.sum("count").alias("total"))      # one row per feature
    with_dom = freq.join(F.broadcast(feats), "feature")
    outside = with_dom.join(broadcast_if_small(schema.domains), ["domain", "value"], "left_anti")
    return (outside.join(F.broadcast(totals), "feature")
            .select("feature", "value", "count", (F.col("count") / F.col("total")).alias("fraction"),
                    "min_domain_mass"))


def validate_domain(freq: DataFrame, schema: Schema, env: str | None = None) -> DataFrame:
    """UNEXPECTED_STRING_VALUES, one row per unexpected value, when the feature's in-domain share
    is below its ``min_domain_mass`` (1.0 unless relaxed: then any unexpected value counts)."""
    out = unexpected_values(freq, schema, env)
    mass = out.groupBy("feature", "min_domain_mass").agg((1 - F.sum("fraction")).alias("in_domain"))
    flagged = mass.where(F.col("in_domain") < F.col("min_domain_mass")).select("feature")
    return _shape(out.join(flagged, "feature", "left_semi")
                  .select("feature", F.lit("UNEXPECTED_STRING_VALUES").alias("anomaly"),
                          F.col("value").alias("detail"), F.col("fraction").alias("value")))


def domain_mass(freq: DataFrame, schema: Schema, env: str | None = None) -> DataFrame:
    """Per feature with a domain: share of values inside it, and its min_domain_mass."""
    feats = env_filter(schema, env).where(F.col("domain").isNotNull()).select("feature", "domain", "min_domain_mass")
    dom = schema.domains.withColumn("__in", F.lit(1))
    return (freq.join(F.broadcast(feats), "feature").join(broadcast_if_small(dom), ["domain", "value"], "left")
            .groupBy("feature", "min_domain_mass")
            .agg((F.sum(F.when(F.col("__in") == 1, F.col("count")).otherwise(0)) / F.sum("count")).alias("in_domain"))
            .withColumn("is_anomaly", F.col("in_domain") < F.col("min_domain_mass")))


def validate_missing_column(prof: dict[str, DataFrame], schema: Schema, env: str | None = None) -> DataFrame:
    """SCHEMA_MISSING_COLUMN: a feature expected in ``env`` that the data does not have."""
    exp = env_filter(schema, env).select("feature")
    return _shape(exp.join(_observed(prof), "feature", "left_anti")
                  .select("feature", F.lit("SCHEMA_MISSING_COLUMN").alias("anomaly"),
                          F.lit(None).alias("detail"), F.lit(None).alias("value")))


def validate_new_column(prof: dict[str, DataFrame], schema: Schema) -> DataFrame:
    """SCHEMA_NEW_COLUMN: a column in the data that the schema does not know."""
    return _shape(_observed(prof).join(schema.features.select("feature"), "feature", "left_anti")
                  .select("feature", F.lit("SCHEMA_NEW_COLUMN").alias("anomaly"),
                          F.lit(None).alias("detail"), F.lit(None).alias("value")))


def validate_type(prof: dict[str, DataFrame], schema: Schema, env: str | None = None) -> DataFrame:
    """UNEXPECTED_TYPE: observed type differs from the schema type (detail 'expected->observed')."""
    exp = env_filter(schema, env).select("feature", "type")
    return _shape(exp.join(_observed(prof), "feature")
                  .where(F.col("type") != F.col("observed_type"))
                  .select("feature", F.lit("UNEXPECTED_TYPE").alias("anomaly"),
                          F.concat_ws("->", "type", "observed_type").alias("detail"), F.lit(None).alias("value")))


def presence_table(prof: dict[str, DataFrame]) -> DataFrame:
    parts = [prof[k].select("feature", "count", "missing") for k in ("numeric", "string", "other")
             if prof.get(k) is not None]
    return reduce(DataFrame.unionByName, parts)


def validate_presence(prof: dict[str, DataFrame], schema: Schema, env: str | None = None) -> DataFrame:
    """PRESENCE: non-missing fraction below min_fraction, or non-missing count below min_count."""
    exp = env_filter(schema, env).select("feature", "min_fraction", "min_count")
    p = presence_table(prof).withColumn("fraction", F.col("count") / (F.col("count") + F.col("missing")))
    return _shape(exp.join(p, "feature")
                  .where((F.col("fraction") < F.col("min_fraction")) | (F.col("count") < F.col("min_count")))
                  .select("feature", F.lit("PRESENCE").alias("anomaly"),
                          F.when(F.col("count") < F.col("min_count"), "count").otherwise("fraction").alias("detail"),
                          F.col("fraction").alias("value")))


def array_sizes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, min_size, max_size) for array columns: one aggregate for all of them."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(F.size(F.col(f"`{c}`"))).alias(f"lo{i}"), F.max(F.size(F.col(f"`{c}`"))).alias(f"hi{i}")]
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"lo{i}").cast("bigint").alias("min_size"),
                                                  F.col(f"hi{i}").cast("bigint").alias("max_size"))
                                         for i, c in enumerate(cols)])))


def validate_value_count(sizes: DataFrame, schema: Schema, env: str | None = None) -> DataFrame:
    """VALUE_COUNT: an array feature has fewer or more values per example than the schema allows."""
    exp = env_filter(schema, env).where(F.col("value_count_min").isNotNull()).select(
        "feature", "value_count_min", "value_count_max")
    j = exp.join(sizes, "feature")
    low = j.where(F.col("min_size") < F.col("value_count_min")).select(
        "feature", F.lit("VALUE_COUNT").alias("anomaly"), F.lit("below_min").alias("detail"),
        F.col("min_size").alias("value"))
    high = j.where(F.col("max_size") > F.col("value_count_max")).select(
        "feature", F.lit("VALUE_COUNT").alias("anomaly"), F.lit("above_max").alias("detail"),
        F.col("max_size").alias("value"))
    return _shape(low.unionByName(high))


def linf_distance(freq_a: DataFrame, freq_b: DataFrame, features: list[str] | None = None) -> DataFrame:
    """L-infinity distance of normalised value frequencies per feature: max |p - q|.

    A value missing on one side counts as 0 there (full outer join of the frequency tables).
    """
    def norm(freq):
        f = freq if features is None else freq.where(F.col("feature").isin(features))
        tot = f.groupBy("feature").agg(F.sum("count").alias("__t"))             # one row per feature
        return f.join(F.broadcast(tot), "feature").select("feature", "value", (F.col("count") / F.col("__t")).alias("p"))
    a = norm(freq_a)
    b = norm(freq_b).withColumnRenamed("p", "q")
    j = a.join(b, ["feature", "value"], "full_outer")
    d = F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))
    # Ties on the distance go to the smallest value.
    return j.groupBy("feature").agg(
        F.max(d).alias("distance"),
        F.min_by("value", F.struct((-d).alias("nd"), F.col("value").alias("v"))).alias("at_value"))


def _comparator(freq_a: DataFrame, freq_b: DataFrame, schema: Schema, column: str, anomaly: str) -> DataFrame:
    thr = schema.features.where(F.col(column).isNotNull()).select("feature", F.col(column).alias("threshold"))
    d = linf_distance(freq_a, freq_b).join(F.broadcast(thr), "feature")
    return d.withColumn("anomaly", F.lit(anomaly)).withColumn("is_anomaly", F.col("distance") > F.col("threshold"))


def skew_linf(train_freq: DataFrame, serving_freq: DataFrame, schema: Schema) -> DataFrame:
    """Training/serving skew for features with a skew threshold: (feature, distance, at_value,
    threshold, anomaly, is_anomaly)."""
    return _comparator(train_freq, serving_freq, schema, "skew_threshold", "SKEW")


def drift_linf(current_freq: DataFrame, previous_freq: DataFrame, schema: Schema) -> DataFrame:
    """Drift against the previous span for features with a drift threshold."""
    return _comparator(current_freq, previous_freq, schema, "drift_threshold", "DRIFT")


def validate_all(prof: dict[str, DataFrame], schema: Schema, env: str | None = None,
                 previous: dict[str, DataFrame] | None = None,
                 serving: dict[str, DataFrame] | None = None,
                 sizes: DataFrame | None = None) -> DataFrame:
    """Every rule as one anomaly table."""
    parts = [validate_missing_column(prof, schema, env), validate_new_column(prof, schema),
             validate_type(prof, schema, env), validate_presence(prof, schema, env),
             validate_domain(prof["freq"], schema, env)]
    if sizes is not None:
        parts.append(validate_value_count(sizes, schema, env))
    for other, fn in ((serving, skew_linf), (previous, drift_linf)):
        if other is not None:
            cmp = fn(prof["freq"], other["freq"], schema).where("is_anomaly")
            parts.append(_shape(cmp.select("feature", "anomaly", F.col("at_value").alias("detail"),
                                           F.col("distance").alias("value"))))
    return reduce(DataFrame.unionByName, parts)


def drift_by_span(df: DataFrame, span_col: str, features: list[str], threshold: float) -> DataFrame:
    """Drift of every span against the span before it, for all spans in one job.

    Frequencies per (span, feature, value) come from one aggregate, stored once. Each share is counted
    for its own span and, negated, for the next one, so one grouped sum gives all differences. Output: (span, previous_span, feature,
    distance, at_value, threshold, is_anomaly).
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value"))
                      for c in features])
    freq = cut_lineage(df.select(F.col(span_col).alias("span"), F.inline(pairs)).where(F.col("value").isNotNull())
                       .groupBy("span", "feature", "value").agg(F.count(F.lit(1)).alias("count")))
    tot = cut_lineage(freq.groupBy("span", "feature").agg(F.sum("count").alias("__t")))          # spans × features
    # one row per span (the span list is metadata), each with the spans beside it
    w = Window.orderBy("span")
    spans = tot.select("span").distinct().select("span", F.lag("span").over(w).alias("__before"), F.lead("span").over(w).alias("__after"))
    norm = freq.join(broadcast_if_small(tot.join(broadcast_if_small(spans), "span")), ["span", "feature"])
    p = F.col("count") / F.col("__t")
    # each share counts for its own span and, with a minus sign, for the span after it
    sides = F.array(F.struct(F.col("span").alias("s"), F.col("__before").alias("previous_span"), p.alias("d")),
                    F.struct(F.col("__after").alias("s"), F.col("span").alias("previous_span"), (-p).alias("d")))
    j = (norm.select("feature", "value", F.inline(sides)).where(F.col("s").isNotNull() & F.col("previous_span").isNotNull())
         .groupBy(F.col("s").alias("span"), "previous_span", "feature", "value").agg(F.sum("d").alias("d")))
    d = F.abs("d")
    return (j.groupBy("span", "previous_span", "feature")
            .agg(F.max(d).alias("distance"),
                 F.min_by("value", F.struct((-d).alias("nd"), F.col("value").alias("v"))).alias("at_value"))
            .withColumn("threshold", F.lit(threshold))
            .withColumn("is_anomaly", F.col("distance") > F.col("threshold")))
