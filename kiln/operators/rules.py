"""All validation rules of several splits from one count table.

:func:`count_table` reads every split once and groups (feature, value) with one count per split: strings
keep their values, arrays their sizes, and all other features only count present and missing cells, so
their rows are few whatever the data. From that table come the schema (:func:`schema_from_counts`) and
every rule (:func:`validate_splits`): one grouped pass gives the totals per feature, which are metadata
(features x splits numbers); a second gives the distances between splits; unexpected values are a filter.
Three shuffles of data in all: the counts, the totals, the distances. (The schema's domain values are made
distinct and stored before; they are as many as the schema lists.)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.analyze import broadcast_if_small
from kiln.operators.schema import FEATURE_SCHEMA, MAX_DOMAIN, Schema
from kiln.operators.stats import feature_kind, q
from kiln.session import cut_lineage

VALUE, SIZE, SOME, NONE = "value", "size", "some", "none"
RESULT = "split string, feature string, anomaly string, detail string, value double"


@dataclass(frozen=True)
class Counts:
    """``table``: (feature, kind, value, n_<split>...); ``types``: per split its features and their types."""
    table: DataFrame
    types: dict[str, dict[str, str]]

    @property
    def splits(self) -> list[str]:
        return list(self.types)


def count_table(splits: dict[str, DataFrame], remove: set[str] | None = None) -> Counts:
    """One grouped count over all columns of all splits, whose columns and types may differ."""
    parts, types = [], {}
    for name, df in splits.items():
        cells = []
        types[name] = {}
        for f in df.schema.fields:
            if f.name in (remove or ()):
                continue
            c = F.col(q(f.name))
            if isinstance(f.dataType, T.StringType):
                kind, value = F.lit(VALUE), c
            elif isinstance(f.dataType, T.ArrayType):
                kind, value = F.lit(SIZE), F.size(c).cast("string")
            else:
                kind, value = F.lit(SOME), F.lit("")
            cells.append(F.struct(F.lit(f.name).alias("feature"), F.when(c.isNull(), NONE).otherwise(kind).alias("kind"),
                                  F.when(c.isNotNull(), value).alias("value")))
            types[name][f.name] = feature_kind(f.dataType)
        if cells:
            parts.append(df.select(F.lit(name).alias("split"), F.inline(F.array(*cells))))
    if not parts:
        raise ValueError("no split has a column to count")
    rows = reduce(DataFrame.unionByName, parts)
    table = rows.groupBy("feature", "kind", "value").agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in splits])
    return Counts(cut_lineage(table), types)


def schema_from_counts(counts: Counts, base: str, max_domain: int = MAX_DOMAIN) -> Schema:
    """The schema of one split: types, domains of at most ``max_domain`` values, presence, array sizes."""
    spark = counts.table.sparkSession
    own = counts.table.where(F.col(f"n_{base}") > 0)
    size = F.when(F.col("kind") == SIZE, F.col("value").cast("bigint"))
    per = {r["feature"]: r for r in own.groupBy("feature").agg(
        F.count_if(F.col("kind") == VALUE).alias("distinct"), F.count_if(F.col("kind") == NONE).alias("missing"),
        F.min(size).alias("lo"), F.max(size).alias("hi")).collect()}                            # one row per feature
    rows = []
    for i, (feature, kind) in enumerate(counts.types[base].items()):
        r = per.get(feature)
        domain = feature if r is not None and 0 < r["distinct"] <= max_domain else None
        rows.append((feature, i, kind, domain, 0.0 if r is None or r["missing"] else 1.0, 1, r["lo"] if r else None, r["hi"] if r else None, 1.0, None, None, []))
    named = [r[0] for r in rows if r[3]]
    values = own.where((F.col("kind") == VALUE) & F.col("feature").isin(named)).select("feature", "value").collect() if named else []
    return Schema(spark.createDataFrame(rows, FEATURE_SCHEMA), spark.createDataFrame([tuple(v) for v in values], "domain string, value string"))


def validate_splits(counts: Counts, schema: Schema, check: dict[str, str | None], skew: tuple[str, str] | None = None,
                    drift: tuple[str, str] | None = None) -> DataFrame:
    """(split, feature, anomaly, detail, value): every rule on every split of ``check`` (split -> its
    environment, None for all features). ``skew``: (training, serving) and ``drift``: (current, previous)
    are the pairs of splits whose value distributions are compared where a feature has a threshold; the
    second split of a skew and the first of a drift name the row."""
    spark = counts.table.sparkSession
    feats = {r["feature"]: r for r in schema.features.collect()}                                # metadata
    with_domain = spark.createDataFrame([(n, r["domain"]) for n, r in feats.items() if r["domain"]], "feature string, domain string")
    members = schema.domains.distinct().join(F.broadcast(with_domain), "domain")                # a row per feature is broadcast
    members = cut_lineage(members.select("feature", "value", F.lit(True).alias("inside")))
    marked = counts.table.join(broadcast_if_small(members), ["feature", "value"], "left")
    marked = marked.withColumn("inside", F.coalesce("inside", F.lit(False)))

    size = F.when(F.col("kind") == SIZE, F.col("value").cast("bigint"))
    aggs = []
    for s in counts.splits:
        n = F.col(f"n_{s}")
        aggs += [F.sum(F.when(F.col("kind") != NONE, n)).alias(f"p_{s}"), F.sum(F.when(F.col("kind") == NONE, n)).alias(f"m_{s}"),
                 F.sum(F.when((F.col("kind") == VALUE) & F.col("inside"), n)).alias(f"i_{s}"),
                 F.min(F.when(n > 0, size)).alias(f"lo_{s}"), F.max(F.when(n > 0, size)).alias(f"hi_{s}")]
    totals = {r["feature"]: {k: r[k] or 0 if k[:2] in ("p_", "m_", "i_") else r[k] for k in r.asDict()}
              for r in marked.groupBy("feature").agg(*aggs).collect()}                          # features x splits numbers

    rows, flagged = [], []
    for s, env in check.items():
        seen = counts.types[s]
        expected = {n: r for n, r in feats.items() if env is None or env not in (r["not_in_environment"] or ())}
        rows += [(s, n, "SCHEMA_NEW_COLUMN", None, None) for n in seen if n not in feats]
        for n, r in expected.items():
            if n not in seen:
                rows.append((s, n, "SCHEMA_MISSING_COLUMN", None, None))
                continue
            if seen[n] != r["type"]:
                rows.append((s, n, "UNEXPECTED_TYPE", f"{r['type']}->{seen[n]}", None))
            t = totals.get(n, {})
            present, missing = t.get(f"p_{s}", 0), t.get(f"m_{s}", 0)
            share = present / (present + missing) if present + missing else None
            if present < (r["min_count"] or 0) or (share is not None and r["min_fraction"] is not None and share < r["min_fraction"]):
                rows.append((s, n, "PRESENCE", "count" if present < (r["min_count"] or 0) else "fraction", share))
            lo, hi = t.get(f"lo_{s}"), t.get(f"hi_{s}")
            if r["value_count_min"] is not None and lo is not None and lo < r["value_count_min"]:
                rows.append((s, n, "VALUE_COUNT", "below_min", float(lo)))
            if r["value_count_max"] is not None and hi is not None and hi > r["value_count_max"]:
                rows.append((s, n, "VALUE_COUNT", "above_max", float(hi)))
            if r["domain"] and present and t[f"i_{s}"] / present < (1.0 if r["min_domain_mass"] is None else r["min_domain_mass"]):
                flagged.append((s, n, present))
    parts = [spark.createDataFrame(rows, RESULT)]
    if flagged:
        cases = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(n).alias("of"), F.col(f"n_{s}").alias("n"), F.lit(p).alias("p")) for s, n, p in flagged])
        outside = marked.where((F.col("kind") == VALUE) & ~F.col("inside") & F.col("feature").isin([n for _, n, _ in flagged]))
        outside = outside.select("feature", "value", F.inline(cases)).where((F.col("of") == F.col("feature")) & (F.col("n") > 0))
        parts.append(outside.select("split", "feature", F.lit("UNEXPECTED_STRING_VALUES").alias("anomaly"), F.col("value").alias("detail"),
                                    (F.col("n") / F.col("p")).alias("value")))
    compared = []
    for pair, column, name in ((skew, "skew_threshold", "SKEW"), (drift, "drift_threshold", "DRIFT")):
        for n, r in feats.items() if pair else ():
            a, b = (totals.get(n, {}).get(f"p_{s}", 0) for s in pair)
            if r[column] is not None and n in counts.types[pair[0]] and n in counts.types[pair[1]] and (a or b):
                compared.append((pair[1] if name == "SKEW" else pair[0], n, name, float(r[column]), pair, max(a, 1), max(b, 1)))
    if compared:
        cases = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(n).alias("of"), F.lit(name).alias("anomaly"), F.lit(t).alias("threshold"),
                                   F.abs(F.col(f"n_{x}") / F.lit(a) - F.col(f"n_{y}") / F.lit(b)).alias("d")) for s, n, name, t, (x, y), a, b in compared])
        d = marked.where((F.col("kind") == VALUE) & F.col("feature").isin([c[1] for c in compared])).select("feature", "value", F.inline(cases))
        d = d.where(F.col("of") == F.col("feature")).groupBy("split", "feature", "anomaly", "threshold").agg(
            F.max("d").alias("distance"), F.min_by("value", F.struct((-F.col("d")).alias("nd"), F.col("value").alias("v"))).alias("detail"))
        parts.append(d.where(F.col("distance") > F.col("threshold")).select("split", "feature", "anomaly", "detail", F.col("distance").alias("value")))
    return reduce(DataFrame.unionByName, parts)
