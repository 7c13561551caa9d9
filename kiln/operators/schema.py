"""Schema as two small tables, inferred from a profile and edited with pure functions.

``features``: one row per feature – feature, ordinal, type (INT/FLOAT/BYTES), domain (name or
null), min_fraction, min_count, value_count_min/max (null for scalars), min_domain_mass,
skew_threshold, drift_threshold, not_in_environment (array).

``domains``: one row per (domain, value). Values of an inferred domain are in byte order; a
domain may be shared by many features. Edits return a new :class:`Schema`; appends are
idempotent (set semantics), so re-running an edit never duplicates values.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURE_COLS = ["feature", "ordinal", "type", "domain", "min_fraction", "min_count", "value_count_min",
                "value_count_max", "min_domain_mass", "skew_threshold", "drift_threshold", "not_in_environment"]

# Default limit on the number of distinct values for which a string feature gets a domain.
MAX_DOMAIN = 100


@dataclass(frozen=True)
class Schema:
    features: DataFrame
    domains: DataFrame
    default_environments: tuple[str, ...] = field(default_factory=tuple)

    # -- display ---------------------------------------------------------------------------
    def feature_table(self) -> DataFrame:
        return self.features.select("feature", "type", "domain", "min_fraction", "min_count")

    def domain_table(self) -> DataFrame:
        """Domain → sorted values, one row per domain (domains are small by construction)."""
        return self.domains.groupBy("domain").agg(F.array_sort(F.collect_set("value")).alias("values"))


FEATURE_SCHEMA = ("feature string, ordinal int, type string, domain string, min_fraction double, min_count bigint, "
                  "value_count_min bigint, value_count_max bigint, min_domain_mass double, skew_threshold double, "
                  "drift_threshold double, not_in_environment array<string>")


def infer_schema(prof: dict[str, DataFrame], max_domain: int = MAX_DOMAIN,
                 array_sizes: DataFrame | None = None) -> Schema:
    """Types, domains (<= ``max_domain`` distinct values), presence and shape from a profile.

    Presence: min_fraction 1.0 when the feature was never missing, else 0.0; min_count 1.
    ``array_sizes`` (feature, min_size, max_size) sets the value-count bounds of array features.
    Everything read here is statistics-sized: one row per feature, and at most ``max_domain``
    values for each feature that gets a domain, so the tables are built on the driver.
    """
    spark = prof["features"].sparkSession
    parts = []
    if prof.get("numeric") is not None:
        parts.append(prof["numeric"].select("feature", "count", "missing", F.lit(None).cast("bigint").alias("distinct")))
    if prof.get("string") is not None:
        parts.append(prof["string"].select("feature", "count", "missing", "distinct"))
    if prof.get("other") is not None:
        parts.append(prof["other"].select("feature", "count", "missing", F.lit(None).cast("bigint").alias("distinct")))
    stats = {}
    if parts:
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        stats = {r["feature"]: r for r in u.collect()}                       # one row per feature
    sizes = {r["feature"]: (r["min_size"], r["max_size"]) for r in array_sizes.collect()} if array_sizes is not None else {}
    rows = []
    for r in prof["features"].collect():                                    # local, one row per feature
        st = stats.get(r["feature"])
        distinct = st["distinct"] if st is not None else None
        missing = st["missing"] if st is not None else 0
        domain = r["feature"] if (r["type"] == "BYTES" and distinct is not None and 0 < distinct <= max_domain) else None
        lo, hi = sizes.get(r["feature"], (None, None))
        rows.append((r["feature"], r["ordinal"], r["type"], domain, 1.0 if not missing else 0.0, 1, lo, hi,
                     1.0, None, None, []))
    features = spark.createDataFrame(rows, FEATURE_SCHEMA)
    with_domain = [row[0] for row in rows if row[3] is not None]
    values = (prof["freq"].where(F.col("feature").isin(with_domain)).select("feature", "value").distinct().collect()
              if with_domain else [])                                       # <= max_domain per feature
    domains = spark.createDataFrame([(v["feature"], v["value"]) for v in values], "domain string, value string")
    return Schema(features, domains)


def domains_omitted(prof: dict[str, DataFrame], max_domain: int = MAX_DOMAIN) -> DataFrame:
    """String features that get no domain (and so no domain check) because they have more than
    ``max_domain`` distinct values: (feature, distinct)."""
    return prof["string"].where(F.col("distinct") > max_domain).select("feature", "distinct")


def schema_summary(schema: Schema) -> DataFrame:
    return schema.features.agg(F.count(F.lit(1)).cast("bigint").alias("num_features"),
                               F.count("domain").cast("bigint").alias("num_with_domain"))


def domain_get(schema: Schema, feature: str) -> DataFrame:
    """Values of the domain the feature points at."""
    dom = schema.features.where(F.col("feature") == feature).select("domain")
    return schema.domains.join(F.broadcast(dom), "domain").select("domain", "value")


def domain_append(schema: Schema, feature: str, values: list[str]) -> Schema:
    """Add values to the feature's domain; values already there are not repeated."""
    spark = schema.features.sparkSession
    dom = _domain_name(schema, feature)
    new = spark.createDataFrame([(dom, v) for v in values], "domain string, value string")
    return replace(schema, domains=schema.domains.unionByName(new).distinct())


def _domain_name(schema: Schema, feature: str) -> str | None:
    """The feature's domain name (one value from the metadata-sized features table)."""
    row = schema.features.where(F.col("feature") == feature).select("domain").first()
    return row["domain"] if row else None


def domain_share(schema: Schema, features: list[str], domain_of: str) -> Schema:
    """Point ``features`` at the domain currently used by feature ``domain_of``."""
    target = _domain_name(schema, domain_of)
    f = schema.features.withColumn(
        "domain", F.when(F.col("feature").isin(features), F.lit(target)).otherwise(F.col("domain")))
    return replace(schema, features=f.select(*FEATURE_COLS))


def set_feature(schema: Schema, feature: str, **values) -> Schema:
    """Set scalar attributes (min_domain_mass, skew_threshold, drift_threshold, ...) of one feature."""
    f = schema.features
    for k, v in values.items():
        f = f.withColumn(k, F.when(F.col("feature") == feature, F.lit(v).cast(f.schema[k].dataType))
                         .otherwise(F.col(k)))
    return replace(schema, features=f)


def add_environment(schema: Schema, *envs: str) -> Schema:
    envs_all = tuple(dict.fromkeys(schema.default_environments + envs))
    return replace(schema, default_environments=envs_all)


def not_in_environment(schema: Schema, feature: str, env: str) -> Schema:
    f = schema.features.withColumn(
        "not_in_environment",
        F.when(F.col("feature") == feature, F.array_distinct(F.array_append("not_in_environment", F.lit(env))))
        .otherwise(F.col("not_in_environment")))
    return replace(schema, features=f)


def env_filter(schema: Schema, env: str | None) -> DataFrame:
    """Features expected in ``env``: all features minus those marked not in it."""
    if env is None:
        return schema.features
    return schema.features.where(~F.array_contains("not_in_environment", F.lit(env)))


def save_schema(schema: Schema, path: str) -> None:
    """Freeze the schema as two Parquet tables under ``path`` (plus the environments)."""
    schema.features.coalesce(1).write.mode("overwrite").parquet(path + "/features")
    schema.domains.coalesce(1).write.mode("overwrite").parquet(path + "/domains")
    spark = schema.features.sparkSession
    spark.createDataFrame([(e,) for e in schema.default_environments], "env string").coalesce(1) \
        .write.mode("overwrite").parquet(path + "/environments")


def load_schema(spark, path: str) -> Schema:
    envs = tuple(r["env"] for r in spark.read.parquet(path + "/environments").collect())
    return Schema(spark.read.parquet(path + "/features"), spark.read.parquet(path + "/domains"), envs)
