"""Readers: CSV with declared types, typed parsing of raw strings, labelled and paired files,
and reproducible synthetic columns derived from a key."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.position import hash_int

# Feature-spec type names → Spark SQL types (fixed-length scalar features only).
SPEC_TYPES = {"int64": "bigint", "string": "string", "float32": "float", "float64": "double"}


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               infer: bool = False) -> DataFrame:
    """Headed CSV. With a schema no inference pass runs; quoted commas are handled by the reader."""
    r = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", bool(infer)).csv(path)


def apply_feature_spec(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Trim every value and convert to the declared type; unparsable values become null."""
    cols = []
    for name, typ in spec.items():
        v = F.trim(F.col(f"`{name}`").cast("string"))
        cols.append((v if SPEC_TYPES[typ] == "string" else v.try_cast(SPEC_TYPES[typ])).alias(name))
    return df.select(*cols)


def read_labelled_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Files under class folders → (path, length, content, class, class_index).

    The class is the parent folder's name (a ``key=value`` folder gives ``value``); classes are
    numbered in name order. The class table is one row per folder, so it is tiny; it is joined
    after a size check.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(root)
    parent = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    files = files.withColumn("class", F.regexp_extract(parent, r"([^=]+)$", 1))
    from kiln.operators.analyze import broadcast_if_small
    # One row per class folder: numbering that small table in one window is cheap.
    idx = files.select("class").distinct().withColumn(
        "class_index", F.row_number().over(Window.orderBy("class")) - 1)
    return files.join(broadcast_if_small(idx, 100_000), "class").select(
        "path", "length", "content", "class", F.col("class_index").cast("int").alias("class_index"))


def pair_table(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Both listings in one full outer join on the key, with ``status`` paired, left_only or right_only."""
    l, r = "__kiln_l", "__kiln_r"
    both = left.withColumn(l, F.lit(True)).join(right.withColumn(r, F.lit(True)), key, "full_outer")
    status = F.when(F.col(l).isNull(), "right_only").when(F.col(r).isNull(), "left_only").otherwise("paired")
    return both.withColumn("status", status).drop(l, r)


def pair_files(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Pair two listings on an explicit key (file stem); return (pairs, unmatched report)."""
    both = pair_table(left, right, key)
    pairs = both.where("status = 'paired'").drop("status")
    return pairs, both.where("status <> 'paired'").select(key, F.col("status").alias("side"))


def stem(path_col: str = "path") -> F.Column:
    """File name without folder and extension."""
    return F.regexp_extract(F.col(path_col), r"([^/]+?)(\.[^./]*)?$", 1)


def uniform_from_key(key: str, seed: int) -> F.Column:
    """Reproducible draw in (0, 1] from the key (same formula in any SQL engine with md5)."""
    return (hash_int(key, seed) + F.lit(1)) / F.lit(4294967296.0)


def synth_normal(df: DataFrame, key: str, mean: tuple[float, float], cov: tuple[tuple[float, float], tuple[float, float]],
                 seed: int = 7, names: tuple[str, str] = ("x0", "x1")) -> DataFrame:
    """Two correlated normal columns per row: Box-Muller on key hashes, then the Cholesky factor.

    Each row's point depends only on its key and the seed, so the sample is reproducible on any
    partitioning and in other engines.
    """
    u1, u2 = uniform_from_key(key, seed), uniform_from_key(key, seed + 1)
    r = F.sqrt(F.lit(-2.0) * F.log(u1))
    z0 = r * F.cos(F.lit(2 * math.pi) * u2)
    z1 = r * F.sin(F.lit(2 * math.pi) * u2)
    a, b, c = cov[0][0], cov[0][1], cov[1][1]
    l00 = math.sqrt(a)
    l10 = b / l00
    l11 = math.sqrt(c - l10 * l10)
    return df.withColumn(names[0], F.lit(mean[0]) + F.lit(l00) * z0).withColumn(
        names[1], F.lit(mean[1]) + F.lit(l10) * z0 + F.lit(l11) * z1)


def synth_uniform(df: DataFrame, key: str, n_cols: int, seed: int = 11, prefix: str = "u",
                  binary: bool = False) -> DataFrame:
    """``n_cols`` reproducible uniform [0,1) columns (or 0/1 when ``binary``) derived from the key."""
    out = df
    for j in range(n_cols):
        u = hash_int(key, seed + j) / F.lit(4294967296.0)
        out = out.withColumn(f"{prefix}{j}", (u < 0.5).cast("int") if binary else u)
    return out
