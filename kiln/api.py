"""User-facing entry points under the names of the operator inventory.

Each function composes kiln operators; all work stays in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions import text as TX
from kiln.functions.vectors import dense_forward
from kiln.operators import schema as S
from kiln.operators import stats as ST
from kiln.operators import validate as V
from kiln.operators.analyze import analyze, vocab_apply, vocab_build  # noqa: F401  (re-exported)
from kiln.operators.models import linear_gd  # noqa: F401  (re-exported)
from kiln.operators.split import split_hash, split_positional as _split_positional, splits_of
from kiln.sources.io import apply_feature_spec, read_labelled_files, read_table  # noqa: F401  (re-exported)


def allow_columns(df: DataFrame, remove: set[str] | list[str]) -> DataFrame:
    """Keep every column but the removal set."""
    return df.select(*[F.col(f"`{c}`") for c in ST.allowed(df, remove=set(remove))])


def split_positional(df: DataFrame, key: str | list[str], fractions: tuple[float, ...] = (0.7,),
                     label: str | None = None) -> dict[str, DataFrame]:
    """train = int(n·0.7) first rows in key order, eval = half the rest (or ``fractions[1]`` of all
    rows), serving = the remainder with the label dropped. Returns {'train', 'eval', 'serving'}."""
    ev = fractions[1] if len(fractions) > 1 else None
    return splits_of(_split_positional(df, key, fractions[0], eval_fraction=ev), label=label)


def split_random(df: DataFrame, key: str, seed: int = 42, bounds: tuple[float, float] = (0.70, 0.85)) -> dict[str, DataFrame]:
    """Seeded per-row draw: train / eval / test."""
    return splits_of(split_hash(df, key, seed, bounds), names=("train", "eval", "test"), drop=())


def profile(df: DataFrame, allow: list[str] | None = None, schema: S.Schema | None = None,
            remove: set[str] | None = None) -> dict[str, DataFrame]:
    """Statistics of a table; with a schema the columns are first converted to its types."""
    if schema is not None:
        types = {r["feature"]: r["type"] for r in schema.features.select("feature", "type").collect()}
        df = ST.stats_typed(df, types)
    return ST.profile(df, allow=allow, remove=remove)


def infer_schema(stats: dict[str, DataFrame], max_domain: int = S.MAX_DOMAIN) -> S.Schema:
    return S.infer_schema(stats, max_domain)


def validate(stats: dict[str, DataFrame], schema: S.Schema, env: str | None = None,
             previous: dict[str, DataFrame] | None = None,
             serving: dict[str, DataFrame] | None = None) -> DataFrame:
    """All rules as one anomaly table (feature, anomaly, detail, value)."""
    return V.validate_all(stats, schema, env, previous, serving)


def skew(df1: DataFrame, df2: DataFrame, feature: str, threshold: float) -> DataFrame:
    """L-infinity distance of one feature's value frequencies in two tables, against a threshold."""
    a = ST.stats_value_freq(df1.select(F.col(f"`{feature}`").cast("string").alias(feature)))
    b = ST.stats_value_freq(df2.select(F.col(f"`{feature}`").cast("string").alias(feature)))
    return (V.linf_distance(a, b).withColumn("threshold", F.lit(float(threshold)))
            .withColumn("is_anomaly", F.col("distance") > F.col("threshold")))


def vocab(df: DataFrame, col: Column | str, top_k: int | None = None) -> DataFrame:
    """(term, count, id) by descending count; ids from 0."""
    return vocab_build(df, col, top_k)


def read_sequences(df: DataFrame, key: str, text: str, num_words: int, label: str | None = None) -> DataFrame:
    """Labelled integer sequences from text with a vocabulary cap: (key, [label], sequence)."""
    index = TX.word_index(df, text, num_words)
    enc = TX.encode(df.select(key, text), key, text, index, num_words, index_rows=num_words)
    return enc.join(df.select(key, label), key) if label else enc


def dense(df: DataFrame, vec: str, weights: list[list[float]], bias: list[float], act: str = "linear",
          out: str = "scores") -> DataFrame:
    """Score rows through one dense layer: act(x·W + b)."""
    return df.withColumn(out, dense_forward(vec, weights, bias, act))


def synth_normal(spark: SparkSession, n: int, mean: tuple[float, float],
                 cov: tuple[tuple[float, float], tuple[float, float]], seed: int = 7) -> DataFrame:
    """n two-dimensional normal points with the given mean and covariance (reproducible per id)."""
    from kiln.sources.io import synth_normal as _sn
    return _sn(spark.range(n), "id", mean, cov, seed)
