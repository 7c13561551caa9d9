"""Query of the embedding whitening; the test holds it against a dense eigendecomposition in NumPy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.incremental_eigen import whitened


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_embedding_whitening": op12_embedding_whitening}
ORACLES: dict[str, str] = {}
