"""Query of the n-gram Jaccard join; the test holds it against brute force over all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.parity_join import near_duplicates


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op9_ngram_jaccard_join": op9_ngram_jaccard_join}
ORACLES: dict[str, str] = {}
