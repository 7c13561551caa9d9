"""Query of the quality classifier; the test measures its accuracy on held-out labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.additive_model import quality_scores
from kiln.llm.common import table


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op7_quality_classifier": op7_quality_classifier}
ORACLES: dict[str, str] = {}
